"""Removal of long repeated strings with difference-cover suffix arrays.

Every byte covered by a ``size``-byte string that also starts anywhere else goes. Three steps:

1. Discarding. In every run of ``size`` bytes the ``GRAM``-byte string with the lowest fingerprint is its anchor; equal
   runs have equal anchors at the same place in them, so a run can only repeat if its anchor's string is an
   anchor in two places. That drops most of the text before any sorting, without losing a repeat.
2. Distributed suffix arrays. The stretch around each remaining anchor goes, with the anchor's name as key, to a
   shard, so runs that are equal always meet. Shards sort their suffixes with the difference cover of
   three: the triples at positions 1 and 2 modulo 3 are sorted and named, the names are sorted by recursion until
   they are unique or reach beyond ``size`` bytes, the remaining suffixes are sorted by a first byte and
   a name and merged in. Neighbours in suffix order are then compared over ``size`` bytes.
3. Repeated starts come back to their texts, become runs of bytes and are cut out.

Most stretches share an anchor but no run. Before its suffixes are sorted, a shard looks at blocks of ``OFFSET_BLOCK`` starts of a
stretch, counted from the anchor: the bytes that all runs of a block cover must occur in another stretch of that anchor, in
the same block, or the block cannot hold a repeat. Only what is left goes into an array.

Skew: equal texts and equal stretches leave a task once, with their number; anchors and stretches that follow each other byte by
byte, as in a long line of dashes, are one row with their number. Stretches of an anchor with more than ``SPLIT`` of them do not meet
in one shard: their blocks are counted by a fingerprint of those common bytes, and the runs of blocks that occur
again are grouped by their bytes, which are added up in the tasks first. No task holds a group of them.

Defined cases: a null text is empty; nothing shorter than ``size`` is removed for itself; matches never cross texts; rows are
told apart by content only, so repeated rows and rows with equal or null ids each count as an occurrence
and each get a result; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import text as tx
from tallyloom.llm.shapes import led_by
from tallyloom.llm.stages import stored
from tallyloom.scratch import discard

SIZE = 200
GRAM = 64
# Bytes whose suffixes one array holds at once.
SHARD_BYTES = 1 << 20
SPLIT = 2000
OFFSET_BLOCK = 16


# Three numbers below this fit into one of 63 bits.
_NARROW = 1 << 21


def _rank(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The sorting order, names from 1 in that order with equal keys sharing one, and the names used."""
    order = np.argsort(keys)
    ordered = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    names = np.empty(len(keys), np.int64)
    names[order] = np.cumsum(fresh)
    return order, names, int(fresh.sum())


def difference_cover_order(symbols: np.ndarray, reach: int, depth: int = 1) -> np.ndarray:
    """Suffix order of positive symbols, by the difference cover of 3.

    Exact over the first ``reach`` symbols at least; suffixes equal that far may come in any order.
    ``depth`` is how many symbols of the outermost text one symbol stands for.
    """
    n = len(symbols)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), np.int64)
    padded = np.concatenate((symbols, np.zeros(3, symbols.dtype))).astype(np.int64)
    base = int(symbols.max()) + 1
    # Position n stands in where n % 3 == 1, so that each third has its end in the cover.
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate((one, two))
    pairs = padded[sample] * base + padded[sample + 1]
    # Three symbols fit into one number unless there are millions of different ones.
    order, names, count = _rank((pairs if base < _NARROW else _rank(pairs)[1]) * base + padded[sample + 2])
    if count < len(sample) and 3 * depth < reach:
        order = difference_cover_order(names, reach, 3 * depth)
    rank = np.zeros(n + 3, np.int64)
    sample_order = sample[order]
    rank[sample_order] = np.arange(1, len(sample) + 1)
    sample_order = sample_order[sample_order < n]
    zero = np.arange(0, n, 3)
    wide = len(sample) + 2
    zero_key = padded[zero] * wide + rank[zero + 1]
    zero = zero[np.argsort(zero_key)]
    # Merging: against positions 1 mod 3 one symbol and a rank decide, against 2 mod 3 two symbols and a rank.
    ones, twos = sample_order[sample_order % 3 == 1], sample_order[sample_order % 3 == 2]
    first = lambda at: padded[at] * wide + rank[at + 1]
    pairs = np.concatenate((padded[zero] * base + padded[zero + 1], padded[twos] * base + padded[twos + 1]))
    if max(base, wide) >= _NARROW:
        pairs = _rank(pairs)[1]
    second = lambda named, at: named * wide + rank[at + 2]
    zero_two, twos_two = second(pairs[: len(zero)], zero), second(pairs[len(zero) :], twos)
    # Names tied at the cut of the recursion keep one order everywhere: running maxima make keys monotone.
    monotone = np.maximum.accumulate
    zero_first, ones_first, twos_two = monotone(first(zero)), monotone(first(ones)), monotone(twos_two)
    zero_two = monotone(zero_two)
    place = np.empty(n, np.int64)
    place[zero] = np.arange(len(zero)) + np.searchsorted(ones_first, zero_first) + np.searchsorted(twos_two, zero_two)
    in_sample = np.arange(len(sample_order))
    before = np.empty(len(sample_order), np.int64)
    is_one = sample_order % 3 == 1
    before[is_one] = np.searchsorted(zero_first, ones_first, side="right")
    before[~is_one] = np.searchsorted(zero_two, twos_two, side="right")
    place[sample_order] = in_sample + monotone(before)
    order = np.full(n, -1)
    order[place] = np.arange(n)
    # Ties beyond the reach may share a place.
    return order if order.min() >= 0 else np.argsort(place)


def _equal_runs(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Whether the ``size`` bytes at the places ``a`` and ``b`` are equal."""
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    alive = np.arange(len(a))
    steps = [*range(0, size - 7, 8), *([size - 8] if size % 8 else [])]
    for step in steps:
        alive = alive[words[a[alive] + step] == words[b[alive] + step]]
    equal = np.zeros(len(a), bool)
    equal[alive] = True
    return equal


def repeated_starts(stretches: list[bytes], copies: list[int], size: int) -> list[np.ndarray]:
    """Per stretch, whether the run of ``size`` bytes at each start occurs elsewhere too.

    A stretch that stands for several copies repeats in all its starts.
    """
    data = np.frombuffer(b"\0".join(stretches) + b"\0", np.uint8)
    symbols = data.astype(np.int64) + 2
    ends = np.cumsum([len(s) + 1 for s in stretches])
    symbols[ends - 1] = 1
    left = np.repeat(ends, [len(s) + 1 for s in stretches]) - 1 - np.arange(len(data))
    order = difference_cover_order(symbols, size)
    order = order[left[order] >= size]
    again = np.zeros(len(data), bool)
    if len(order) > 1:
        same = _equal_runs(data, order[:-1], order[1:], size)
        again[order[:-1][same]] = True
        again[order[1:][same]] = True
    starts = ends - [len(s) + 1 for s in stretches]
    return [again[a : a + len(s) - size + 1] | (c > 1) for a, s, c in zip(starts, stretches, copies)]


def _minima(data: np.ndarray, offsets: np.ndarray, size: int, gram: int):
    """``place, name`` of the anchors of all runs of ``size`` bytes, and per start of a run its anchor's place.

    Starts without a whole run in their text have -1.
    """
    n = len(data)
    if n < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.full(n, -1)
    names = tx.Fingerprints(data).windows(gram)
    width = size - gram + 1
    # Half a name above the place: the smallest is the lowest name, leftmost on ties. Sliding windows by doubling.
    best = (names & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(names), dtype=np.uint64)
    reach = 1
    while 2 * reach <= width:
        best = np.minimum(best[: len(best) - reach], best[reach:])
        reach *= 2
    m = n - size + 1
    anchor = (np.minimum(best[:m], best[width - reach : width - reach + m]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.arange(size, n + 1) <= np.repeat(offsets[1:], np.diff(offsets))[:m]
    anchors = np.full(n, -1)
    anchors[:m] = np.where(inside, anchor, -1)
    # Anchors never step back, so equal ones follow each other.
    places = anchor[inside]
    fresh = np.ones(len(places), bool)
    fresh[1:] = places[1:] != places[:-1]
    places = places[fresh]
    return places, names[places], anchors


def _stepping(*same: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Heads and lengths of the runs of rows that are equal but for a place that rises by one."""
    head = np.ones(len(place), bool)
    head[1:] = place[1:] != place[:-1] + 1
    for column in same:
        head[1:] |= column[1:] != column[:-1]
    first = np.flatnonzero(head)
    return first, np.diff(np.append(first, len(place)))


def _new_texts(rows: pa.RecordBatch, seen: set) -> np.ndarray:
    """Which texts the task has not met yet, by the keys in columns 1 and 2."""
    k1, k2 = rows.column(1).to_pylist(), rows.column(2).to_pylist()
    return np.array([not ((key := (a, b)) in seen or seen.add(key)) for a, b in zip(k1, k2)])


def _anchors(keyed: DataFrame, size: int) -> DataFrame:
    """``name, k1, k2, pos, n``: the anchors of every text, each text once per task; ``n`` of them from ``pos`` on, byte by byte."""

    def run(batches):
        seen = set()
        for batch in batches:
            for rows, data, offsets in tx.pieces(batch, "text"):
                new = _new_texts(rows, seen)
                places, names, _ = _minima(data, offsets, size, GRAM)
                owner = np.searchsorted(offsets, places, side="right") - 1
                keep = new[owner]
                owner, places, names = owner[keep], places[keep], names[keep]
                first, n = _stepping(owner, names, place=places)
                owner, places, names = owner[first], places[first], names[first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tx.signed(names)), rows.column(1).take(pa.array(owner)), rows.column(2).take(pa.array(owner)),
                     pa.array((places - offsets[owner]).astype(np.int32)), pa.array(n.astype(np.int32))],
                    names=["name", "k1", "k2", "pos", "n"],
                )

    return keyed.mapInArrow(run, "name bigint, k1 bigint, k2 bigint, pos int, n int")


def _run_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two fingerprints of each range: of the whole, and of its halves' fingerprints."""
    prints, middle = tx.Fingerprints(data), (starts + ends) // 2
    halves = prints.of(starts, middle) * np.uint64(0x9E3779B97F4A7C15) + prints.of(middle, ends)
    return prints.of(starts, ends), tx.mix(halves)


STRETCH = "name bigint, part int, common bigint, c1 bigint, c2 bigint, k1 bigint, k2 bigint, low int, n int, anchor int, bytes binary"


def _stretches(joined: DataFrame, size: int) -> DataFrame:
    """Stretches around repeated anchors, from ``text, k1, k2, anchors``; each text once per task.

    ``anchors`` lists ``pos, n, wide`` of a text's anchors that occur elsewhere too; ``wide`` marks those of many
    stretches. All starts of a stretch have its anchor, which lies ``anchor`` bytes into it. ``part`` is 0, or for wide
    anchors the block of offsets from 1; then ``common`` names the bytes that every run of the block covers, so equal runs
    have equal ones. ``c1, c2`` name the content; its bytes come with its first row in a piece. ``n`` equal stretches
    follow each other byte by byte from ``low`` on.
    """
    names_ = [c.split()[0] for c in STRETCH.split(", ")]

    def run(batches):
        seen = set()
        for batch in batches:
            for rows, data, offsets in tx.pieces(batch, "text"):
                new = _new_texts(rows, seen)
                places, names, anchors = _minima(data, offsets, size, GRAM)
                listed = rows.column(3)
                owner = np.repeat(np.arange(rows.num_rows), listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                flat = listed.flatten()
                first = flat.field(0).to_numpy(zero_copy_only=False).astype(np.int64) + offsets[owner]
                many = flat.field(1).to_numpy(zero_copy_only=False).astype(np.int64)
                at = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
                repeated, wide = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
                repeated[at] = True
                wide[at[np.repeat(flat.field(2).to_numpy(zero_copy_only=False).astype(bool), many)]] = True
                at = np.flatnonzero(anchors >= 0)
                at = at[repeated[anchors[at]]]
                if not len(at):
                    continue
                own = anchors[at]
                part = np.where(wide[own], (own - at) // OFFSET_BLOCK + 1, 0)
                head = np.ones(len(at), bool)
                head[1:] = (at[1:] != at[:-1] + 1) | (own[1:] != own[:-1]) | (part[1:] != part[:-1])
                lows = at[head]
                ends = at[np.append(np.flatnonzero(head)[1:], len(at)) - 1] + size
                own, part = own[head], part[head]
                text_of = np.searchsorted(offsets, lows, side="right") - 1
                keep = new[text_of]
                lows, ends, own, part, text_of = (x[keep] for x in (lows, ends, own, part, text_of))
                if not len(lows):
                    continue
                named = names[np.searchsorted(places, own)]
                common, split = np.zeros(len(part), np.uint64), np.flatnonzero(part)
                if len(split):
                    inner = own[split] - (part[split] - 1) * OFFSET_BLOCK
                    common[split] = tx.Fingerprints(data).of(inner, inner + size - OFFSET_BLOCK + 1)
                c1, c2 = _run_names(data, lows, ends)
                salt = tx.mix(named + part.astype(np.uint64))
                c1, c2 = tx.mix(c1 ^ salt), tx.mix(c2 + salt)
                head, n = _stepping(text_of, c1, c2, place=lows)
                lows, ends, own, part, text_of, named, common, c1, c2 = (x[head] for x in (lows, ends, own, part, text_of, named, common, c1, c2))
                bearer = np.zeros(len(c1), bool)
                bearer[np.unique(c1, return_index=True)[1]] = True
                sizes = np.where(bearer, ends - lows, 0)
                stops = np.concatenate(([0], np.cumsum(sizes)))
                source = np.arange(stops[-1]) + np.repeat(lows - stops[:-1], sizes)
                raw = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(lows), [pa.py_buffer(np.packbits(bearer, bitorder="little").tobytes()), pa.py_buffer(stops.tobytes()), pa.py_buffer(data[source].tobytes())]
                ).cast(pa.binary())
                where = pa.array(text_of)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tx.signed(named)), pa.array(part.astype(np.int32)), *(pa.array(tx.signed(x)) for x in (common, c1, c2)), rows.column(1).take(where), rows.column(2).take(where),
                     *(pa.array(x.astype(np.int32)) for x in (lows - offsets[text_of], n, own - lows)), raw],
                    names=names_,
                )

    return joined.mapInArrow(run, STRETCH)


def _thinned(found: DataFrame) -> DataFrame:
    """``name, part, common, c1, c2, anchor, bytes, copies``: each content once per task, or per so many bytes of them."""
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64())
    names = ["name", "part", "common", "c1", "c2", "anchor", "bytes", "copies"]

    def thin(batches):
        held: dict[tuple, list] = {}
        size_held = 0

        def out():
            rows = [(*value[2:], *value[:2]) for value in held.values()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)

        for batch in batches:
            for name, part, common, c1, c2, anchor, raw, n in zip(*(batch.column(i).to_pylist() for i in range(8))):
                entry = held.get((c1, c2))
                if entry is None:
                    held[c1, c2] = [raw, n, name, part, common, c1, c2, anchor]
                    size_held += len(raw or b"") + 300
                else:
                    entry[1] += n
                    if entry[0] is None:
                        entry[0] = raw
            if size_held > 32 << 20:
                yield out()
                size_held = 0
        if held:
            yield out()

    columns = found.select("name", "part", "common", "c1", "c2", "anchor", "bytes", "n")
    return columns.mapInArrow(thin, "name bigint, part int, common bigint, c1 bigint, c2 bigint, anchor int, bytes binary, copies bigint")


def _by_run(found: DataFrame, size: int) -> DataFrame:
    """``c1, c2, first, last`` of the stretches of wide anchors: equal runs are grouped by their bytes, whatever their number."""
    thinned, key = _thinned(found), ["name", "part", "common"]
    # Tables of their own: joins with them deal both sides anew and can split a frequent key.
    groups = stored(thinned.groupBy(key).agg(F.sum("copies").alias("n")).where("n > 1").select(key), "repeated-blocks")
    # Contents whose bytes came with another row of the task have none here.
    shared = thinned.join(groups, key).groupBy("c1", "c2").agg(F.max("bytes").alias("bytes"), F.sum("copies").alias("copies"))
    starts = F.sequence(F.lit(0), F.octet_length("bytes") - F.lit(size))
    runs = shared.select("c1", "c2", "copies", F.posexplode(F.transform(starts, lambda i: F.substring("bytes", i + 1, F.lit(size)))).alias("at", "run"))
    runs = stored(runs, "runs", groups)
    again = stored(runs.groupBy("run").agg(F.sum("copies").alias("n")).where("n > 1").select("run"), "repeated-names")
    marked = runs.join(again, "run").groupBy("c1", "c2").agg(F.bit_or(F.expr("shiftleft(1, at)")).alias("bits"))

    def spans(batches):
        for batch in batches:
            bits = (batch.column(2).to_numpy()[:, None] >> np.arange(OFFSET_BLOCK)) & 1
            edges = np.diff(np.pad(bits, ((0, 0), (1, 1))), axis=1)
            row, first = np.nonzero(edges == 1)
            after = np.nonzero(edges == -1)[1]
            where = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(where), batch.column(1).take(where), pa.array(first.astype(np.int32)), pa.array((after - 1).astype(np.int32))], names=["c1", "c2", "first", "last"]
            )

    return stored(marked.mapInArrow(spans, "c1 bigint, c2 bigint, first int, last int"), "wide-starts", runs, again)


def _narrowed(group: np.ndarray, raws: list[bytes], anchor: np.ndarray, copies: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``stretch, first, last``: runs of starts of the stretches whose blocks may repeat.

    The bytes common to all runs of a block must occur in the same block of another stretch of the group.
    """
    data = np.frombuffer(b"".join(raws), np.uint8)
    lengths = np.array([len(r) for r in raws], np.int64)
    places = np.cumsum(lengths) - lengths
    low, high = (anchor - lengths + size) // OFFSET_BLOCK, anchor // OFFSET_BLOCK
    n = high - low + 1
    stretch = np.repeat(np.arange(len(raws)), n)
    # Blocks from the highest down, so that starts rise.
    block = np.repeat(high + np.cumsum(n) - n, n) - np.arange(n.sum())
    begin = anchor[stretch] - block * OFFSET_BLOCK
    inner = places[stretch] + begin
    prints = tx.Fingerprints(data).of(inner, inner + size - OFFSET_BLOCK + 1)
    key = tx.mix(prints + tx.mix((group[stretch] * 1024 + block).astype(np.uint64)))
    _, code = np.unique(key, return_inverse=True)
    keep = np.bincount(code, copies[stretch])[code] > 1
    stretch, begin = stretch[keep], begin[keep]
    last = np.minimum(begin, lengths[stretch] - size)
    first = np.maximum(begin - OFFSET_BLOCK + 1, 0)
    head = np.ones(len(stretch), bool)
    head[1:] = (stretch[1:] != stretch[:-1]) | (first[1:] != last[:-1] + 1)
    tail = np.append(head[1:], True) if len(head) else head
    return stretch[head], first[head], last[tail]


def _shards(stretches: DataFrame, size: int, *done: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Where each content of a stretch occurs, and ``c1, c2, first, last``: its repeated starts.

    Tables in ``done`` go once the stretches are written.
    """
    found = stored(stretches, "stretches", *done)
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    thinned = _thinned(found.where("part = 0")).select("name", "part", "c1", "c2", "anchor", "bytes", "copies")
    dealt = thinned.repartition(parts, "name").sortWithinPartitions("name", "c1", "c2")

    def sort(batches):
        """Whole groups of ``name`` are put into arrays of bounded bytes; none has more than ``SPLIT`` stretches."""
        held: dict[tuple, list] = {}
        held_bytes, key, group = 0, None, 0

        def out():
            items = [(k, v) for k, v in held.items() if v[0] is not None]
            raws = [v[0] for _, v in items]
            numbers = [np.array([v[i] for _, v in items], np.int64) for i in (1, 2, 3)]
            stretch, first, last = _narrowed(numbers[2], raws, numbers[0], numbers[1], size)
            cut = [raws[i][a : b + size] for i, a, b in zip(stretch.tolist(), first.tolist(), last.tolist())]
            columns = [[], [], [], []]
            marks = repeated_starts(cut, numbers[1][stretch].tolist(), size) if cut else []
            for i, start, mark in zip(stretch.tolist(), first.tolist(), marks):
                low, high = tx.runs_of(mark)
                (c1, c2), k = items[i][0], len(low)
                for column, values in zip(columns, ([c1] * k, [c2] * k, (low + start).tolist(), (high + start - 1).tolist())):
                    column += values
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=["c1", "c2", "first", "last"])

        for batch in batches:
            for name, c1, c2, anchor, raw, copies in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5, 6))):
                if name != key:
                    if held_bytes >= SHARD_BYTES:
                        yield out()
                        held, held_bytes = {}, 0
                    key, group = name, group + 1
                entry = held.get((c1, c2))
                if entry is None:
                    held[c1, c2] = [raw, anchor, copies, group]
                    held_bytes += len(raw or b"")
                else:
                    entry[2] += copies
                    if entry[0] is None:
                        entry[0] = raw
                        held_bytes += len(raw or b"")
        if held:
            yield out()

    arrays = dealt.mapInArrow(sort, "c1 bigint, c2 bigint, first int, last int")
    wide = _by_run(found.where("part > 0"), size)
    return found, stored(arrays.unionByName(wide), "repeated-starts", wide)


def repeated_runs(docs: DataFrame, *, text: str = "text", size: int = SIZE) -> DataFrame:
    """``k1, k2, runs``: per content of a text with repeats, the byte runs ``start, stop`` they cover."""
    keyed = _keyed(docs, text)
    anchors = stored(_anchors(keyed.select("text", "k1", "k2"), size), "anchors")
    place = F.struct("k1", "k2", "pos")
    names = anchors.groupBy("name").agg(F.min(place).alias("low"), F.max(place).alias("high"), F.sum("n").alias("n"))
    # A table of its own: the join then deals both sides anew and can split a frequent name.
    names = stored(names.where("low <> high OR n > 1").select("name", (F.col("n") > SPLIT).alias("wide")), "repeated-names")
    listed = anchors.join(names, "name").select("k1", "k2", "pos", "n", "wide").distinct()
    by_text = stored(listed.groupBy("k1", "k2").agg(F.collect_list(F.struct("pos", "n", "wide")).alias("anchors")), "repeated-anchors", anchors, names)
    # Equal texts repeat all over; they take part once here, and whole below.
    joined = keyed.join(by_text, ["k1", "k2"]).select("text", "k1", "k2", "anchors")
    found, repeated = _shards(_stretches(joined, size), size, by_text)
    starts = found.select("k1", "k2", "low", "n", "c1", "c2").join(repeated, ["c1", "c2"])
    stop = F.col("low") + F.col("n") - F.lit(1) + F.col("last") + F.lit(size)
    spans = starts.select("k1", "k2", (F.col("low") + F.col("first")).alias("start"), stop.alias("stop"))
    copies = keyed.where(F.octet_length("text") >= size).groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("text")).alias("stop"))
    whole = copies.where("n > 1").select("k1", "k2", F.lit(0).alias("start"), F.col("stop").cast("int"))
    grouped = spans.unionByName(whole).distinct().groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("runs"))
    runs = stored(grouped, "repeated-runs")
    discard(found)
    discard(repeated)
    return runs


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select("*", content.alias("_text"), F.xxhash64(content).alias("_k1"), F.xxhash64(F.lit(1), content).alias("_k2")).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("_text").alias("text"), F.col("_k1").alias("k1"), F.col("_k2").alias("k2")
    )


def remove_repeats(docs: DataFrame, *, doc_id="doc_id", text="text", size: int = SIZE) -> DataFrame:
    """Per row ``doc_id, n_bytes, kept`` (the remaining bytes) and ``removed``, the byte runs taken out."""
    runs = repeated_runs(docs, text=text, size=size)
    keyed = _keyed(docs, text)
    joined = keyed.join(runs, ["k1", "k2"], "left").select(F.col(f"row.`{doc_id}`").alias("doc_id"), "text", "runs")
    shape = led_by(docs, doc_id, "doc_id", "n_bytes bigint, kept binary, removed array<struct<start:int, stop:int>>")

    def run(batches):
        for batch in batches:
            for rows, data, offsets in tx.pieces(batch, "text"):
                kept, removed = [], []
                raw = data.tobytes()
                for i, spans in enumerate(rows.column(2).to_pylist()):
                    low, high = int(offsets[i]), int(offsets[i + 1])
                    merged: list[list[int]] = []
                    for s in spans or []:
                        if merged and s["start"] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], s["stop"])
                        else:
                            merged.append([s["start"], s["stop"]])
                    at, parts = low, []
                    for start, stop in merged:
                        parts.append(raw[at : low + start])
                        at = low + stop
                    kept.append(b"".join(parts) + raw[at:high])
                    removed.append([{"start": a, "stop": b} for a, b in merged])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.diff(offsets)), pa.array(kept, pa.binary()), pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))],
                    names=["doc_id", "n_bytes", "kept", "removed"],
                )

    return joined.mapInArrow(run, shape)


def repeat_digest(cleaned: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` from :func:`remove_repeats`."""
    n_removed = F.col("n_bytes") - F.octet_length("kept")
    return cleaned.select(
        "doc_id", "n_bytes", n_removed.cast("bigint").alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
