"""Near-duplicate documents by an inverted join over the coordinates of MinHash signatures.

Rows with equal shingle sets form one class and take part once. A class has ``COORDINATES`` minima; each is posted
under its coordinate and value. Two classes are a candidate when they agree in ``match_threshold`` coordinates
or more, a number that sets at the similarity asked for miss with a probability of ``MISS`` at most; candidates
are confirmed on their full sets.

Counting the agreements never merges whole lists:

- A value that only one class has agrees with nothing. Only shared ones stay, and a class with fewer of them than the
  threshold is done. That ends the join for most documents.
- Prefix: a class's lists are put in order of length. Two classes that agree in ``t`` of ``k`` coordinates meet in one
  of the first ``k - t + 1`` lists of both, so only these short ones are scanned.
- Skip: the long lists are never entered. A pair met in a prefix has its agreements counted at once from the signatures,
  which lie beside the list entries as eight planes of one bit per coordinate (a byte of each minimum). Different
  minima with equal bytes can only raise the count, so no candidate is lost.

Groups of thousands of near copies: every list, long ones too, has its most central class, the one whose lists are longest;
each class meets the central classes of its lists and keeps the one it meets in most of them, and confirmed links
join classes into components. Two such rounds take a row per list entry. Then prefixes are scanned for pairs of
different components only, a join on the list's key that the adaptive join splits when a key is frequent. Only pairs
above the threshold leave it, and of those only the ones whose parity sketches (a bit per slot, odd where an odd
number of elements falls into it) do not prove that the sets differ by too much.

Texts are read twice: for the signatures, and for the sets of the classes still in a list, found through a filter
of ``FILTER_BITS`` bits; what it lets through too much is dropped by a join. Beyond some ten million such classes the filter
passes most texts, which costs a shuffle of their sets and loses nothing. That filter is all that is broadcast.

Defined cases: null, empty and wordless texts have an empty set, linked with nothing; texts of fewer words than the
shingle have their whole sequence as the only element; a null id names a component only if it has no other, and ``kept``
compares ids with null as a value; rows sharing an id are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import text as tx
from tallyloom.llm.components import components
from tallyloom.scratch import discard, written

COORDINATES = 64
# Probability that a pair at the similarity asked for agrees in fewer coordinates than the threshold.
MISS = 1e-6
PLANES = 8
PARITY_WORDS = 16
STAR_ROUNDS = 2
FILTER_BITS = 1 << 25

_numbers = np.arange(1, COORDINATES + 1, dtype=np.uint64)
_FLIPS = tx.mix(_numbers * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = tx.mix(_FLIPS + np.uint64(0x2545F4914F6CDD1D)) | np.uint64(1)


class Rule(NamedTuple):
    """Texts link when ``100 * intersection >= percent * union`` over shingles of ``words`` words."""

    words: int = 5
    percent: int = 80


def match_threshold(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """The largest number of agreements that sets of that similarity stay below with probability ``miss`` at most."""
    share, below = percent / 100, 0.0
    for t in range(coordinates):
        below += comb(coordinates, t) * share**t * (1 - share) ** (coordinates - t)
        if below > miss:
            return max(t, 1)
    return coordinates


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all texts, ascending within a text, and the offsets between texts."""
    data = tx.LOWER[data]
    starts, ends, first = tx.words(data, offsets, tx.SPACED)
    hashes = tx.word_hashes(data, starts, ends)
    runs = tx.within(first, words)
    grams = tx.combine(hashes, runs, words)
    bounds = np.searchsorted(runs, first).tolist()
    at, parts = first.tolist(), []
    for i in range(len(at) - 1):
        if bounds[i + 1] > bounds[i]:
            own = np.sort(grams[bounds[i] : bounds[i + 1]])
            fresh = np.ones(len(own), bool)
            fresh[1:] = own[1:] != own[:-1]
            parts.append(own[fresh])
        elif at[i + 1] > at[i]:
            size = at[i + 1] - at[i]
            parts.append(tx.combine(hashes, np.array([at[i]]), size) + np.uint64(size))
        else:
            parts.append(grams[:0])
    sizes = np.array([len(p) for p in parts], np.int64)
    return np.concatenate(parts) if parts else grams[:0], np.concatenate(([0], np.cumsum(sizes)))


def signatures(elements: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The 32-bit minima of each set that is not empty, a row per set."""
    starts = bounds[:-1][bounds[1:] > bounds[:-1]]
    out = np.empty((len(starts), COORDINATES), np.uint32)
    if len(starts):
        for c in range(COORDINATES):
            h = (elements ^ _FLIPS[c]) * _FACTORS[c]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            out[:, c] = np.minimum.reduceat(h, starts) >> np.uint64(32)
    return out


def planes(minima: np.ndarray) -> np.ndarray:
    """Bit ``b`` of every coordinate's lowest byte as one 64-bit number, for each of the eight bits."""
    bits = np.unpackbits((minima & 0xFF).astype(np.uint8)[:, :, None], axis=2, bitorder="little")
    return np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little").copy().view("<i8").reshape(-1, PLANES)


def parities(elements: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per set that is not empty a bit per slot: whether an odd number of its elements falls into it."""
    slots, sizes = 64 * PARITY_WORDS, np.diff(bounds)
    rows, out = np.flatnonzero(sizes), []
    slot = (tx.mix(elements + np.uint64(0x33)) % np.uint64(slots)).astype(np.int64)
    for at in range(0, len(rows), 1024):
        some = rows[at : at + 1024]
        own = slot[bounds[some[0]] : bounds[some[-1] + 1]] + np.repeat(np.arange(len(some)) * slots, sizes[some])
        odd = (np.bincount(own, minlength=len(some) * slots) & 1).astype(np.uint8)
        out.append(np.packbits(odd, bitorder="little").view("<i8").reshape(-1, PARITY_WORDS))
    return np.concatenate(out) if out else np.zeros((0, PARITY_WORDS), np.int64)


def _class_names(elements: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set's elements, 128 bits that name it."""
    sums = []
    for salt in (0x51, 0xA7):
        total = np.concatenate(([np.uint64(0)], np.cumsum(tx.mix(elements + np.uint64(salt)), dtype=np.uint64)))
        sums.append(tx.signed(tx.mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64))))
    return sums[0], sums[1]


def _lists(flat: np.ndarray, full: np.ndarray, width: int) -> pa.Array:
    """``width`` values per full row, none for the others."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(full) * width)).astype(np.int32)), pa.array(flat.ravel()))


def _signed_rows(named: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id, k1, k2, rid, c1, c2, n, minima, planes, parity`` per row; ``rid`` numbers the rows of this table."""
    kind = named.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "k1", "k2", "rid", "c1", "c2", "n", "minima", "planes", "parity"]
    shape = f"doc_id {kind}, k1 bigint, k2 bigint, rid bigint, c1 bigint, c2 bigint, n bigint, minima array<int>, planes array<bigint>, parity array<bigint>"

    def run(batches):
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for rows, data, offsets in tx.pieces(batch, "text"):
                elements, bounds = shingle_sets(data, offsets, rule.words)
                minima, full = signatures(elements, bounds), np.diff(bounds) > 0
                c1, c2 = _class_names(elements, bounds)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), rows.column(2), pa.array(number + np.arange(len(full))), pa.array(c1), pa.array(c2),
                     pa.array(np.diff(bounds)), _lists(minima.view(np.int32), full, COORDINATES), _lists(planes(minima), full, PLANES),
                     _lists(parities(elements, bounds), full, PARITY_WORDS)],
                    names=names,
                )
                number += len(full)

    return written(named.mapInArrow(run, shape), "signed-rows")


def _near_size(rule: Rule, s: Column, t: Column) -> Column:
    return (F.lit(100) * s >= F.lit(rule.percent) * t) & (F.lit(100) * t >= F.lit(rule.percent) * s)


def _agreements(a: str, b: str) -> Column:
    differ = [F.col(f"{a}.p{i}").bitwiseXOR(F.col(f"{b}.p{i}")) for i in range(PLANES)]
    return F.lit(COORDINATES) - F.bit_count(reduce(Column.bitwiseOR, differ))


def _may_link(rule: Rule, a: str, b: str) -> Column:
    """False only where the parity sketches prove that the sets differ by too much."""
    differ = reduce(Column.__add__, [F.bit_count(F.col(f"{a}.parity")[i].bitwiseXOR(F.col(f"{b}.parity")[i])) for i in range(PARITY_WORDS)])
    s, t = F.col(f"{a}.n"), F.col(f"{b}.n")
    return differ <= s + t - 2 * F.ceil(F.lit(rule.percent) * (s + t) / F.lit(100 + rule.percent))


def _shared_lists(classes: DataFrame, least: int) -> DataFrame:
    """``rid, reach, lists`` of every class that may have a partner: the lists it shares as ``entries, key``, in order of length.

    ``reach`` grows with the length of all its lists.
    """
    key = F.shiftleft(F.col("pos").cast("bigint"), 32).bitwiseOR(F.col("value").cast("bigint").bitwiseAND(0xFFFFFFFF))
    posts = classes.select("rid", F.posexplode("minima").alias("pos", "value")).select("rid", key.alias("key"))
    shared = posts.groupBy("key").agg(F.count(F.lit(1)).alias("entries")).where("entries > 1")
    met = posts.join(shared, "key").groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("entries", "key"))).alias("lists"))
    reach = F.aggregate("lists", F.lit(0.0), lambda total, one: total + F.log(one.entries.cast("double")))
    return written(met.where(F.size("lists") >= least).select("rid", reach.alias("reach"), "lists"), "shared-lists")


def _filter(names: DataFrame) -> np.ndarray:
    """A bit per slot that a ``k1`` falls into; at most ``FILTER_BITS`` of them reach the driver."""
    words = names.selectExpr(f"cast(pmod(k1, {FILTER_BITS}) div 32 AS int) AS word", "shiftleft(1L, cast(pmod(k1, 32) AS int)) AS bit")
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(FILTER_BITS // 32, np.uint32)
    table[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return table


def _whole_sets(named: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """``rid, elements`` of the classes in ``wanted`` (``rid, k1, k2``), computed again from one text of each."""
    passes = named.sparkSession.sparkContext.broadcast(_filter(wanted))

    def run(batches):
        seen, bits = set(), passes.value
        for batch in batches:
            k1 = batch.column(0).to_numpy()
            slot = k1 % FILTER_BITS
            rows = np.flatnonzero(bits[slot >> 5] >> (slot & 31).astype(np.uint32) & np.uint32(1))
            k2 = batch.column(1).to_numpy()
            fresh = [r for r in rows.tolist() if not ((pair := (int(k1[r]), int(k2[r]))) in seen or seen.add(pair))]
            for part, data, offsets in tx.pieces(batch.take(pa.array(fresh, pa.int64())), "text"):
                elements, bounds = shingle_sets(data, offsets, rule.words)
                raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * 8).tobytes()), pa.py_buffer(elements.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), raw.cast(pa.binary())], names=["k1", "k2", "elements"])

    found = named.select("k1", "k2", "text").mapInArrow(run, "k1 bigint, k2 bigint, elements binary")
    whole = found.join(wanted, ["k1", "k2"]).groupBy("k1", "k2").agg(F.first("rid").alias("rid"), F.first("elements").alias("elements"))
    table = written(whole.select("rid", "elements"), "whole-sets")
    passes.unpersist()
    return table


def _confirmed(pairs: DataFrame, whole: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    left = whole.select(F.col("rid").alias("a"), F.col("elements").alias("left"))
    right = whole.select(F.col("rid").alias("b"), F.col("elements").alias("right"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")

    def check(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep[i] = 100 * both >= rule.percent * (len(x) + len(y) - both)
            yield batch.select([0, 1]).filter(pa.array(keep))

    return written(joined.mapInArrow(check, "a bigint, b bigint"), "confirmed")


def _star(lists: DataFrame, parts: DataFrame, tried: DataFrame | None) -> DataFrame:
    """Pairs ``a, b``: every class and the central class it meets in most of its lists, of another component and not tried yet."""
    entries = lists.join(parts, "rid").select("rid", "reach", "part", F.explode("lists.key").alias("key"))
    hubs = entries.groupBy("key").agg(F.max(F.struct("reach", "rid", "part")).alias("hub")).select("key", F.col("hub.rid").alias("other"), F.col("hub.part").alias("other_part"))
    met = entries.join(hubs, "key").where("part <> other_part").groupBy("rid", "other").agg(F.count(F.lit(1)).alias("times"))
    pair = met.select("rid", F.least("rid", "other").alias("a"), F.greatest("rid", "other").alias("b"), "other", "times")
    if tried is not None:
        pair = pair.join(tried, ["a", "b"], "left_anti")
    best = pair.groupBy("rid").agg(F.max(F.struct("times", "a", "b")).alias("best"))
    return best.select("best.a", "best.b").distinct()


def _parts(lists: DataFrame, links: DataFrame | None) -> DataFrame:
    """``rid, part``: the component of every class in a list."""
    names = lists.select("rid")
    if links is None:
        return names.select("rid", F.col("rid").alias("part"))
    found = components(links).select(F.col("node").alias("rid"), "root")
    return written(names.join(found, "rid", "left").select("rid", F.coalesce("root", "rid").alias("part")), "parts")


def _links(lists: DataFrame, signed: DataFrame, whole: DataFrame, rule: Rule, least: int) -> DataFrame:
    """Confirmed links ``a, b`` that hold every component together."""
    links = tried = None
    for _ in range(STAR_ROUNDS):
        pairs = written(_star(lists, _parts(lists, links), tried), "star")
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = _confirmed(pairs, whole, rule)
        links = found if links is None else links.unionByName(found)
    # The prefix: the shortest lists, one more than those that a partner at the threshold may miss.
    first = F.slice("lists", F.lit(1), F.size("lists") - F.lit(least - 1))
    prefixes = lists.join(_parts(lists, links), "rid").select("rid", "part", F.explode(F.transform(first, lambda one: one.key)).alias("key"))
    open_ = prefixes.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("key")
    narrow = signed.select("rid", "n", "parity", *[F.col("planes")[i].alias(f"p{i}") for i in range(PLANES)])
    rows = written(prefixes.join(open_, "key").join(narrow, "rid"), "open-lists")
    x, y = rows.alias("x"), rows.alias("y")
    met = x.join(
        y, (F.col("x.key") == F.col("y.key")) & (F.col("x.rid") < F.col("y.rid")) & (F.col("x.part") != F.col("y.part"))
        & _near_size(rule, F.col("x.n"), F.col("y.n")) & (_agreements("x", "y") >= least) & _may_link(rule, "x", "y"),
    )
    pairs = met.select(F.col("x.rid").alias("a"), F.col("y.rid").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    rest = _confirmed(pairs, whole, rule)
    discard(rows)
    return links.unionByName(rest)


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row; a component is named by its smallest id, which is kept."""
    content = F.col(f"`{text}`")
    named = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(content).alias("k1"), F.xxhash64(F.lit(1), content).alias("k2"), content.alias("text"))
    least = match_threshold(rule.percent)
    rows = _signed_rows(named, rule)
    own = rows.where("n > 0").groupBy("c1", "c2").agg(F.min(F.struct("rid", "k1", "k2")).alias("one"), F.min("doc_id").alias("lowest"))
    classes = written(own.select("c1", "c2", "one.*", "lowest"), "classes")
    signed = written(rows.join(classes.select("rid"), "rid", "left_semi").select("rid", "n", "minima", "planes", "parity"), "class-signatures")
    lists = _shared_lists(signed, least)
    wanted = classes.select("rid", "k1", "k2").join(lists.select("rid"), "rid", "left_semi")
    whole = _whole_sets(named, wanted, rule)
    parts = components(_links(lists, signed, whole, rule, least))
    labelled = written(classes.join(parts.select(F.col("node").alias("rid"), "root"), "rid", "left").select("c1", "c2", "lowest", F.coalesce("root", "rid").alias("root")), "labelled")
    lowest = labelled.groupBy("root").agg(F.min("lowest").alias("component_id"))
    by_class = labelled.select("c1", "c2", "root").join(lowest, "root").select("c1", "c2", "component_id")
    narrow = rows.select("doc_id", "c1", "c2", "n")
    filled = narrow.where("n > 0").join(by_class, ["c1", "c2"]).select("doc_id", "n", "component_id")
    result = filled.unionByName(narrow.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    for table in (signed, lists, whole):
        discard(table)
    return result.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
