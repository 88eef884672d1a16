"""Runs of periodic words, found as maximal pairs of repeats.

A run is a stretch of consecutive words with smallest period ``q`` that is at least ``2 * q`` words long and that no
neighbouring word extends. Its words without the last ``q`` occur again ``q`` words on; those two occurrences are
a maximal pair: neither their left words nor their right words agree, and their distance is at most
their length. The reverse holds as well, so the maximal pairs with

    distance <= length   and   distance + length >= least

are exactly the runs and no match needs extending. One found under a multiple of its smallest period has the same
start and end, so the smallest distance per stretch is kept.

Such a pair is at least ``least / 2`` words long, so only suffixes sharing that many words take part. The words of a
piece of texts, each made distinct per text, are sorted as suffixes by doubling, where only groups that still
tie are sorted again. LCPs of neighbours follow from the ranks kept per doubling. The LCP-interval tree is walked
bottom-up; each interval holds its positions in order, in one list and in lists by left word. When two children
of an interval of LCP ``l`` meet, each position of the smaller one is paired with the larger one's positions
at a distance of at most ``l`` whose left word differs, through the class lists or the whole list,
whichever has fewer entries to look at.

Texts are independent, so nothing is shuffled, and a text's copies cost what a text costs. Memory goes with the piece:
a piece is a bounded number of bytes, or one longer text.

Defined cases: null, empty and wordless texts have no words and no runs; null ids and repeated rows are rows like
any other; an empty table gives no rows. Columns other than the two named are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import text as tx

LEAST = 12


def _suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix order, and per doubling the rank of every position: equal ranks mean 1, 2, 4... equal symbols.

    Groups of one are settled; only groups that tie are sorted further. Ranks have an extra last entry, the end.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    head = np.ones(n, bool)
    head[1:] = ordered[1:] != ordered[:-1]
    rank = np.full(n + 1, -1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    ranks, reach = [rank.copy()], 1
    # Places in the order whose group has more than one member.
    tied = np.flatnonzero(~head | ~np.append(head[1:], True))
    while len(tied):
        at = order[tied]
        group, follow = rank[at], rank[np.minimum(at + reach, n)]
        by = np.argsort(group * (n + 1) + follow + 1, kind="stable")
        at, group, follow = at[by], group[by], follow[by]
        order[tied] = at
        fresh = np.ones(len(at), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])
        rank[at] = tied[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        ranks.append(rank.copy())
        reach *= 2
        tied = tied[~fresh | ~np.append(fresh[1:], True)]
    return order, ranks


def _shared(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols the suffixes at ``a`` and ``b`` share."""
    length = np.zeros(len(a), np.int64)
    end = len(ranks[0]) - 1
    for level in range(len(ranks) - 1, -1, -1):
        x, y = np.minimum(a + length, end), np.minimum(b + length, end)
        length += (ranks[level][x] == ranks[level][y]).astype(np.int64) << level
    return length


class _Interval:
    """Positions below an interval: in order, and in order by left word."""

    __slots__ = ("places", "classes")

    def __init__(self, place: int, left: int):
        self.places, self.classes = [place], {left: [place]}


def _joined(a: _Interval, b: _Interval, lcp: int, lefts: list[int], least: int, found: dict) -> _Interval:
    """Reports the maximal pairs between two children and puts the smaller one into the larger."""
    if len(a.places) < len(b.places):
        a, b = b, a
    near, classes, gap = a.places, a.classes, least - lcp

    def pairs(place: int, others: list[int], low: int, high: int) -> None:
        for other in others[low:high]:
            distance = abs(other - place)
            if distance >= gap:
                start = place if place < other else other
                key = (start, start + lcp + distance)
                if distance < found.get(key, distance + 1):
                    found[key] = distance

    for left, places in b.classes.items():
        for place in places:
            low, high = bisect_left(near, place - lcp), bisect_right(near, place + lcp)
            if low == high:
                continue
            if high - low <= len(classes):
                for other in near[low:high]:
                    if lefts[other] != left:
                        pairs(place, [other], 0, 1)
                continue
            for kind, others in classes.items():
                if kind != left:
                    pairs(place, others, bisect_left(others, place - lcp), bisect_right(others, place + lcp))
    _put(near, b.places)
    for left, places in b.classes.items():
        held = classes.get(left)
        if held is None:
            classes[left] = places
        else:
            _put(held, places)
    return a


def _put(held: list[int], more: list[int]) -> None:
    """Both in order; a few are inserted, many are merged."""
    if more[0] > held[-1]:
        held.extend(more)
    elif len(more) * 8 < len(held):
        for place in more:
            insort(held, place)
    else:
        held.extend(more)
        held.sort()


def _maximal_pairs(order: list[int], lcps: list[int], lefts: list[int], shortest: int, least: int, found: dict) -> None:
    """Walks the intervals of ``shortest`` or more bottom-up; ``lcps[k]`` is that of suffixes ``k`` and ``k + 1``."""
    stack: list[tuple[int, _Interval]] = []
    for place, following in zip(order, lcps):
        if not stack and following < shortest:
            continue
        node = _Interval(place, lefts[place])
        while stack and stack[-1][0] > following:
            lcp, held = stack.pop()
            node = _joined(held, node, lcp, lefts, least, found)
        if stack and stack[-1][0] == following:
            stack[-1] = (following, _joined(stack[-1][1], node, following, lefts, least, found))
        elif following >= shortest:
            stack.append((following, node))


def runs_of_words(hashes: np.ndarray, first: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, stop, period`` of all runs of a piece, by start, then stop.

    ``hashes`` are the words of texts one after the other, ``first`` the number of each text's first word.
    """
    n, none = len(hashes), np.zeros(0, np.int64)
    shortest = (least + 1) // 2
    if n < 2 * shortest:
        return none, none, none
    text_of = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    symbols = tx.mix(hashes + text_of * np.uint64(0x9E3779B97F4A7C15))
    order, ranks = _suffix_order(symbols)
    lcp = np.zeros(n, np.int64)
    # Neighbours that share the largest power of two up to the shortest length may share it.
    rough = ranks[min(len(ranks) - 1, shortest.bit_length() - 1)][order]
    close = np.flatnonzero(rough[1:] == rough[:-1])
    if not len(close):
        return none, none, none
    lcp[close] = _shared(ranks, order[close], order[close + 1])
    lcp[lcp < shortest] = 0
    used = np.flatnonzero((lcp > 0) | np.concatenate(([False], lcp[:-1] > 0)))
    lefts = np.empty(n, np.int64)
    lefts[1:] = ranks[0][: n - 1]
    starts = first[:-1][first[:-1] < first[1:]]
    lefts[starts] = -1 - starts
    found: dict[tuple[int, int], int] = {}
    _maximal_pairs(order[used].tolist(), lcp[used].tolist(), lefts.tolist(), shortest, least, found)
    rows = np.array(sorted((a, b, q) for (a, b), q in found.items()), np.int64).reshape(-1, 3)
    return rows[:, 0], rows[:, 1], rows[:, 2]


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """Per row ``doc_id, n_words, runs, collapsed``.

    ``runs`` lists ``start, length, period`` in words, by start, then period. ``collapsed`` joins by one space the words
    that no run contains after its first ``period`` words.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    shape = f"doc_id {kind}, n_words bigint, runs array<struct<start:bigint, length:bigint, period:bigint>>, collapsed string"

    def run(batches):
        for batch in batches:
            for rows, data, offsets in tx.pieces(batch, "text"):
                yield _collapsed(rows, data, offsets, least)

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, shape)


def _collapsed(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, least: int) -> pa.RecordBatch:
    starts, ends, first = tx.words(data, offsets, tx.SPACED)
    low, high, period = runs_of_words(tx.word_hashes(data, starts, ends), first, least)
    # A difference array marks the words dropped; runs may overlap.
    edges = np.zeros(len(starts) + 1, np.int64)
    np.add.at(edges, low + period, 1)
    np.add.at(edges, high, -1)
    keep = np.cumsum(edges[:-1]) == 0
    kept_first = np.concatenate(([0], np.cumsum(keep)))[first]
    sizes = (ends - starts)[keep] + 1
    stops = np.concatenate(([0], np.cumsum(sizes)))
    # Each kept word with a space after it; a text's last space is left out.
    source = np.arange(stops[-1]) + np.repeat(starts[keep] - stops[:-1], sizes)
    joined = np.append(data, np.uint8(32))[np.minimum(source, len(data))]
    joined[stops[1:] - 1] = 32
    last = kept_first[1:] > kept_first[:-1]
    drop = stops[kept_first[1:][last]] - 1
    joined = np.delete(joined, drop)
    ends_of = stops[kept_first] - np.concatenate(([0], np.cumsum(last)))
    collapsed = pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(ends_of.astype(np.int64).tobytes()), pa.py_buffer(joined.tobytes())
    ).cast(pa.string())
    owner = np.searchsorted(first, low, side="right") - 1
    order = np.lexsort((period, low))
    owner, low, high, period = owner[order], low[order], high[order], period[order]
    bounds = np.searchsorted(owner, np.arange(len(offsets)))
    values = pa.StructArray.from_arrays(
        [pa.array(low - first[owner]), pa.array(high - low), pa.array(period)], fields=list(RUN)
    )
    runs = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values)
    return pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(first)), runs, collapsed], names=["doc_id", "n_words", "runs", "collapsed"])


# Fixed value: what separates words.
_GAP = "[\\x20\\x09-\\x0D]+"


def with_planted_period(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: one document in ten gets a periodic tail, by the checksum of its id.

    With ``h`` the checksum, ``g = h / 10`` and ``n`` words, those of ``h % 10 = 0`` repeat the ``p`` words from number
    ``a = g % n`` on, ``p = 1 + (n - a) / (3 + g % 8)``. A null id has no checksum and stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.col("text"), _GAP), lambda w: w != "")
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).cast("bigint").alias("g"))
    n = F.size("words").cast("bigint")
    a = F.col("g") % F.col("n")
    p = F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8)).cast("bigint")
    sized = chosen.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, a)).withColumn("p", p)

    def source(i: Column) -> Column:
        return F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))

    places = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), lambda i: F.get("words", source(i).cast("int")))
    return sized.select("doc_id", F.when(F.col("n") > 0, F.array_join(places, " ")).otherwise(F.col("text")).alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """One row per row of :func:`periodic_runs` with its longest run and checksums of all runs and of what is kept."""
    # The greatest of negated starts and periods is the smallest.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    listed = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r.start, r.length, r.period))
    flat = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.array_join(listed, "").alias("listed"), "collapsed")
    length, period = F.col("best.length"), -F.col("best.period")
    return flat.select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(F.lit(1000) * length / period).cast("bigint").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
