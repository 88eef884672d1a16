"""Benchmark decontamination with suffix arrays over the training words.

Each task cuts its documents into shards of bounded bytes and sorts every shard's word suffixes
(prefix doubling; suffixes that are already alone are not sorted again). Every suffix of every
benchmark item is then binary-searched in each shard, all of them at once and word by word, which
gives the places of its first ``window`` words; from there the match is extended to its longest
verbatim length. Documents stay whole in their task, so nothing is shuffled.

The benchmark is streamed through the driver in blocks of at most ``BLOCK_CHARS`` characters (a longer
single item is a block of its own); each block is one broadcast and one further pass over the rows
in the same job, so no broadcast grows with the benchmark.

Defined cases: a null or wordless text has no words and no match; a null item text has no windows; items
with a null id take no part; items sharing an id count once; an item of fewer words than the window
is one window; an empty benchmark or document table gives unmatched or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import text as tx
from tallyloom.llm.shapes import led_by
from tallyloom.llm.workers import releasing

WINDOW = 13
BLOCK_CHARS = 4 << 20
# A document counts as contaminated when at least one word in so many is hit.
HIT_SHARE = 20
MATCH = "item_id string, item_word int, word int, words int"


class Items(NamedTuple):
    """A block of benchmark items: their words and the words' hashes, item by item."""

    ids: list[str]
    hashes: np.ndarray
    first: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def _items(rows: list[tuple[str, str]]) -> Items:
    data, offsets = tx.utf8(pa.array([text for _, text in rows], pa.string()))
    data = tx.LOWER[data]
    starts, ends, first = tx.words(data, offsets, tx.ALNUM)
    return Items([item for item, _ in rows], tx.word_hashes(data, starts, ends), first, data, starts, ends)


def benchmark_blocks(benchmark: DataFrame, item_id: str, text: str, limit: int = BLOCK_CHARS) -> Iterator[Items]:
    """The items in blocks of bounded size, one at a time on the driver."""
    held, size = [], 0
    rows = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t"))
    for row in rows.where("i IS NOT NULL AND t IS NOT NULL").toLocalIterator():
        if held and size + len(row.t) > limit:
            yield _items(held)
            held, size = [], 0
        held.append((row.i, row.t))
        size += len(row.t)
    if held:
        yield _items(held)


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of the ``depth`` symbols from there on; further ones may tie."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = symbols[order[1:]] != symbols[order[:-1]]
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, slots, 0))
    step = 1
    while step < depth:
        shared = ~fresh
        shared[:-1] |= ~fresh[1:]
        slots = np.flatnonzero(shared)
        if not len(slots):
            break
        places = order[slots]
        after = np.where(places + step < n, rank[np.minimum(places + step, n - 1)] + 1, 0)
        key = rank[places] * (n + 1) + after
        sort = np.argsort(key, kind="stable")
        key, places = key[sort], places[sort]
        order[slots] = places
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        fresh[slots] = new
        rank[places] = slots[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        step *= 2
    return order


def _bound(values: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, above: bool) -> np.ndarray:
    """The first place in ``low..high`` whose value is not below (or is above) the wanted one."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) >> 1
        value = values[np.minimum(middle, len(values) - 1)]
        right = open_ & ((value <= wanted) if above else (value < wanted))
        low = np.where(right, middle + 1, low)
        high = np.where(open_ & ~right, middle, high)


def _occurrences(symbols: np.ndarray, items: Items, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every occurrence of every window: the item word and shard word where it starts, and its words."""
    lengths = np.diff(items.first)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    start = np.arange(len(items.hashes))
    size = np.minimum(window, lengths[owner])
    keep = start + size <= items.first[owner + 1]
    start, size = start[keep], size[keep]
    order = suffix_array(symbols, window)
    low, high = np.zeros(len(start), np.int64), np.full(len(start), len(order))
    for j in range(window):
        # The j-th word of the suffixes in their order; sorted inside each interval found so far.
        live = np.flatnonzero((low < high) & (size > j))
        if not len(live):
            break
        column = symbols[np.minimum(order + j, len(symbols) - 1)] if len(live) > 64 or j < 2 else None
        wanted = items.hashes[start[live] + j]
        if column is None:
            spans = [symbols[np.minimum(order[a:b] + j, len(symbols) - 1)] for a, b in zip(low[live], high[live])]
            left = [np.searchsorted(s, w, "left") for s, w in zip(spans, wanted)]
            right = [np.searchsorted(s, w, "right") for s, w in zip(spans, wanted)]
            high[live] = low[live] + np.array(right)
            low[live] = low[live] + np.array(left)
        else:
            first = _bound(column, low[live], high[live], wanted, above=False)
            last = _bound(column, low[live], high[live], wanted, above=True)
            low[live], high[live] = first, last
    found = high - low
    hits = np.repeat(low - np.concatenate(([0], np.cumsum(found)[:-1])), found) + np.arange(found.sum())
    return np.repeat(start, found), order[hits], np.repeat(size, found)


class Matches(NamedTuple):
    """Maximal verbatim matches of one piece: row, item number, item word, word and words."""

    row: np.ndarray
    item: np.ndarray
    item_word: np.ndarray
    word: np.ndarray
    words: np.ndarray


def matches(data: np.ndarray, offsets: np.ndarray, items: Items, window: int) -> tuple[np.ndarray, Matches]:
    """Words per text, and the matches of at least a window."""
    data = tx.LOWER[data]
    starts, ends, first = tx.words(data, offsets, tx.ALNUM)
    counts = np.diff(first)
    none = np.zeros(0, np.int64)
    if not len(starts) or not len(items.hashes):
        return counts, Matches(none, none, none, none, none)
    # A barrier word after each text keeps matches inside it; a word with its hash would differ in the bytes.
    rows = np.repeat(np.arange(len(counts)), counts)
    symbols = np.full(len(starts) + len(counts), np.uint64(1))
    place = np.arange(len(starts)) + rows
    symbols[place] = tx.word_hashes(data, starts, ends)
    row_of = np.empty(len(symbols), np.int64)
    row_of[place] = rows
    row_of[first[1:] + np.arange(len(counts))] = np.arange(len(counts))
    item_word, word, words = _occurrences(symbols, items, window)
    if not len(word):
        return counts, Matches(none, none, none, none, none)
    # Windows one word on in both the item and the text belong to the same match.
    key = item_word * (len(symbols) + 1) + word
    head = ~np.isin(key - (len(symbols) + 2), key)
    item = np.searchsorted(items.first, item_word, side="right") - 1
    head |= item_word == items.first[item]
    item_word, word, words, item = item_word[head], word[head], words[head].copy(), item[head]
    live = np.arange(len(word))
    while len(live):
        a, b = item_word[live] + words[live], word[live] + words[live]
        ok = (a < items.first[item[live] + 1]) & (b < len(symbols))
        ok[ok] = items.hashes[a[ok]] == symbols[b[ok]]
        live = live[ok]
        words[live] += 1
    item_word, word, words, item = _same_bytes(data, starts, ends, row_of, items, window, item_word, word, words, item)
    row = row_of[word]
    return counts, Matches(row, item, item_word - items.first[item], word - first[row] - row, words)


def _same_bytes(data, starts, ends, row_of, items: Items, window: int, item_word, word, words, item):
    """The matches whose words agree byte by byte; of others the parts that do and hold a window."""
    raw, own = data.tobytes(), items.data.tobytes()
    kept: list[tuple[int, int, int, int]] = []
    for a, b, n, k in zip(item_word.tolist(), word.tolist(), words.tolist(), item.tolist()):
        at = b - int(row_of[b])
        least = min(window, int(items.first[k + 1] - items.first[k]))
        low = 0
        for j in range(n + 1):
            if j < n and at + j < len(starts) and raw[starts[at + j] : ends[at + j]] == own[items.starts[a + j] : items.ends[a + j]]:
                continue
            if j - low >= least:
                kept.append((a + low, b + low, j - low, k))
            low = j + 1
    return np.array(kept, np.int64).reshape(-1, 4).T


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``doc_id, text, n_words, matches``, a row per document.

    ``matches`` holds ``item_id, item_word, word, words`` for each maximal verbatim match of at least
    a window: where it starts in the item and in the document (words from 0), and its words.
    """
    shape = led_by(docs, doc_id, "doc_id", f"text string, n_words bigint, matches array<struct<{_struct(MATCH)}>>")
    found = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.lit(0).cast("bigint").alias("n_words"),
        F.lit(None).cast(f"array<struct<{_struct(MATCH)}>>").alias("matches"),
    )
    blocks = benchmark_blocks(benchmark, item_id, item_text, block_chars)
    for items in blocks:
        found = found.mapInArrow(releasing(_search(docs.sparkSession.sparkContext.broadcast(items), window)), shape)
    return found


def _struct(columns: str) -> str:
    return ", ".join(":".join(c.split()) for c in columns.split(", "))


def _search(shared, window: int):
    def run(batches):
        items = shared.value
        names = pa.array(items.ids, pa.string())
        for batch in batches:
            for rows, data, offsets in tx.pieces(batch, "text"):
                counts, found = matches(data, offsets, items, window)
                struct = pa.StructArray.from_arrays(
                    [names.take(pa.array(found.item)), *(pa.array(x.astype(np.int32)) for x in found[2:])],
                    ["item_id", "item_word", "word", "words"],
                )
                earlier = rows.column(3)
                row = np.concatenate((np.repeat(np.arange(len(earlier)), _lengths(earlier)), found.row))
                old = earlier.flatten()
                struct = pa.concat_arrays([old, struct.cast(old.type)]).take(pa.array(np.argsort(row, kind="stable")))
                ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(earlier))))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), struct)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(counts), lists],
                    names=["doc_id", "text", "n_words", "matches"],
                )

    return run


def _lengths(lists: pa.Array) -> np.ndarray:
    return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def hits_per_document(found: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, items, contaminated`` from :func:`benchmark_matches`.

    A word is hit if any match covers it. The matches of one document are merged in order of their
    first word, inside its row.
    """
    spans = F.array_sort(F.transform("matches", lambda m: F.struct(m["word"].alias("a"), (m["word"] + m["words"]).alias("b"))))
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("bigint").alias("n"))
    merged = F.aggregate(
        spans, zero,
        lambda s, x: F.struct(
            F.greatest(s["upto"], x["b"]).alias("upto"),
            (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(s["upto"], x["a"]))).cast("bigint").alias("n"),
        ),
        lambda s: s["n"],
    )
    n_hit = F.coalesce(merged, F.lit(0).cast("bigint"))
    items = F.coalesce(F.array_sort(F.array_distinct("matches.item_id")), F.array().cast("array<string>"))
    counted = found.select("doc_id", "n_words", n_hit.alias("n_hit"), items.alias("items"))
    bad = (F.col("n_hit") > 0) & (F.col("n_hit") * HIT_SHARE >= F.col("n_words"))
    return counted.withColumn("contaminated", bad)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns.

    The row travels beside its text as one struct, so columns of any name and type come through.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    found = benchmark_matches(whole, benchmark, doc_id="row", text="text", **options)
    words = hits_per_document(found).where(~F.col("contaminated"))
    return words.select("doc_id.*")
