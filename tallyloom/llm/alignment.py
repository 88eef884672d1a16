"""Alignment of two tokenizations of the same bytes by diagonal run skipping.

Each text with one space before it is encoded by two tokenizers, ``A`` and ``B``. Offsets at which a token of both ends cut
their tokens into groups; most groups are one token each. The end offsets of both are ascending arrays. At a common
offset the current index shift says which entry of ``B`` faces an entry of ``A``. Exponential probing compares ever longer
slices of the two arrays at that shift and a binary search in the last slice finds where they part, so a stretch of
one-to-one groups is jumped in a number of comparisons that grows with its logarithm. There an irregular group begins: both
arrays are advanced to their next common offset, and the shift changes by what one side has more.

Every pair of tokens in one group is a link. How many documents hold a pair of ids linked is counted over the corpus: a task
sums up chunks of texts (``CHUNK_BYTES`` of them, or one longer text) and writes, per chunk, the distinct id pairs with
their number of documents and, packed, which of them each document has. Sums by pair, and the highest sum of each ``A`` id, are
then brought back to the chunks by a join, so what is shuffled is a row per chunk and distinct pair, never one per
token or per document. A frequent pair has a row per chunk at most, and no task gathers more than a chunk.

Defined cases: null and empty texts, and texts whose joined token bytes differ from the space and the text for ``A`` or ``B``,
have no tokens: numbers are 0, the checksum is an empty string. Null ids and repeated rows are rows like any other, and each
repeated row counts as a document; an empty table gives no rows. Columns other than the two named are not read.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import parts as pt
from tallyloom.llm import text as tx
from tallyloom.scratch import written

CHUNK_BYTES = 2 << 20
# Entries compared first; the number doubles as long as they agree.
PROBE = 4
# A group of more pairs than this is summed up by distinct ids before its pairs are listed.
WIDE_GROUP = 1 << 12
_ID_BITS = 32

# Fixed value: a byte-level vocabulary writes printable bytes as themselves, the others as characters from U+0100 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def _byte_of() -> dict[str, int]:
    table = {chr(b): b for b in _PRINTABLE}
    for n, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE)):
        table[chr(0x100 + n)] = b
    return table


class _JsonSide(pt.JsonTokenizer):
    """A byte-level tokenizer; the space is put before texts here."""

    def __init__(self, path: str):
        super().__init__(path, plain=True)
        if not self.byte_level:
            raise ValueError(f"not a byte-level tokenizer: {path}")
        byte_of = _byte_of()
        added = {i for i in self.tokenizer.get_added_tokens_decoder()}
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.vocabulary)]
        self.tokens = [n.encode() if i in added else bytes(byte_of[c] for c in n) for i, n in enumerate(names)]

    def texts(self, texts: list[str]):
        return self.whole([f" {t}" for t in texts])


class _PieceSide:
    """A sentencepiece model, which puts a space before texts by itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = self.model = SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.tokens = [
            bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.line_end = model.encode(pt.LINE_END)
        # Merges never reach over a space or line end if no piece does; a run of spaces is never split into parts.
        self.by_parts = len(self.line_end) > 1 and not any(
            pt.LINE_END in p or ("▁" in p[1:] and p.strip("▁")) for i, p in enumerate(pieces) if not model.is_byte(i)
        )

    def texts(self, texts: list[str]):
        return self.model.encode(texts, num_threads=1)

    def parts(self, parts: list[str]):
        """What follows no space is encoded after a line end, whose ids are cut off."""
        skip = len(self.line_end)
        texts = [p if p[:1] != pt.UNSPACED else pt.LINE_END + p[1:] for p in parts]
        out = self.model.encode(texts, num_threads=1)
        for i, p in enumerate(parts):
            if p == pt.LINE_END:
                out[i] = out[i][1:]
            elif p[:1] == pt.UNSPACED:
                if out[i][:skip] != self.line_end:
                    raise ValueError(f"a line end joins what follows it: {p[1:]!r}")
                out[i] = out[i][skip:]
        return pt.flat(out)


class Aligner:
    """Both tokenizers of a worker, with the bytes and the decimal form of every token."""

    def __init__(self, a: str, b: str):
        self.sides = [_PieceSide(path) if path.endswith(".model") else _JsonSide(path) for path in (a, b)]
        self.bytes = [pa.array(side.tokens, pa.binary()) for side in self.sides]
        n = [len(side.tokens) for side in self.sides]
        ends = ((",", "|"), (",", ";"))
        self.written = pa.concat_arrays([pa.array([f"{i}{end}" for i in range(n[k])], pa.binary()) for k in (0, 1) for end in ends[k]])
        self.bases = [[0, n[0]], [2 * n[0], 2 * n[0] + n[1]]]
        whole = [side.texts for side in self.sides]
        self.by_parts = all(side.by_parts for side in self.sides)
        self.encode = pt.PartEncoder(whole, [side.parts for side in self.sides], first_spaced=True) if self.by_parts else None

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        if self.encode is not None:
            return self.encode(data, offsets)
        texts = pt.as_strings(data, offsets).to_pylist()
        found = [[np.array(i, np.int32) for i in side.texts(texts)] for side in self.sides]
        return [(np.concatenate([np.zeros(0, np.int32), *f]), np.array([len(i) for i in f], np.int64)) for f in found]


class Alignment(NamedTuple):
    """The tokens of a chunk of texts. Texts without tokens have a count of 0 on both sides."""

    ids: list[np.ndarray]  # of A, of B
    counts: list[np.ndarray]  # tokens per text
    ends: list[np.ndarray]  # per group, how many tokens end with it or before
    groups: np.ndarray  # groups per text


def group_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens end a group, from the ascending end offsets of both sides, whose last ones are equal."""
    a, b = np.ascontiguousarray(a, np.int64), np.ascontiguousarray(b, np.int64)
    raw_a, raw_b, list_a, list_b = a.tobytes(), b.tobytes(), a.tolist(), b.tolist()
    n, m = len(list_a), len(list_b)
    lows_a, highs_a, lows_b, highs_b = [], [], [], []
    i = shift = 0
    while i < n:
        if list_a[i] == list_b[i + shift]:
            base, most, low, step = 8 * shift, min(n, m - shift), i + 1, PROBE
            high = min(low + step, most)
            while low < high and raw_a[8 * low : 8 * high] == raw_b[8 * low + base : 8 * high + base]:
                low, step = high, 2 * step
                high = min(low + step, most)
            high -= 1 if low < high else 0
            while low < high:
                middle = (low + high + 1) >> 1
                if raw_a[8 * low : 8 * middle] == raw_b[8 * low + base : 8 * middle + base]:
                    low = middle
                else:
                    high = middle - 1
            i = low
        else:
            p, q = i, i + shift
            x, y = list_a[p], list_b[q]
            while x != y:
                if x < y:
                    p += 1
                    x = list_a[p]
                else:
                    q += 1
                    y = list_b[q]
            lows_a.append(i)
            highs_a.append(p)
            lows_b.append(i + shift)
            highs_b.append(q)
            i, shift = p + 1, q - p
    marks = []
    for size, lows, highs in ((n, lows_a, highs_a), (m, lows_b, highs_b)):
        inner = np.zeros(size + 1, np.int32)
        np.add.at(inner, lows, 1)
        np.add.at(inner, highs, -1)
        marks.append(np.cumsum(inner[:-1]) == 0)
    return marks[0], marks[1]


def _spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space before each."""
    stops = offsets + np.arange(len(offsets))
    out = np.full(stops[-1], 32, np.uint8)
    inner = np.ones(stops[-1], bool)
    inner[stops[:-1]] = False
    out[inner] = data
    return out, stops


def align(aligner: Aligner, data: np.ndarray, offsets: np.ndarray) -> Alignment:
    sides = aligner.ids(data, offsets)
    text, bounds = _spaced(data, offsets)
    full = np.diff(offsets) > 0
    taken = [table.take(pa.array(ids)) for table, (ids, _) in zip(aligner.bytes, sides)]
    stops, firsts = [], []
    for joined, (_, counts) in zip(taken, sides):
        ends = np.frombuffer(joined.buffers()[1], np.int32)[joined.offset : joined.offset + len(joined) + 1].astype(np.int64)
        raw = np.frombuffer(joined.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        first = np.concatenate(([0], np.cumsum(counts)))
        sizes = ends[first[1:]] - ends[first[:-1]]
        full &= sizes == np.diff(bounds)
        for i in np.flatnonzero(full).tolist() if not np.array_equal(raw, text) else []:
            low = ends[first[i]]
            full[i] = np.array_equal(raw[low : low + sizes[i]], text[bounds[i] : bounds[i + 1]])
        stops.append(ends)
        firsts.append(first)
    ids, counts, offset_ends = [], [], []
    # End offsets of the texts that have tokens, counted on over the whole chunk.
    length = np.where(full, np.diff(bounds), 0)
    place = np.concatenate(([0], np.cumsum(length)))
    for k, (own, number) in enumerate(sides):
        keep = np.repeat(full, number)
        ids.append(own[keep])
        counts.append(np.where(full, number, 0))
        moved = stops[k][1:] + np.repeat(place[:-1] - stops[k][firsts[k][:-1]], number)
        offset_ends.append(moved[keep])
    marks = group_ends(*offset_ends)
    ends = [np.flatnonzero(mark) + 1 for mark in marks]
    tokens_before = np.cumsum(counts[0])
    groups = np.diff(np.concatenate(([0], np.searchsorted(ends[0], tokens_before, side="right"))))
    return Alignment(ids, counts, ends, groups)


def group_checksums(aligner: Aligner, found: Alignment) -> list[str]:
    """SHA-256 per text of its groups as ``a1,a2|b1;a3|b2,b3``; an empty string for texts without tokens."""
    sizes = [np.diff(np.concatenate(([0], ends))) for ends in found.ends]
    before = [ends - size for ends, size in zip(found.ends, sizes)]
    n = len(found.ids[0]) + len(found.ids[1])
    codes = np.empty(n, np.int32)
    after = (before[1], found.ends[0])  # tokens of the other side that stand before a group's own
    for k in (0, 1):
        last = np.zeros(len(found.ids[k]), np.int32)
        last[found.ends[k] - 1] = 1
        place = np.arange(len(last)) + np.repeat(after[k], sizes[k])
        codes[place] = np.array(aligner.bases[k], np.int32)[last] + found.ids[k]
    listed = aligner.written.take(pa.array(codes))
    stops = np.frombuffer(listed.buffers()[1], np.int32)[listed.offset : listed.offset + n + 1]
    raw = memoryview(listed.buffers()[2] or b"")
    total = np.concatenate(([0], np.cumsum(found.counts[0] + found.counts[1])))
    bounds = stops[total].tolist()
    return [hashlib.sha256(raw[a : b - 1]).hexdigest() if b > a else "" for a, b in zip(bounds[:-1], bounds[1:])]


class Links(NamedTuple):
    """The distinct id pairs of a chunk, and those of each text with how often each is linked in it."""

    pairs: np.ndarray  # A id << 32 | B id
    held: np.ndarray  # place in ``pairs``, text by text
    times: np.ndarray
    bounds: np.ndarray  # of texts in ``held``


def _expanded(found: Alignment, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and id pair of every link of the chosen groups."""
    sizes = [np.diff(np.concatenate(([0], ends)))[chosen] for ends in found.ends]
    firsts = [ends[chosen] - size for ends, size in zip(found.ends, sizes)]
    links = sizes[0] * sizes[1]
    stops = np.cumsum(links)
    inside = np.arange(stops[-1] if len(stops) else 0) - np.repeat(stops - links, links)
    wide = np.repeat(sizes[1], links)
    a = found.ids[0][np.repeat(firsts[0], links) + inside // wide].astype(np.int64)
    b = found.ids[1][np.repeat(firsts[1], links) + inside % wide].astype(np.int64)
    text = np.repeat(np.arange(len(found.groups)), found.groups)[chosen]
    return np.repeat(text, links), a << _ID_BITS | b


def links_of(found: Alignment) -> Links:
    size_a, size_b = (np.diff(np.concatenate(([0], ends))) for ends in found.ends)
    wide = np.flatnonzero(size_a * size_b > WIDE_GROUP)
    text, pair = _expanded(found, np.flatnonzero(size_a * size_b <= WIDE_GROUP))
    coded = pa.array(pair).dictionary_encode()
    pairs, code = coded.dictionary.to_numpy(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    key = np.sort(text * max(1, len(pairs)) + code)
    fresh = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.append(fresh, len(key)))
    text, held = key[fresh] // max(1, len(pairs)), key[fresh] % max(1, len(pairs))
    if len(wide):
        owner = np.repeat(np.arange(len(found.groups)), found.groups)
        texts, codes, counts = [text], [pairs[held]], [times]
        for g in wide.tolist():
            (a, n_a), (b, n_b) = (np.unique(found.ids[k][found.ends[k][g] - s[g] : found.ends[k][g]], return_counts=True) for k, s in ((0, size_a), (1, size_b)))
            codes.append(np.add.outer(a.astype(np.int64) << _ID_BITS, b.astype(np.int64)).ravel())
            counts.append(np.multiply.outer(n_a, n_b).ravel())
            texts.append(np.full(len(codes[-1]), owner[g]))
        text, pair, times = (np.concatenate(x) for x in (texts, codes, counts))
        pairs, code = np.unique(pair, return_inverse=True)
        key, place = np.unique(text * len(pairs) + code, return_inverse=True)
        summed = np.zeros(len(key), np.int64)
        np.add.at(summed, place, times)
        text, held, times = key // len(pairs), key % len(pairs), summed
    return Links(pairs, held, times, np.searchsorted(text, np.arange(len(found.groups) + 1)))


def _packed(values: np.ndarray) -> bytes:
    """Numbers below 2^63, byte planes first, so that the high ones compress to nothing."""
    planes = np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, 8 * n, codec="zstd", asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<i8").ravel()


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(a: str, b: str) -> Aligner:
    if (a, b) not in _aligners:
        _aligners[a, b] = Aligner(a, b)
    return _aligners[a, b]


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))


def align_tokens(docs: DataFrame, a: str, b: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, a_ids, b_ids, a_ends, b_ends``: token ids, and the number of tokens up to each group's end.

    ``a`` and ``b`` name a byte-level tokenizers file or a sentencepiece ``.model`` that every executor has at that place.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        aligner = _aligner(a, b)
        for batch in batches:
            for rows, data, offsets in tx.pieces(batch, "text", CHUNK_BYTES):
                found = align(aligner, data, offsets)
                columns = [rows.column(0)]
                for k in (0, 1):
                    columns.append(_listed(found.ids[k], found.counts[k]))
                for k in (0, 1):
                    before = np.concatenate(([0], np.cumsum(found.counts[k])))[:-1]
                    columns.append(_listed((found.ends[k] - np.repeat(before, found.groups)).astype(np.int32), found.groups))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"])

    return _named(docs, doc_id, text).mapInArrow(run, f"doc_id {kind}, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>")


def _listed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(values))


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def _chunks(docs: DataFrame, kind: str, a: str, b: str) -> DataFrame:
    """A row per chunk: its documents' numbers, its distinct pairs with their documents, and who holds which."""
    shape = (
        f"chunk bigint, doc_ids array<{kind}>, {', '.join(f'{n} array<bigint>' for n in _NUMBERS)}, sums array<string>, "
        "bounds binary, held binary, times binary, pairs array<bigint>, documents array<bigint>"
    )
    names = ["chunk", "doc_ids", *_NUMBERS, "sums", "bounds", "held", "times", "pairs", "documents"]

    def run(batches):
        aligner, number = _aligner(a, b), TaskContext.get().partitionId() << 33
        for batch in batches:
            for rows, data, offsets in tx.pieces(batch, "text", CHUNK_BYTES):
                found = align(aligner, data, offsets)
                links = links_of(found)
                sums = group_checksums(aligner, found)
                documents = np.bincount(links.held, minlength=len(links.pairs)).astype(np.int64)
                total = np.concatenate(([0], np.cumsum(links.times)))[links.bounds]
                one = lambda array: pa.ListArray.from_arrays(pa.array([0, len(array)], pa.int32()), array)
                columns = [found.counts[0], found.counts[1], found.groups, np.diff(total)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), one(rows.column(0)), *(one(pa.array(c.astype(np.int64))) for c in columns), one(pa.array(sums, pa.string())),
                     *(pa.array([_packed(x)], pa.binary()) for x in (links.bounds, links.held, links.times)), one(pa.array(links.pairs)), one(pa.array(documents))],
                    names=names,
                )
                number += 1

    return written(docs.mapInArrow(run, shape), "alignment-chunks")


def alignment_digest(docs: DataFrame, a: str, b: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per row.

    ``n_best`` counts links whose pair is held by as many documents as the most frequent pair of its ``A`` id;
    ``count_sum`` adds up the documents of the pairs of all links.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    chunks = _chunks(_named(docs, doc_id, text), kind, a, b)
    listed = chunks.select("chunk", F.explode(F.arrays_zip("pairs", "documents")).alias("one")).select("chunk", "one.pairs", "one.documents")
    counts = listed.groupBy("pairs").agg(F.sum("documents").alias("documents")).withColumn("a", F.shiftright("pairs", _ID_BITS))
    best = counts.groupBy("a").agg(F.max("documents").alias("most"))
    known = written(counts.join(best, "a").select("pairs", "documents", (F.col("documents") == F.col("most")).alias("best")), "pair-counts")
    looked_up = listed.select("chunk", "pairs").join(known, "pairs").groupBy("chunk").agg(F.collect_list(F.struct("pairs", "documents", "best")).alias("known"))
    shape = f"doc_id {kind}, {', '.join(f'{n} bigint' for n in (*_NUMBERS, 'n_best', 'count_sum'))}, groups_sha256 string"
    columns = ["doc_ids", *_NUMBERS, "sums", "bounds", "held", "times", "pairs", "known"]

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                lists = [batch.column(i)[r].values for i in range(6)]
                n = len(lists[0])
                bounds = _unpacked(batch.column(6)[r].as_py(), n + 1)
                held, times = (_unpacked(batch.column(i)[r].as_py(), int(bounds[-1])) for i in (7, 8))
                documents, best = np.zeros(0, np.int64), np.zeros(0, bool)
                if batch.column(10)[r].is_valid:
                    own, found = batch.column(9)[r].values.to_numpy(zero_copy_only=False), batch.column(10)[r].values
                    pairs = found.field(0).to_numpy(zero_copy_only=False)
                    order = np.argsort(pairs)
                    at = order[np.searchsorted(pairs, own, sorter=order)]
                    documents = found.field(1).to_numpy(zero_copy_only=False)[at]
                    best = found.field(2).to_numpy(zero_copy_only=False).astype(bool)[at]
                sums = [np.concatenate(([0], np.cumsum(x)))[bounds] for x in (times * best[held], times * documents[held])]
                yield pa.RecordBatch.from_arrays(
                    [*lists[:5], *(pa.array(np.diff(s)) for s in sums), lists[5]], names=["doc_id", *_NUMBERS, "n_best", "count_sum", "groups_sha256"]
                )

    return chunks.join(looked_up, "chunk", "left").select(*columns).mapInArrow(run, shape)
