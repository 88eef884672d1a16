"""Language identification with spans of mixed-language text.

Words are runs of letters. A word's script, from code point ranges, narrows it to the languages that were
seen in that script; each of those scores the word by its letter trigrams and the word itself under
hashed per-language counts. A Viterbi pass over the words with a switching penalty labels each word, and
runs of one label are the spans.

Counts cover every labelled training row: tasks add up dense tables, which are summed in two steps by
chunk. The model, ``BUCKETS`` numbers per language, is the only thing that reaches the driver and the
broadcast.

The Viterbi pass cuts the words of a piece into blocks of ``STRIDE`` and works on all blocks at once: first the
best score from any label before a block to any label at its end, then the chain of blocks of each text,
then the labels inside the blocks. The result is the exact best path, and very long texts cost no more
per word than short ones.

Defined cases: a text that is null or has no letters, and any text when nothing could be learned, is ``und`` with
score 0; ties go to the first language in code point order; an empty table gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import text as tx
from tallyloom.llm.letters import letter_words
from tallyloom.llm.shapes import led_by
from tallyloom.llm.workers import releasing

UNKNOWN = "und"
BUCKETS = 1 << 17
CHUNK = 1 << 12
# Text worked on at once: a piece takes over a hundred times its bytes in arrays of letters.
PIECE_BYTES = 1 << 19
SWITCH_PENALTY = 12.0
# No single word says more than this against another language.
MOST_PER_WORD = 8.0
# A language is a candidate for a script that makes up this share of its letters.
SCRIPT_SHARE = 0.002
STRIDE = 64
TRAIN_REMAINDERS = (0, 1, 3)

# First and last code points of scripts, 0 being Latin and everything else.
SCRIPTS = (
    ((0x370, 0x3FF), (0x1F00, 0x1FFF)),  # Greek
    ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),  # Cyrillic
    ((0x530, 0x58F),),  # Armenian
    ((0x590, 0x5FF), (0xFB1D, 0xFB4F)),  # Hebrew
    ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),  # Arabic
    ((0x900, 0x97F), (0xA8E0, 0xA8FF)),  # Devanagari
    ((0x980, 0x9FF),),  # Bengali
    ((0xA00, 0xA7F),),  # Gurmukhi
    ((0xA80, 0xAFF),),  # Gujarati
    ((0xB00, 0xB7F),),  # Oriya
    ((0xB80, 0xBFF),),  # Tamil
    ((0xC00, 0xC7F),),  # Telugu
    ((0xC80, 0xCFF),),  # Kannada
    ((0xD00, 0xD7F),),  # Malayalam
    ((0xD80, 0xDFF),),  # Sinhala
    ((0xE00, 0xE7F),),  # Thai
    ((0xE80, 0xEFF),),  # Lao
    ((0xF00, 0xFFF),),  # Tibetan
    ((0x1000, 0x109F),),  # Myanmar
    ((0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)),  # Georgian
    ((0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF)),  # Hangul
    ((0x1200, 0x139F), (0x2D80, 0x2DDF)),  # Ethiopic
    ((0x1780, 0x17FF),),  # Khmer
    ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)),  # Kana
    ((0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)),  # Han
)
N_SCRIPTS = len(SCRIPTS) + 1
# The table of counts: buckets, then letters by script.
WIDTH = BUCKETS + CHUNK

_tables: list[np.ndarray] = []


def _scripts() -> np.ndarray:
    """The script of every code point."""
    if not _tables:
        script = np.zeros(0x110000, np.uint8)
        for number, ranges in enumerate(SCRIPTS, 1):
            for low, high in ranges:
                script[low : high + 1] = number
        _tables.append(script)
    return _tables[0]


class Words(NamedTuple):
    """The words of a piece: code point starts and ends, first word per text, script and features."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    script: np.ndarray
    letters: np.ndarray  # bucket of each letter's trigram, word after word
    whole: np.ndarray  # bucket of each word


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    found = letter_words(data, offsets)
    starts, ends, places, n = found.starts, found.ends, found.places, len(found.points)
    lowered = found.points.astype(np.uint64)
    padded = np.concatenate(([32], lowered, [32])).astype(np.uint64)
    before, after = padded[:-2].copy(), padded[2:].copy()
    cut = places[(places > 0) & (places < n)]
    before[cut] = 32
    after[cut - 1] = 32
    at = np.flatnonzero(found.inside)
    grams = tx.mix((before[at] << np.uint64(42)) | (lowered[at] << np.uint64(21)) | after[at])
    whole = tx.Fingerprints(found.points).of(starts, ends)
    buckets = np.uint64(BUCKETS - 1)
    return Words(starts, ends, found.first, _scripts()[found.points[starts]], (grams & buckets).astype(np.int64), (whole & buckets).astype(np.int64)), places


def _lengths_sum(values: np.ndarray, words: Words) -> np.ndarray:
    at = np.concatenate(([0], np.cumsum(words.ends - words.starts)[:-1])).astype(np.int64)
    return np.add.reduceat(values, at, axis=0)


class Model(NamedTuple):
    languages: list[str]
    scores: np.ndarray  # bucket x language
    allowed: np.ndarray  # script x language


def count_features(labelled: DataFrame) -> DataFrame:
    """``lang, chunk, counts``: the table of counts of every language, from ``lang, text``."""

    def run(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for rows, data, offsets in tx.pieces(batch, "text", PIECE_BYTES):
                if not len(data):
                    continue
                words, _ = _words(data, offsets)
                names, codes = np.unique(np.array(rows.column(0).to_pylist(), object).astype(str), return_inverse=True)
                owner = codes[np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))]
                sizes = words.ends - words.starts
                for code, name in enumerate(names):
                    own = owner == code
                    table = held.setdefault(str(name), np.zeros(WIDTH, np.int64))
                    table[:BUCKETS] += np.bincount(words.letters[np.repeat(own, sizes)], minlength=BUCKETS)
                    table[:BUCKETS] += np.bincount(words.whole[own], minlength=BUCKETS)
                    table[BUCKETS : BUCKETS + N_SCRIPTS] += np.bincount(words.script[own], sizes[own], N_SCRIPTS).astype(np.int64)
        for name, table in held.items():
            used = table.reshape(-1, CHUNK).any(axis=1).nonzero()[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used)), pa.array(used.astype(np.int32)),
                 pa.array([table[c * CHUNK : (c + 1) * CHUNK].tobytes() for c in used], pa.binary())],
                names=["lang", "chunk", "counts"],
            )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(CHUNK, np.int64)
        for part in frame["counts"]:
            total += np.frombuffer(part, np.int64)
        return frame.iloc[:1].assign(counts=[total.tobytes()])

    shape = "lang string, chunk int, salt int, counts binary"
    tables = labelled.select("lang", "text").mapInArrow(releasing(run), "lang string, chunk int, counts binary")
    some = tables.withColumn("salt", F.spark_partition_id() % 64).groupBy("lang", "chunk", "salt").applyInPandas(add, shape)
    return some.groupBy("lang", "chunk").applyInPandas(add, shape).select("lang", "chunk", "counts")


def fit(labelled: DataFrame) -> Model:
    """The model of all rows of ``lang, text`` with both; its size depends on the languages only."""
    rows = count_features(labelled.where("lang IS NOT NULL AND text IS NOT NULL")).collect()
    languages = sorted({r.lang for r in rows})
    counts = np.zeros((len(languages), WIDTH))
    for r in rows:
        counts[languages.index(r.lang), r.chunk * CHUNK : (r.chunk + 1) * CHUNK] += np.frombuffer(r.counts, np.int64)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((N_SCRIPTS, 0), bool))
    used = counts[:, :BUCKETS] + 0.5
    scores = np.log(used / used.sum(axis=1, keepdims=True))
    scores -= scores.mean(axis=0, keepdims=True)
    scripts = counts[:, BUCKETS : BUCKETS + N_SCRIPTS]
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return Model(languages, np.ascontiguousarray(scores.T.astype(np.float32)), np.ascontiguousarray(allowed.T))


def word_scores(words: Words, model: Model) -> np.ndarray:
    """A row per word: how much better each language explains it than the best, 0 for the best."""
    found = 0.5 * _lengths_sum(model.scores[words.letters], words) + model.scores[words.whole]
    allowed = model.allowed[words.script]
    allowed |= ~allowed.any(axis=1, keepdims=True)
    found = np.where(allowed, found, -np.float32(1e3))
    return np.maximum(found - found.max(axis=1, keepdims=True), -MOST_PER_WORD)


def best_path(scores: np.ndarray, first: np.ndarray, penalty: float = SWITCH_PENALTY, stride: int = STRIDE) -> np.ndarray:
    """The best label per word, for the words of every text at once."""
    n, labels = scores.shape
    if n == 0 or labels == 0:
        return np.zeros(n, np.int64)
    counts = np.diff(first)
    blocks = -(-counts // stride)
    start = np.concatenate(([0], np.cumsum(blocks)))
    total = int(start[-1])
    text = np.repeat(np.arange(len(counts)), blocks)
    word = np.arange(n) - np.repeat(first[:-1], counts)
    place = (start[np.repeat(np.arange(len(counts)), counts)] + word // stride, word % stride)
    grid = np.zeros((total, stride, labels), np.float32)
    grid[place] = scores
    # From each label before a block to each label at its end.
    through = np.where(np.eye(labels, dtype=bool), 0.0, -1e9).astype(np.float32)
    through = np.broadcast_to(through, (total, labels, labels)).copy()
    for j in range(stride):
        through = np.maximum(through, through.max(axis=2, keepdims=True) - penalty) + grid[:, None, j]
    entry = np.zeros((total, labels), np.float32)
    number = np.arange(total) - start[text]
    by_number = np.argsort(number, kind="stable")
    bounds = np.searchsorted(number[by_number], np.arange(int(blocks.max()) + 1))
    for k in range(1, int(blocks.max())):
        now = by_number[bounds[k] : bounds[k + 1]]
        value = (entry[now - 1][:, :, None] + through[now - 1]).max(axis=1)
        entry[now] = value - value.max(axis=1, keepdims=True)
    # Inside the blocks: the label before, for each label.
    back = np.empty((stride, total, labels), np.uint16)
    own, value = np.arange(labels, dtype=np.uint16), entry
    for j in range(stride):
        best = value.argmax(axis=1).astype(np.uint16)
        other = value.max(axis=1, keepdims=True) - penalty
        back[j] = np.where(value >= other, own, best[:, None])
        value = np.maximum(value, other) + grid[:, j]
    path = np.empty((stride, total, labels), np.uint16)
    now = np.broadcast_to(own, (total, labels))
    for j in range(stride - 1, -1, -1):
        path[j] = now
        now = np.take_along_axis(back[j], now.astype(np.int64), axis=1)
    leave = value.argmax(axis=1)
    for k in range(int(blocks.max()) - 2, -1, -1):
        here = by_number[bounds[k + 1] : bounds[k + 2]]
        leave[here - 1] = now[here, leave[here]]
    return path[place[1], place[0], leave[place[0]]].astype(np.int64)


def _label(shared, penalty: float):
    def run(batches):
        model = shared.value
        names = pa.array([*model.languages, UNKNOWN])
        # The Viterbi tables hold a square of the languages per block.
        limit = max(1 << 16, int(PIECE_BYTES * min(1.0, (16 / max(1, len(model.languages))) ** 2)))
        for batch in batches:
            for rows, data, offsets in tx.pieces(batch, "text", limit):
                n = rows.num_rows
                pred, score = np.full(n, len(model.languages)), np.zeros(n)
                ends, spans = np.zeros(n + 1, np.int32), [np.zeros(0, np.int64)] * 3
                words = None
                if len(data) and model.languages:
                    words, places = _words(data, offsets)
                if words is not None and len(words.starts):
                    labels = best_path(word_scores(words, model), words.first, penalty)
                    counts = np.diff(words.first)
                    row = np.repeat(np.arange(n), counts)
                    size = (words.ends - words.starts).astype(float)
                    held = np.bincount(row * len(model.languages) + labels, size, n * len(model.languages)).reshape(n, -1)
                    some = counts > 0
                    pred[some] = held[some].argmax(axis=1)
                    score[some] = held[some].max(axis=1) / held[some].sum(axis=1)
                    head = np.ones(len(row), bool)
                    head[1:] = (row[1:] != row[:-1]) | (labels[1:] != labels[:-1])
                    at = np.flatnonzero(head)
                    last = np.append(at[1:], len(row)) - 1
                    base = places[row[at]]
                    spans = [labels[at], words.starts[at] - base, words.ends[last] - base]
                    ends = np.concatenate(([0], np.cumsum(np.bincount(row[at], minlength=n)))).astype(np.int32)
                struct = pa.StructArray.from_arrays(
                    [names.take(pa.array(spans[0])), pa.array(spans[1].astype(np.int32)), pa.array(spans[2].astype(np.int32))],
                    ["lang", "start", "stop"],
                )
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), names.take(pa.array(pred)), pa.array(score), pa.ListArray.from_arrays(pa.array(ends), struct)],
                    names=["id", "lang_pred", "score", "spans"],
                )

    return run


def label_languages(docs: DataFrame, model: Model, *, doc_id="doc_id", text="text", penalty: float = SWITCH_PENALTY) -> DataFrame:
    """``id, lang_pred, score, spans``: the language with most letters, its share of them, and the spans.

    ``spans`` lists ``lang, start, stop`` in code points, from a span's first to its last letter.
    """
    shape = led_by(docs, doc_id, "id", "lang_pred string, score double, spans array<struct<lang:string, start:int, stop:int>>")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).mapInArrow(releasing(_label(shared, penalty)), shape)


def held_out(doc_id: str = "doc_id"):
    """True for the quarter of documents that takes no part in training; a null id takes part."""
    digest = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary"))
    return F.coalesce(digest % 4 == 2, F.lit(False))


def fit_documents(docs: DataFrame, *, doc_id="doc_id", text="text", lang="lang") -> Model:
    return fit(docs.where(~held_out(doc_id)).select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")))


# A document is rejected where no language holds this share of its letters.
LEAST_SHARE = 0.34


def keep_identified(docs: DataFrame, *, doc_id="doc_id", text="text", lang="lang", least: float = LEAST_SHARE) -> DataFrame:
    """The documents with a known main language, with all their columns."""
    model = fit_documents(docs, doc_id=doc_id, text=text, lang=lang)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    labelled = label_languages(whole, model, doc_id="row")
    return labelled.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("id.*")
