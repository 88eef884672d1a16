"""Toxicity with a counterfactual-regularised classifier.

A logistic regression over hashed words and word beginnings, present or not. For every labelled text that
mentions an identity term, a counterfactual has the term swapped for the next of its group; the fit adds a
penalty on the squared change of the logit between the two, so the mention itself moves the score little.

The classifier is fitted on a bounded sample of the labelled rows (``SAMPLE_ROWS``, taken in the order of a hash of
the id). Its features are chosen by how well they tell the sample's labels apart, counted in a table of
fixed size; only chosen features of sampled rows reach the driver. Every text is scored whole.

Defined cases: a text without letters has no features and the score of the bias; labels that are null count as no
label, several labels of one id count one by one; without labels, or with one kind only, every score is the share of toxic labels, 0
without any; null ids are scored but never learned from; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import tables
from tallyloom.llm import text as tx
from tallyloom.llm.letters import letter_words
from tallyloom.llm.shapes import led_by

SAMPLE_ROWS = 40_000
BUCKETS = 1 << 19
CHOSEN = 2048
BEGINNINGS = (4, 5, 6)
THRESHOLD = 0.7
PAIR_PENALTY = 1.0
# Sum of squared weights, against the sum of losses.
RIDGE = 0.05
# Chosen features change the log-likelihood of the labels by this much at least.
LEAST_GAIN = 6.0
STEPS = 400

# Identity terms by group.
IDENTITY_GROUPS = (
    ("man", "woman"), ("men", "women"), ("male", "female"), ("boy", "girl"), ("transgender", "nonbinary", "cisgender"),
    ("gay", "straight", "lesbian", "bisexual", "queer"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist"), ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("american", "mexican", "chinese", "indian", "german", "french", "spanish", "russian", "arab", "turkish"),
    ("immigrant", "refugee", "native"), ("immigrants", "refugees", "natives"),
    ("old", "young"), ("deaf", "blind", "disabled"),
    ("hombre", "mujer"), ("homme", "femme"), ("mann", "frau"),
    ("cristiano", "musulmán", "judío"), ("chrétien", "musulman", "juif"), ("christ", "muslim", "jude"),
)


def _hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row per word: the buckets of the word and its beginnings; a beginning that is the word is the word."""
    prints = tx.Fingerprints(points)
    whole = prints.of(starts, ends)
    columns = [whole]
    for size in BEGINNINGS:
        shorter = ends - starts > size
        begun = tx.mix(prints.of(starts, np.where(shorter, starts + size, ends)) + np.uint64(size))
        columns.append(np.where(shorter, begun, whole))
    return (np.stack(columns, axis=1) % np.uint64(BUCKETS)).astype(np.int64)


class Swaps(NamedTuple):
    """Sorted fingerprints of identity terms, and the features of what replaces each."""

    terms: np.ndarray
    features: np.ndarray


def swaps(groups: Sequence[Sequence[str]] = IDENTITY_GROUPS) -> Swaps:
    turns: dict[str, str] = {}
    for group in groups:
        group = [term.lower() for term in group]
        for term, other in zip(group, group[1:] + group[:1]):
            turns.setdefault(term, other)
    data, offsets = tx.utf8(pa.array([*turns, *turns.values()]))
    words = letter_words(data, offsets)
    prints = tx.Fingerprints(words.points).of(words.starts, words.ends)
    n = len(turns)
    order = np.argsort(prints[:n])
    return Swaps(prints[:n][order], _hashes(words.points, words.starts, words.ends)[n:][order])


def _features(data: np.ndarray, offsets: np.ndarray, swap: Swaps | None):
    """``row, bucket`` of the texts, distinct, and the same of their counterfactuals with the rows that have one."""
    words = letter_words(data, offsets)
    if not len(words.starts):
        none = np.zeros(0, np.int64)
        return (none, none), (none, none), none
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(words.first))
    buckets = _hashes(words.points, words.starts, words.ends)

    def distinct(b: np.ndarray, r: np.ndarray):
        key = np.unique((r[:, None] * BUCKETS + b).ravel())
        return key // BUCKETS, key % BUCKETS

    plain = distinct(buckets, row)
    if swap is None:
        return plain, None, None
    prints = tx.Fingerprints(words.points).of(words.starts, words.ends)
    at = np.minimum(np.searchsorted(swap.terms, prints), len(swap.terms) - 1)
    named = swap.terms[at] == prints
    rows = np.unique(row[named])
    other = np.where(named[:, None], swap.features[at], buckets)
    own = np.isin(row, rows)
    return plain, distinct(other[own], row[own]), rows


class Model(NamedTuple):
    chosen: np.ndarray  # sorted buckets
    weights: np.ndarray
    bias: float  # a logit
    constant: float | None = None  # the score of every text, where there were not labels of both kinds


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``text, toxic`` of at most ``rows`` labelled training rows; the sampled ids are a broadcast of that bound."""
    named = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out())
    taken = named.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(rows)
    return docs.join(F.broadcast(taken), "doc_id").select("text", "toxic")


def fit(
    docs: DataFrame, labels: DataFrame, *, rows: int = SAMPLE_ROWS, chosen: int = CHOSEN, penalty: float = PAIR_PENALTY,
    groups: Sequence[Sequence[str]] = IDENTITY_GROUPS,
) -> Model:
    """The classifier from ``doc_id, text`` and ``doc_id, toxic`` (0 or 1), each possibly with further columns.

    ``groups`` lists the identity terms that may stand for each other; words only, letters in either case.
    """
    docs, labels = docs.select("doc_id", "text"), labels.select("doc_id", "toxic")
    sample = _sample(docs, labels, rows)
    slots = 2 * BUCKETS + tables.CHUNK

    def count(batches):
        table = np.zeros(slots, np.int64)
        for batch in batches:
            for part, data, offsets in tx.pieces(batch, "text"):
                toxic = part.column(1).to_numpy()
                row, bucket = _features(data, offsets, None)[0]
                np.add.at(table, toxic[row] * BUCKETS + bucket, 1)
                table[2 * BUCKETS : 2 * BUCKETS + 2] += np.bincount(toxic, minlength=2)
        yield from tables.as_chunks(table)

    counted = tables.added_up(sample.select("text", F.col("toxic").cast("bigint").alias("toxic")).mapInArrow(count, tables.SHAPE), slots)
    total = counted[2 * BUCKETS : 2 * BUCKETS + 2]
    share = float(total[1] / max(1, total.sum()))
    if not total.all():
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0, share)
    kept = _telling(counted[:BUCKETS], counted[BUCKETS : 2 * BUCKETS], total, chosen)
    shared = docs.sparkSession.sparkContext.broadcast(kept)
    swap = swaps(groups)

    def extract(batches):
        for batch in batches:
            for part, data, offsets in tx.pieces(batch, "text"):
                plain, other, rows_with = _features(data, offsets, swap)
                first = _lists(plain, part.num_rows, shared.value)
                second = _lists(other, part.num_rows, shared.value)
                paired = np.isin(np.arange(part.num_rows), rows_with)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array(first, pa.binary()), pa.array([s if p else None for s, p in zip(second, paired)], pa.binary())],
                    names=["toxic", "features", "swapped"],
                )

    shape = "toxic bigint, features binary, swapped binary"
    rows_ = sample.select("text", F.col("toxic").cast("bigint").alias("toxic")).mapInArrow(extract, shape).collect()
    return _train(rows_, kept, share, penalty)


def _telling(clean: np.ndarray, toxic: np.ndarray, total: np.ndarray, most: int) -> np.ndarray:
    """The buckets whose presence tells the labels apart best, by the likelihood ratio."""
    seen = clean + toxic
    expected = seen * (total[1] / total.sum())
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(toxic > 0, toxic * np.log(toxic / expected), 0) + np.where(clean > 0, clean * np.log(clean / (seen - expected)), 0)
    best = np.argsort(-gain, kind="stable")[:most]
    return np.sort(best[gain[best] >= LEAST_GAIN])


def _lists(pairs, n: int, kept: np.ndarray) -> list[bytes]:
    row, bucket = pairs
    if not len(kept):
        return [b""] * n
    at = np.minimum(np.searchsorted(kept, bucket), len(kept) - 1)
    ok = kept[at] == bucket
    row, at = row[ok], at[ok].astype(np.uint16)
    bounds = np.searchsorted(row, np.arange(n + 1))
    return [at[bounds[i] : bounds[i + 1]].tobytes() for i in range(n)]


def _train(rows, kept: np.ndarray, share: float, penalty: float) -> Model:
    """Logistic regression with the pair penalty, by full-batch Adam; rows in a fixed order."""
    rows = sorted(rows, key=lambda r: (r.toxic, bytes(r.features), bytes(r.swapped or b"")))
    lists = [np.frombuffer(r.features, np.uint16) for r in rows]
    n, m = len(rows), len(kept)
    feature = np.concatenate([np.zeros(0, np.int64), *lists]).astype(np.int64)
    row = np.repeat(np.arange(n), [len(x) for x in lists])
    y = np.array([r.toxic for r in rows], float)
    # A pair's logits differ by the features on one side only.
    pair, moved, sign = [], [], []
    count = 0
    for r, own in zip(rows, lists):
        if r.swapped is not None:
            other = np.frombuffer(r.swapped, np.uint16)
            for side, weight in ((np.setdiff1d(own, other), 1.0), (np.setdiff1d(other, own), -1.0)):
                pair += [count] * len(side)
                moved += side.tolist()
                sign += [weight] * len(side)
            count += 1
    pair, moved, sign = np.array(pair, int), np.array(moved, int), np.array(sign, float)
    weights, bias = np.zeros(m + 1), np.log(share / (1 - share))
    weights[m] = bias
    first, second = np.zeros(m + 1), np.zeros(m + 1)
    for step in range(1, STEPS + 1):
        z = weights[m] + np.bincount(row, weights[feature], n)
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        gradient = np.append(np.bincount(feature, error[row], m) + RIDGE / n * weights[:m], error.sum())
        if count:
            change = np.bincount(pair, sign * weights[moved], count)
            gradient[:m] += 2 * penalty / count * np.bincount(moved, sign * change[pair], m)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(kept, weights[:m], float(weights[m]))


def score_toxicity(docs: DataFrame, model: Model, *, doc_id="doc_id", text="text") -> DataFrame:
    """``id, score`` per row, the score from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            for part, data, offsets in tx.pieces(batch, "text"):
                z = np.full(part.num_rows, model.bias)
                if len(model.chosen):
                    row, bucket = _features(data, offsets, None)[0]
                    at = np.minimum(np.searchsorted(model.chosen, bucket), len(model.chosen) - 1)
                    ok = model.chosen[at] == bucket
                    z += np.bincount(row[ok], model.weights[at[ok]], part.num_rows)
                score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                if model.constant is not None:
                    score[:] = model.constant
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score)], names=["id", "score"])

    return docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, led_by(docs, doc_id, "id", "score double"))


def held_out(doc_id: str = "doc_id"):
    """True for the third of documents whose labels are never learned from."""
    digest = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(digest % 3 == 1, F.lit(False))
