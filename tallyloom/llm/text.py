"""Vectorised work on a batch of texts: UTF-8 bytes, words and fingerprints as numpy arrays.

Spark hands tasks Arrow batches; these helpers cut a batch into pieces of bounded bytes (a single
longer text is a piece of its own) and compute on whole pieces instead of on strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 2 << 20


def _class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


# Words between white space: all but 0x20 and 0x09-0x0D.
SPACED = ~_class((0x20, 0x20), (0x09, 0x0D))
# Words of digits, small letters and everything beyond ASCII.
ALNUM = ~(_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, element by element."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(n, PIECE_BYTES + 1), base, np.uint64)
        factors[0] = 1
        known = _powers[base] = np.multiply.accumulate(factors)
    return known[:n]


class Fingerprints:
    """64-bit fingerprints of any ranges of one buffer of bytes or code points, from prefix sums."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        codes = _CODES[data] if data.dtype == np.uint8 else mix((data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        np.cumsum(codes * _power(_BASE, len(data)), out=self.sums[1:])
        self.scale = _power(_INVERSE, len(data) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.scale[starts]
        return mix(raw ^ (np.asarray(ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))

    def windows(self, size: int) -> np.ndarray:
        """Fingerprints of every run of ``size`` bytes."""
        n = max(0, len(self.sums) - size)
        raw = (self.sums[size:] - self.sums[:n]) * self.scale[:n]
        return mix(raw ^ np.uint64(size * 0x9E3779B97F4A7C15 & (2**64 - 1)))


# Longer words are hashed one by one.
LONG_WORD = 512
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, eight bytes at a time through the finaliser.

    Every block passes a finaliser before the next one joins, so unlike sums of powers there are no words whose
    terms cancel. Words longer than ``LONG_WORD`` bytes go through BLAKE2.
    """
    sizes = np.asarray(ends - starts)
    out = mix(sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    blocks = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    live, at = np.flatnonzero(sizes <= LONG_WORD), 0
    while len(live):
        left = sizes[live] - at
        value = blocks[starts[live] + at] & _MASKS[np.minimum(left, 8)]
        out[live] = mix((out[live] ^ value) * np.uint64(0xD1342543DE82EF95) + np.uint64(at + 1))
        at += 8
        live = live[left > 8]
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        whole = hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8).digest()
        out[i] = np.frombuffer(whole, "<u8")[0]
    return out


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and the offsets between them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes of text: ``(rows, bytes, offsets)``."""
    data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(last, first + 1))
        low = offsets[first]
        yield batch.slice(first, last - first), data[low : offsets[last]], offsets[first : last + 1] - low
        first = last


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and per text the number of the first word (one entry more)."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = table[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before &= ~cut[:n]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after &= ~cut[1:]
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def within(first: np.ndarray, size: int) -> np.ndarray:
    """Numbers of the words that start a run of ``size`` words inside one text."""
    counts = np.diff(first)
    n = np.maximum(counts - size + 1, 0)
    total = int(n.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    base = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(n)[:-1])), n)
    return np.arange(total) + base


def runs_of(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.diff(np.concatenate(([0], marked.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def combine(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """One fingerprint per run of ``size`` word fingerprints."""
    total = np.zeros(len(starts), np.uint64)
    for j in range(size):
        total = mix(total + hashes[starts + j] + np.uint64(j + 1))
    return total


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
