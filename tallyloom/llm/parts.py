"""Token ids of whole batches from the parts between spaces and line ends.

Tokenizers that start a piece at every single space and line end give a text the ids of its parts. Arrow
splits a batch into parts and encodes them as a dictionary; each tokenizer encodes a part once and keeps its ids in one
flat array, from which numpy gathers the ids of all texts. Texts for which the split would change ids are encoded
whole. What a worker keeps is bounded.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Parts a worker keeps; half as many, the most frequent ones, when it has more.
KEPT_PARTS = 300_000
LINE_END = "\n"
# Marks a part that follows no space.
UNSPACED = "\0"
AFTER_LINE_END = chr(ord(LINE_END) + 1)

# Lead bytes of the UTF-8 forms of white space and joiners beyond ASCII, and of the space mark U+2581.
WIDE_SPACE = ((0xC2, 0x85), (0xC2, 0xA0), (0xE1, 0x9A), (0xE1, 0xA0), (0xE2, 0x80), (0xE2, 0x81), (0xE2, 0x96), (0xE3, 0x80), (0xEF, 0xBB))
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True


def separable(data: np.ndarray, offsets: np.ndarray, inner: bool = False) -> np.ndarray:
    """Texts in which no two white-space characters meet and none lies beyond ASCII, nor a NUL byte.

    With ``inner`` they neither start with white space nor end with a space either.
    """
    n = len(data)
    odd = data == 0
    if n > 1:
        blank = _BLANK[data]
        odd[1:] |= blank[1:] & blank[:-1]
        lead = np.flatnonzero(data[:-1] >= 0xC2)
        pair = data[lead].astype(np.int32) << 8 | data[lead + 1]
        odd[lead[np.isin(pair, [a << 8 | b for a, b in WIDE_SPACE])]] = True
    seen = np.concatenate(([0], np.cumsum(odd)))
    fine = seen[offsets[1:]] == seen[offsets[:-1]]
    if inner and n:
        full = offsets[1:] > offsets[:-1]
        ends = _BLANK[data[np.minimum(offsets[:-1], n - 1)]] | (data[np.maximum(offsets[1:] - 1, 0)] == 32)
        fine &= ~(full & ends)
    return fine


def as_strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    wide = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes()))
    return wide.cast(pa.string())


class Kept:
    """Ids of the parts seen, for each tokenizer in one flat array that grows by doubling.

    Beyond ``most`` parts those go that few batches had.
    """

    def __init__(self, encoders: list[Callable[[list[str]], tuple[np.ndarray, np.ndarray]]], most: int):
        self.encoders, self.most = encoders, most
        self.number: dict[str, int] = {}
        self.seen = np.zeros(0, np.int32)
        self.ids = [np.zeros(0, np.int32) for _ in encoders]
        self.starts = [np.zeros(1, np.int64) for _ in encoders]

    def places(self, parts: list[str]) -> np.ndarray:
        """The numbers of distinct parts, which are encoded where they are new."""
        if len(self.number) > self.most:
            self._forget()
        known = self.number
        at = np.fromiter(map(known.get, parts, repeat(-1)), np.int64, len(parts))
        new = np.flatnonzero(at < 0)
        if new.size:
            first = len(known)
            missing = [parts[i] for i in new.tolist()]
            at[new] = np.arange(first, first + new.size)
            known.update(zip(missing, range(first, first + new.size)))
            self.seen = _grown(self.seen, first, np.zeros(new.size, np.int32))
            for k, encode in enumerate(self.encoders):
                ids, sizes = encode(missing)
                end = int(self.starts[k][first])
                self.ids[k] = _grown(self.ids[k], end, ids)
                self.starts[k] = _grown(self.starts[k], first + 1, end + np.cumsum(sizes))
        self.seen[at] += 1
        return at

    def _forget(self) -> None:
        n, least = len(self.number), 2
        while (keep := np.flatnonzero(self.seen[:n] >= least)).size > self.most // 2:
            least += 1
        names = list(self.number)
        self.number = {names[i]: j for j, i in enumerate(keep.tolist())}
        self.seen = self.seen[keep]
        for k in range(len(self.encoders)):
            self.ids[k], sizes = self.gathered(k, keep)
            self.starts[k] = np.concatenate(([0], np.cumsum(sizes)))

    def gathered(self, k: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the parts at the places, one after the other, and how many each has."""
        first = self.starts[k][places]
        sizes = self.starts[k][places + 1] - first
        stops = np.cumsum(sizes)
        source = np.repeat(first - stops + sizes, sizes)
        source += np.arange(len(source))
        return self.ids[k][source], sizes


def _grown(held: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``more`` after the first ``used`` entries; there is room for further ones behind them."""
    if len(held) < used + len(more):
        held = np.concatenate((held[:used], np.zeros(max(used, 2 * len(more), 1 << 10), held.dtype)))
    held[used : used + len(more)] = more
    return held


def flat(found: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids as one array and their lengths."""
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum())), sizes


_CONTROL_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f]")


class JsonTokenizer:
    """A tokenizer from a tokenizers file; ``by_parts`` says whether parts may be encoded on their own.

    With ``plain`` the strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        described = json.loads(self.tokenizer.to_str())
        before = described.get("pre_tokenizer") or {}
        added = described.get("added_tokens") or []
        line_end = self.whole([LINE_END])[0]
        self.line_end = line_end[0] if len(line_end) else -1
        self.byte_level = before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
        self.by_parts = (
            self.byte_level and before.get("use_regex", True) and described.get("normalizer") is None and len(line_end) == 1
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"].split() != [t["content"]] for t in added)
        )

    def whole(self, texts: list[str]) -> list[Sequence[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _lines(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Texts without line ends, white space at their end, or more than one space at their start: one call for all."""
        # White space other than spaces could join the line ends put between the texts.
        joined = LINE_END.join(texts)
        if texts and not _CONTROL_SPACE.search(joined):
            ids = np.array(self.whole([joined])[0], np.int32)
            ends = np.append(np.flatnonzero(ids == self.line_end), len(ids))
            if len(ends) == len(texts):
                return np.delete(ids, ends[:-1]), np.diff(ends, prepend=-1) - 1
        return flat(self.whole(texts))

    def parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts, one after the other, and how many each has.

        Parts are marked with ``UNSPACED`` where they follow no space.
        """
        bare, marked = np.zeros(len(parts), bool), np.zeros(len(parts), bool)
        # Only few parts begin with so low a character, and all that are bare or marked do.
        for i in [i for i, p in enumerate(parts) if p < AFTER_LINE_END]:
            bare[i] = parts[i] in ("", UNSPACED, LINE_END)
            marked[i] = parts[i][:1] == UNSPACED and not bare[i]
        total, out = np.zeros(len(parts), np.int64), {}
        kinds = (
            (marked, lambda own: self._lines([p[1:] for p in own])),
            (~marked & ~bare, lambda own: self._lines([f" {p}" for p in own])),
            (bare, lambda own: flat([{UNSPACED: [], LINE_END: [self.line_end]}[p] if p else self.whole([" "])[0] for p in own])),
        )
        for n, (mask, encode) in enumerate(kinds):
            out[n], total[mask] = encode([parts[i] for i in np.flatnonzero(mask).tolist()])
        ids = np.empty(total.sum(), np.int32)
        for n, (mask, _) in enumerate(kinds):
            ids[np.repeat(mask, total)] = out[n]
        return ids, total


class PartEncoder:
    """Ids of a batch of texts by one or more tokenizers that agree on where parts begin.

    ``whole`` are functions that encode lists of whole texts, ``parts`` those that encode parts; ``first_spaced`` says that
    a text's first part counts as following a space.
    """

    def __init__(self, whole: list[Callable], parts: list[Callable], *, first_spaced: bool, most_parts: int = KEPT_PARTS):
        self.whole, self.first_spaced = whole, first_spaced
        self.kept = Kept(parts, most_parts)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per tokenizer the ids of all texts one after the other, and how many each text has."""
        fine = separable(data, offsets, self.first_spaced)
        texts = as_strings(data, offsets)
        if self.first_spaced:
            fine &= np.diff(offsets) > 0
        distinct, order, bounds = self._parts(texts.filter(pa.array(fine)))
        places = self.kept.places(distinct)[order]
        rest = texts.filter(pa.array(~fine)).to_pylist()
        out = []
        for k, encode in enumerate(self.whole):
            ids, sizes = self.kept.gathered(k, places)
            stops = np.concatenate(([0], np.cumsum(sizes)))[bounds]
            counts = np.diff(stops)
            if rest:
                ids, counts = _interleaved(ids, counts, *flat(encode(rest)), fine)
            out.append((ids, counts))
        return out

    def _parts(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct parts, the number of each part in order, and the offsets of texts among them."""
        marked = pc.replace_substring(texts, LINE_END, f" {LINE_END} {UNSPACED}")
        if not self.first_spaced:
            marked = pc.binary_join_element_wise(pa.scalar(UNSPACED), marked, "")
        listed = pc.split_pattern(marked, " ")
        coded = listed.flatten().dictionary_encode()
        bounds = np.concatenate(([0], np.cumsum(listed.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
        return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False), bounds


def _interleaved(ids: np.ndarray, counts: np.ndarray, others: np.ndarray, sizes: np.ndarray, fine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in order, from those of the ``fine`` ones and those of the others."""
    total = np.zeros(len(fine), np.int64)
    total[fine], total[~fine] = counts, sizes
    out = np.empty(total.sum(), np.int32)
    own = np.repeat(fine, total)
    out[own], out[~own] = ids, others
    return out, total
