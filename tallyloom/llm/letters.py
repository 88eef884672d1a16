"""Words of letters, as code points."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from tallyloom.llm import text as tx

_tables: list[np.ndarray] = []


def characters() -> tuple[np.ndarray, np.ndarray]:
    """Whether each code point is a letter, and its small letter."""
    if not _tables:
        letter = np.zeros(0x110000, bool)
        small = np.arange(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            character = chr(c)
            if character.isalpha():
                letter[c] = True
                lowered = character.lower()
                if len(lowered) == 1:
                    small[c] = ord(lowered)
        _tables.extend((letter, small))
    return _tables[0], _tables[1]


class LetterWords(NamedTuple):
    """The letter words of a piece."""

    points: np.ndarray  # small letters as code points, anything else a space
    inside: np.ndarray  # whether a letter
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # first word per text, one entry more
    places: np.ndarray  # offsets of the texts in code points


def letter_words(data: np.ndarray, offsets: np.ndarray) -> LetterWords:
    letter, small = characters()
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    leading = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    places = leading[offsets]
    inside = letter[points]
    starts, ends, first = tx.words(inside.view(np.uint8), places, np.arange(256) == 1)
    return LetterWords(np.where(inside, small[points], np.uint32(32)), inside, starts, ends, first, places)
