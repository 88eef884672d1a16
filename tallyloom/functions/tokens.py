"""Whole-token matching on text split at single spaces.

A token is what stands between two single spaces, so ``"Java,"`` is not ``"Java"`` and a line
break does not separate tokens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def check_vocabulary(vocabulary: Sequence[str]) -> list[str]:
    """Terms as a list; repeated or empty terms would make the counts ambiguous."""
    terms = list(vocabulary)
    if not terms or any(not term for term in terms):
        raise ValueError("the vocabulary needs at least one term and no empty ones")
    if len(set(terms)) != len(terms):
        raise ValueError("the vocabulary must not repeat a term")
    return terms


def literal_array(terms: Sequence[str]) -> Column:
    return F.array(*[F.lit(term) for term in terms])


def tokens(text: Column) -> Column:
    return F.split(text, " ")


def mentions_term(text: Column, term: str) -> Column:
    """Whether one term is a token of the text.

    Looking for the term between spaces in the padded text equals splitting and searching, without
    building the token array. A term holding a space can never be a token.
    """
    if not term:
        raise ValueError("the term must not be empty")
    if " " in term:
        return F.lit(False)
    return F.contains(F.concat(F.lit(" "), text, F.lit(" ")), F.lit(f" {term} "))


def mentioned_terms(text: Column, terms: Sequence[str]) -> Column:
    """The distinct vocabulary terms among the text's tokens."""
    return F.array_intersect(tokens(text), literal_array(terms))
