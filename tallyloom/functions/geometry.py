"""Squared distances between two-dimensional integer points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Point = tuple[int, int]


def means_distance(old: Sequence[Point], new: Sequence[Point]) -> float:
    """Sum of squared distances between two mean lists of the same length."""
    if len(old) != len(new):
        raise ValueError("mean lists differ in length")
    return float(sum((a - c) ** 2 + (b - d) ** 2 for (a, b), (c, d) in zip(old, new)))


def nearest_center(x: str, y: str, centers: Sequence[Point]) -> Column:
    """Index of the closest centre for columns ``x`` and ``y``; on a tie the lowest index wins.

    For many rows: the distances are plain arithmetic inside generated code, which compiles anew for
    every list of centres. Written as SQL text, since a tree of column objects takes longer to
    build than a round over compacted points takes to run.
    """
    distances = "array(" + ", ".join(_distance_sql(x, y, cx, cy) for cx, cy in _some(centers)) + ")"
    return F.expr(f"cast(array_position({distances}, array_min({distances})) AS int) - 1")


def nearest_center_few(x: str, y: str, centers: Sequence[Point]) -> Column:
    """The same index for few rows and many rounds.

    The centres are one array literal that is interpreted, so there is nothing to compile when
    they change.
    """
    table = ", ".join(
        f"struct({i} AS i, {cx} AS x, {cy} AS y)" for i, (cx, cy) in enumerate(_some(centers))
    )
    ranked = f"struct({_distance_sql(x, y, 'c.x', 'c.y')} AS d, c.i AS i)"
    return F.expr(f"array_min(transform(array({table}), c -> {ranked})).i")


def _some(centers: Sequence[Point]) -> Sequence[Point]:
    if not centers:
        raise ValueError("at least one centre is needed")
    return centers


def _distance_sql(x: str, y: str, cx, cy) -> str:
    dx, dy = (f"(cast(`{a}` AS double) - cast({b} AS double))" for a, b in ((x, cx), (y, cy)))
    return f"({dx} * {dx} + {dy} * {dy})"
