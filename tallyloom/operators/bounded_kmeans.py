"""k-means that leaves out distances which bounds prove to be needless.

Every point keeps its cluster, an upper bound of the distance to its mean and a lower bound of that to any other mean, as
columns of a table that is written once per round. When means move, the bounds move with them. A point whose
upper bound lies below its lower bound, or below half the way from its mean to the nearest other mean, stays without
any distance computed; otherwise first the distance to its own mean is taken, and only then those to all means.

The means are those of :func:`tallyloom.operators.kmeans.kmeans` in every round, ties included: a point is only left alone
when its mean is closer than any other by more than rounding can hide.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import dist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.geometry import Point, means_distance
from tallyloom.operators.kmeans import ETA, MAX_ITERATIONS, Clustering, Round, _moved
from tallyloom.scratch import discard, written

# Rounding in sums of bounds is far below this share of them.
SLACK = 1e-9


def _squared(x: str, y: str) -> str:
    dx, dy = (f"(cast(`{a}` AS double) - cast({b} AS double))" for a, b in (("x", x), ("y", y)))
    return f"({dx} * {dx} + {dy} * {dy})"


def _two_nearest(means: Sequence[Point]) -> str:
    """``d1, i1, d2``: the closest mean, the first on a tie, and the squared distance of the next."""
    table = ", ".join(f"struct({i} AS i, {x} AS x, {y} AS y)" for i, (x, y) in enumerate(means))
    far = "cast('Infinity' AS double)"
    return (
        f"aggregate(transform(array({table}), c -> struct({_squared('c.x', 'c.y')} AS d, c.i AS i)), "
        f"struct({far} AS d1, -1 AS i1, {far} AS d2), (s, e) -> CASE "
        "WHEN e.d < s.d1 THEN struct(e.d AS d1, e.i AS i1, s.d1 AS d2) "
        "WHEN e.d < s.d2 THEN struct(s.d1 AS d1, s.i1 AS i1, e.d AS d2) ELSE s END)"
    )


def _numbers(values: Sequence[float]) -> str:
    return "array(" + ", ".join(f"{float(v)!r}D" if v != float("inf") else "cast('Infinity' AS double)" for v in values) + ")"


def _from_all(means: Sequence[Point], before: int) -> str:
    """Cluster and bounds from all distances; ``before`` were computed already."""
    near = _two_nearest(means)
    return f"transform(array({near}), n -> struct(n.i1 AS cluster, sqrt(n.d1) AS upper, sqrt(n.d2) AS lower, {before + len(means)}L AS computed))[0]"


def _first_assignment(points: DataFrame, means: Sequence[Point]) -> DataFrame:
    return points.select("x", "y", "wt", F.expr(_from_all(means, 0)).alias("at")).select("x", "y", "wt", "at.*")


def _next_assignment(state: DataFrame, old: Sequence[Point], new: Sequence[Point]) -> DataFrame:
    drift = [dist(a, b) for a, b in zip(old, new)]
    others = [max((d for j, d in enumerate(drift) if j != i), default=0.0) for i in range(len(new))]
    apart = [min((dist(a, b) / 2 for j, b in enumerate(new) if j != i), default=float("inf")) for i, a in enumerate(new)]
    own = lambda values: f"{_numbers(values)}[cluster]"
    moved = state.selectExpr(
        "x", "y", "wt", "cluster", f"(upper + {own(drift)}) * {1 + SLACK!r}D AS upper", f"(lower - {own(others)}) * {1 - SLACK!r}D AS lower",
        f"{own(apart)} * {1 - SLACK!r}D AS apart",
    )
    xs, ys = (f"array({', '.join(str(m[k]) for m in new)})[cluster]" for k in (0, 1))
    tight = f"sqrt({_squared(xs, ys)})"
    bound = "greatest(lower, apart)"
    at = (
        f"CASE WHEN upper < {bound} THEN struct(cluster, upper, lower, 0L AS computed) "
        f"WHEN {tight} * {1 + SLACK!r}D < {bound} THEN struct(cluster, {tight} AS upper, lower, 1L AS computed) "
        f"ELSE {_from_all(new, 1)} END"
    )
    return moved.select("x", "y", "wt", F.expr(at).alias("at")).select("x", "y", "wt", "at.*")


def bounded_kmeans(points: DataFrame, means: Sequence[Point], *, start: int = 1, max_iterations: int = MAX_ITERATIONS, eta: float = ETA) -> Clustering:
    """Rounds as in ``kmeans``, over weighted points ``x, y, wt``; ``computed`` of a round counts its distances."""
    history: list[Round] = []
    current, iteration = list(means), start
    state = written(_first_assignment(points, current), "bounded-points")
    while True:
        sums = state.groupBy("cluster").agg(
            F.sum(F.col("x") * F.col("wt")).alias("sx"), F.sum(F.col("y") * F.col("wt")).alias("sy"), F.sum("wt").alias("size"), F.sum("computed").alias("computed")
        )
        rows = sums.selectExpr("cluster", "cast(sx div size AS int) AS x", "cast(sy div size AS int) AS y", "size", "computed").collect()
        new, sizes = _moved(rows, current)
        distance = means_distance(current, new)
        history.append(Round(iteration, distance, current, new, sizes, sum(row["computed"] for row in rows)))
        done = distance < eta
        if done or iteration >= max_iterations:
            discard(state)
            return Clustering(new, done, history)
        following = written(_next_assignment(state, current, new), "bounded-points")
        discard(state)
        state, current, iteration = following, new, iteration + 1
