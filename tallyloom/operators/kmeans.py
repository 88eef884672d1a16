"""Integer k-means on two-dimensional points, and the report on its clusters."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions.geometry import Point, means_distance, nearest_center, nearest_center_few
from tallyloom.functions.tokens import check_vocabulary, literal_array
from tallyloom.operators.selection import weighted_median
from tallyloom.operators.sampling import SEED, sample_stratified, sample_uniform

# The clustering's default parameters.
SPREAD = 50_000
KERNELS = 45
ETA = 20.0
MAX_ITERATIONS = 120
# Below this spread the topics lie so close that start points are drawn regardless of topic.
STRATIFY_FROM = 500

# The text report's header and line format.
REPORT_HEADER = (
    "Resulting clusters:",
    "  Score  Dominant language (%percent)  Questions",
    "================================================",
)
REPORT_LINE = "%7d  %-17s (%-5.1f%%)      %7d"


@dataclass(frozen=True)
class Round:
    iteration: int
    distance: float
    old: list[Point]
    new: list[Point]
    sizes: list[int]
    # Distances between points and means that were computed; -1 if they were not counted.
    computed: int = -1


@dataclass(frozen=True)
class Clustering:
    means: list[Point]
    converged: bool
    history: list[Round] = field(default_factory=list)

    def means_frame(self, spark: SparkSession) -> DataFrame:
        """``cluster, x, y``. An inline table, for which Spark starts no Python workers."""
        rows = ", ".join(f"({i}, {x}, {y})" for i, (x, y) in enumerate(self.means))
        return spark.sql(f"SELECT * FROM VALUES {rows} AS means(cluster, x, y)")

    def history_frame(self, spark: SparkSession) -> DataFrame:
        """One row per round and cluster: how its mean moved, and the vectors it had when the means were taken."""
        rows = ", ".join(
            f"({r.iteration}, {i}, {old[0]}, {old[1]}, {new[0]}, {new[1]}, {size}L, {means_distance([old], [new])!r}D)"
            for r in self.history
            for i, (old, new, size) in enumerate(zip(r.old, r.new, r.sizes))
        )
        names = "iteration, cluster, old_x, old_y, new_x, new_y, size, distance"
        return spark.sql(f"SELECT * FROM VALUES {rows} AS history({names})")

    def rounds_frame(self, spark: SparkSession) -> DataFrame:
        """One row per round: the distance all means moved together, and the distances computed for it."""
        rows = ", ".join(f"({r.iteration}, {r.distance!r}D, {r.computed}L)" for r in self.history)
        return spark.sql(f"SELECT * FROM VALUES {rows} AS rounds(iteration, distance, computed)")


def compact(vectors: DataFrame) -> DataFrame:
    """Distinct points ``x, y`` with their number ``wt``.

    Sums, counts, modes and medians can all be weighted, so clustering the points equals
    clustering the vectors, and there are only as many as topics times different scores.
    """
    return vectors.groupBy("x", "y").agg(F.count(F.lit(1)).alias("wt"))


def initial_means(
    vectors: DataFrame,
    topics: int,
    kernels: int = KERNELS,
    spread: int = SPREAD,
    seed: int = SEED,
    stratify_from: int = STRATIFY_FROM,
) -> list[Point]:
    """Start points drawn from the vectors, at most ``kernels`` rows collected.

    From a spread of ``stratify_from`` on, every topic gets its share of them; it says how far topics lie apart
    and has nothing to do with the number of vectors.
    """
    if spread < stratify_from:
        drawn = sample_uniform(vectors, kernels, seed).select("x", "y").collect()
    else:
        if kernels % topics:
            raise ValueError("the number of kernels must be a multiple of the number of topics")
        share = kernels // topics
        sample = sample_stratified(vectors, share, seed).select("x", "rank", "y").collect()
        drawn = [(x, y) for x, _, y in sorted(sample)]
        sizes = Counter(x for x, _ in drawn)
        short = sorted(x // spread for x, n in sizes.items() if n < share)
        if short:
            raise ValueError(f"topics {short} have fewer than {share} vectors")
    if len(drawn) != kernels:
        raise ValueError(f"{len(drawn)} start points drawn, {kernels} needed")
    return [(x, y) for x, y in drawn]


def assign(points: DataFrame, means: Sequence[Point], few: bool = False) -> DataFrame:
    """The points with the index of their closest mean as ``cluster``."""
    closest = nearest_center_few if few else nearest_center
    return points.withColumn("cluster", closest("x", "y", means))


def cluster_means(points: DataFrame, means: Sequence[Point], few: bool = False) -> DataFrame:
    """``cluster, x, y, size``: whole-number mean of each cluster that has points."""
    sums = assign(points, means, few).groupBy("cluster").agg(
        F.sum(F.col("x") * F.col("wt")).alias("sx"),
        F.sum(F.col("y") * F.col("wt")).alias("sy"),
        F.sum("wt").alias("size"),
    )
    return sums.selectExpr(
        "cluster", "cast(sx div size AS int) AS x", "cast(sy div size AS int) AS y", "size"
    )


def kmeans_step(points: DataFrame, means: Sequence[Point], few: bool = False) -> list[Point]:
    """New means; a cluster without points keeps its old one. Collects one row per mean."""
    return _moved(cluster_means(points, means, few).collect(), means)[0]


def _moved(sums: list[Row], means: Sequence[Point]) -> tuple[list[Point], list[int]]:
    """New means and the vectors of each, from one row per cluster that has any."""
    found = {row["cluster"]: row for row in sums}
    new = [(found[i]["x"], found[i]["y"]) if i in found else old for i, old in enumerate(means)]
    return new, [found[i]["size"] if i in found else 0 for i in range(len(means))]


def kmeans(
    points: DataFrame,
    means: Sequence[Point],
    *,
    start: int = 1,
    max_iterations: int = MAX_ITERATIONS,
    eta: float = ETA,
    few: bool = True,
) -> Clustering:
    """Rounds until the means move less than ``eta`` or round ``max_iterations`` is done.

    Rounds count from ``start``. Each is one aggregation over the points that returns a row per
    mean; the means go back as literals, so the plan does not grow. Keep the points cached.
    With ``few`` distances are interpreted, which saves compiling each round; without it they are
    compiled, which pays for points by the million. Both give the same means.
    """
    history: list[Round] = []
    current = list(means)
    iteration = start
    while True:
        sums = cluster_means(points, current, few).collect()
        new, sizes = _moved(sums, current)
        distance = means_distance(current, new)
        history.append(Round(iteration, distance, current, new, sizes))
        current = new
        if distance < eta:
            return Clustering(current, True, history)
        if iteration >= max_iterations:
            return Clustering(current, False, history)
        iteration += 1


def cluster_results(
    points: DataFrame, means: Sequence[Point], vocabulary: Sequence[str], spread: int = SPREAD
) -> DataFrame:
    """``label, percent, size, median`` per cluster that has points, by median.

    The label is the cluster's most frequent topic, the first in the vocabulary on a tie, and
    percent its share. The median is that of the scores, cut to a whole number. It is selected by counts of ranges
    of scores, so no cluster's scores are ever held together.
    """
    terms = literal_array(check_vocabulary(vocabulary))
    assigned = assign(points, means)
    topics = assigned.groupBy("cluster", "x").agg(F.sum("wt").alias("n"))
    top = topics.groupBy("cluster").agg(
        F.max(F.struct("n", (-F.col("x")).alias("before"))).alias("top"), F.sum("n").alias("size")
    )
    scores = weighted_median(assigned, "cluster", "y", "wt").withColumn("median", F.col("median").cast("int"))
    topic = F.expr(f"-top.before div {int(spread)}").cast("int")
    return (
        top.join(scores, "cluster")
        .select(
            "cluster",
            F.element_at(terms, topic + 1).alias("label"),
            (F.lit(100.0) * F.col("top.n") / F.col("size")).alias("percent"),
            "size",
            "median",
        )
        .orderBy("median", "cluster")
        .drop("cluster")
    )


def cluster_report(results: DataFrame) -> DataFrame:
    """One fixed-width text ``line`` per cluster, in the order of the results."""
    return results.select(
        F.format_string(REPORT_LINE, "median", "label", "percent", "size").alias("line")
    )


def report_rows(results: DataFrame) -> DataFrame:
    """``number, line`` of the whole report, the header's lines first; numbers start at 1."""
    lines = cluster_report(results).withColumn("place", F.monotonically_increasing_id())
    # A row per cluster: one task numbers them.
    number = F.row_number().over(Window.orderBy("place")) + F.lit(len(REPORT_HEADER))
    header = results.sparkSession.range(1).select(F.posexplode(literal_array(REPORT_HEADER)).alias("place", "line"))
    return header.select((F.col("place") + 1).alias("number"), "line").unionByName(lines.select(number.alias("number"), "line"))


def print_report(results: DataFrame) -> None:
    """Header and lines on standard output; one line per cluster is collected."""
    print("\n".join([*REPORT_HEADER, *(row["line"] for row in cluster_report(results).collect())]))
