"""Exact-size samples that depend only on the seed and the row ids.

Rows are ordered by a hash of seed and id, which gives the same sample however the rows are
partitioned and when a task runs again. The id must be unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 42


def _lot(seed: int, row_id: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(row_id).cast("string")).cast("binary"))


def sample_uniform(
    vectors: DataFrame, size: int, seed: int = SEED, row_id: str = "qid"
) -> DataFrame:
    """``size`` rows without replacement (fewer only if there are fewer).

    Each task keeps its ``size`` lowest rows, so no full sort takes place.
    """
    return vectors.orderBy(_lot(seed, row_id), row_id).limit(size)


def sample_stratified(
    vectors: DataFrame, per_stratum: int, seed: int = SEED, stratum: str = "x", row_id: str = "qid"
) -> DataFrame:
    """``per_stratum`` rows of each stratum, with their ``rank`` in it.

    The limit on the rank is applied in each task before the shuffle as well, so a stratum
    holding most rows sends no more than the others.
    """
    order = Window.partitionBy(stratum).orderBy("lot", row_id)
    return (
        vectors.withColumn("lot", _lot(seed, row_id))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= per_stratum)
        .drop("lot")
    )


def sample_points(points: DataFrame, size: int, seed: int = SEED, stratum: str | None = None) -> DataFrame:
    """``size`` vectors without replacement from weighted points ``x, y, wt``: ``x, y, copy, key``, ``copy`` from 1.

    Each of a point's ``wt`` vectors would draw an exponential lot and the lowest ``size`` lots of all would win. A point's
    ``k`` lowest lots are sums of ``k`` exponentials, each divided by the vectors still left, so at most ``size``
    rows per point are made instead of ``wt``. Lots depend on seed, point and number only; samples of parts
    of the points merge by their lowest keys. With ``stratum`` there are ``size`` rows of each of its values.
    """
    place = F.concat_ws(":", F.lit(str(seed)), F.col("x").cast("string"), F.col("y").cast("string"), F.col("copy").cast("string"))
    # 52 bits of a digest as a number inside (0, 1).
    uniform = (F.conv(F.substring(F.md5(place.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.col("wt"), F.lit(size).cast("bigint"))))
    rows = points.where("wt > 0").select("x", "y", "wt", copies.alias("copy"))
    spaced = rows.withColumn("step", -F.log(uniform) / (F.col("wt") - F.col("copy") + 1))
    running = Window.partitionBy("x", "y").orderBy("copy").rowsBetween(Window.unboundedPreceding, 0)
    lots = spaced.select("x", "y", "copy", F.sum("step").over(running).alias("key"))
    if stratum is None:
        return lots.orderBy("key", "x", "y").limit(size)
    order = Window.partitionBy(stratum).orderBy("key", "x", "y")
    return lots.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
