"""Data checks: compare two sets of rows, find breaks of a descending order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

UNEXPECTED, MISSING = "unexpected", "missing"
# Rows that share a range of positions, and so a task.
RANGE_ROWS = 5_000_000


def set_reconcile(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Distinct rows on one side only, with ``side`` unexpected or missing.

    Both sides go through one aggregation that drops copies before the shuffle. As in a set,
    copies are ignored and nulls equal each other.
    """
    columns = actual.columns
    both = actual.withColumn("_side", F.lit(1)).unionByName(
        expected.withColumn("_side", F.lit(0))
    )
    seen = both.groupBy(*columns).agg(F.min("_side").alias("_low"), F.max("_side").alias("_high"))
    side = F.when(F.col("_high") == 0, MISSING).otherwise(UNEXPECTED)
    return seen.where("_low = _high").select(side.alias("side"), *columns)


def order_check(
    frame: DataFrame, group: Sequence[str], position: str, value: str, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Neighbours in a group where the value rises: group, position, value and ``previous``.

    Positions are numbers, dates or timestamps, distinct within a group; null comes first. Rows are dealt by ranges of group
    and position, of about ``range_rows`` rows by the size the optimiser expects. Neighbours are compared within each
    range of a group, and the first row of each range with the last one of the range before, so no task sorts a whole
    large group. The bounds of the ranges come from the sample Spark takes of each input partition.
    """
    kind = frame.schema[position].dataType
    if not isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)):
        raise ValueError(f"positions must be numbers, dates or timestamps, not {kind.simpleString()}")
    rows = frame.select(*group, F.col(position).alias("pos"), F.col(value).alias("value"))
    ranges = _ranges(rows, range_rows)
    if ranges > 1:
        rows = rows.repartitionByRange(ranges, *group, "pos")
    cut = rows.withColumn("range", F.spark_partition_id() if ranges > 1 else F.lit(0))
    inside = Window.partitionBy(*group, "range").orderBy("pos")
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = cut.select(
        "*",
        F.lag("value").over(inside).alias("before"),
        (F.row_number().over(inside) == 1).alias("first"),
        F.last("value").over(whole).alias("last"),
    ).where("first OR before < value")
    # Only first rows meet across ranges; the others keep to theirs.
    apart = F.when(~F.col("first"), F.col("range"))
    across = Window.partitionBy(*group, apart).orderBy("range")
    previous = F.when(F.col("first"), F.lag("last").over(across)).otherwise(F.col("before"))
    return seen.withColumn("previous", previous).where("previous < value").select(*_shown(group, position, value))


def _ranges(rows: DataFrame, range_rows: int) -> int:
    """How many ranges the expected size asks for; as many as shuffles have partitions if nothing is known of it."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 60:
        return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-size // (8 * (1 + len(rows.columns)) * range_rows)))


def _shown(group: Sequence[str], position: str, value: str) -> list[Column]:
    return [
        *[F.col(name) for name in group],
        F.col("pos").alias(position),
        F.col("value").alias(value),
        F.col("previous"),
    ]
