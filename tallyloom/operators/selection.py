"""Exact order statistics of weighted values per group, by counting ranges.

A value is looked at 16 bits at a time, highest first. Weights are added up per group and range; the range that holds the
wanted rank is found from at most 65,536 sums, and the next pass looks only into it. No group's values are ever held
together, whatever their number; each pass is one aggregation that adds up in the tasks first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

BITS = 16
_SIZES = {ByteType: 16, ShortType: 16, IntegerType: 32, LongType: 64}


def weighted_ranks(frame: DataFrame, group: str, value: str, weight: str, ranks: list[Column]) -> DataFrame:
    """``group, which, value``: per group the values at the given ranks, ``which`` numbering them from 0.

    A rank counts from 0 over the weights and may use the column ``total``, the weight of its group. Values are whole
    numbers; null values and weights below 1 are left out.
    """
    size = _SIZES.get(type(frame.schema[value].dataType))
    if size is None:
        raise ValueError(f"values must be whole numbers, not {frame.schema[value].dataType.simpleString()}")
    # The sign bit is turned, so that ranges rise with the values, and nothing stands above it.
    sign = F.lit(1 << (size - 1) if size < 64 else -(1 << 63))
    turned = F.col(value).cast("bigint").bitwiseXOR(sign)
    if size < 64:
        turned = turned.bitwiseAND(F.lit((1 << size) - 1))
    rows = frame.where(F.col(value).isNotNull() & (F.col(weight) > 0)).select(F.col(group).alias("group"), turned.alias("value"), F.col(weight).cast("bigint").alias("weight"))
    found = None
    for shift in range(size - BITS, -1, -BITS):
        digit = F.shiftrightunsigned("value", shift).bitwiseAND(F.lit((1 << BITS) - 1)).alias("digit")
        if found is None:
            keys, part = ["group"], rows
        else:
            keys = ["group", "which"]
            above = _prefix(F.col("value"), shift + BITS).alias("prefix")
            part = rows.select("*", above).join(found.withColumnRenamed("group", "g"), F.col("group").eqNullSafe(F.col("g")) & (F.col("prefix") == F.col("found")))
        sums = part.groupBy(*keys, *(["found", "rest"] if found is not None else []), digit).agg(F.sum("weight").alias("weight"))
        in_order = Window.partitionBy(*keys).orderBy("digit")
        upto = sums.withColumn("upto", F.sum("weight").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        if found is None:
            whole = Window.partitionBy(*keys)
            upto = upto.withColumn("total", F.sum("weight").over(whole))
            wanted = F.array(*[F.struct(F.lit(i).alias("which"), r.cast("bigint").alias("rest")) for i, r in enumerate(ranks)])
            upto = upto.select("group", "digit", "weight", "upto", F.inline(wanted), F.lit(0).cast("bigint").alias("found"))
        holds = (F.col("rest") >= F.col("upto") - F.col("weight")) & (F.col("rest") < F.col("upto"))
        chosen = F.shiftleft("found", BITS).bitwiseOR(F.col("digit"))
        found = upto.where(holds).select(
            "group", "which", chosen.alias("found"), (F.col("rest") - F.col("upto") + F.col("weight")).alias("rest")
        )
    back = F.col("found").bitwiseXOR(sign)
    if size < 64:
        back = F.shiftright(F.shiftleft(back, 64 - size), 64 - size)
    return found.select("group", "which", back.alias("value"))


def _prefix(value: Column, shift: int) -> Column:
    return F.shiftrightunsigned(value, shift) if shift < 64 else F.lit(0).cast("bigint")


def weighted_median(frame: DataFrame, group: str, value: str, weight: str) -> DataFrame:
    """``group`` and ``median``, the mean of the two middle values as a double."""
    total = F.col("total")
    middle = weighted_ranks(frame, group, value, weight, [F.floor((total - 1) / 2), F.floor(total / 2)])
    return middle.groupBy("group").agg(F.avg("value").alias("median")).withColumnRenamed("group", group)
