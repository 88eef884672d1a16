"""Everyday selections and aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, StringType, StructField, StructType

from tallyloom.functions.checked import parse_number

EMPLOYEE_SCHEMA = "id int, fname string, lname string, age int, city string"
LISTING_SCHEMA = "street string, zip int, price int"
POST_SCHEMA = "author int, forum string, likes int, date string"


def select_where_sort(
    frame: DataFrame, columns: Sequence[str], condition: Column | str, order: Sequence[str]
) -> DataFrame:
    """Some columns of the rows that fit, sorted. The condition may use columns not selected."""
    return frame.where(condition).select(*columns).orderBy(*order)


def young_team(employees: DataFrame, city: str = "Atlanta", below: int = 15) -> DataFrame:
    """``id, lname, fname`` of the employees in one city under an age, by id."""
    fits = (F.col("city") == city) & (F.col("age") < below)
    return select_where_sort(employees, ["id", "lname", "fname"], fits, ["id"])


def group_max(frame: DataFrame, key: str, value: str) -> DataFrame:
    return frame.groupBy(key).agg(F.max(value).alias(f"max_{value}"))


def group_min(frame: DataFrame, key: str, value: str) -> DataFrame:
    return frame.groupBy(key).agg(F.min(value).alias(f"min_{value}"))


def group_avg(frame: DataFrame, key: str, value: str) -> DataFrame:
    return frame.groupBy(key).agg(F.avg(value).alias(f"avg_{value}"))


def group_avg_typed(frame: DataFrame, key: str, value: str) -> DataFrame:
    """The same average under a fixed schema: the key keeps its type, the average is double."""
    name = f"avg_{value}"
    schema = StructType([frame.schema[key], StructField(name, DoubleType())])
    return group_avg(frame, key, value).to(schema)


def group_count_2key(frame: DataFrame, first: str, second: str) -> DataFrame:
    """Rows with a known ``first`` per pair, by ``second`` and then by falling count."""
    counted = frame.groupBy(first, second).agg(F.count(first).alias("n"))
    return counted.orderBy(second, F.desc("n"), first)


def row_count(frame: DataFrame) -> DataFrame:
    return frame.agg(F.count(F.lit(1)).alias("n"))


def global_sum(frame: DataFrame, value: str) -> DataFrame:
    """Sum of a whole-number column, 0 if there are no rows."""
    return frame.agg(F.coalesce(F.sum(value), F.lit(0).cast("bigint")).alias("total"))


def global_max(frame: DataFrame, value: str) -> DataFrame:
    """Largest value; no rows raise."""
    empty = F.raise_error(F.lit("the largest value of no rows is not defined"))
    return frame.agg(F.max(value).alias("m")).select(F.coalesce("m", empty).alias("largest"))


def row_extract(frame: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Untyped columns as typed ones.

    A column that has the asked type passes. Text is parsed, and raises at run time where it does
    not hold such a value. Any other type is the wrong one and raises here.
    """
    picked = []
    for name, wanted in fields.items():
        have = frame.schema[name].dataType
        column = F.col(f"`{name}`")
        if have != DataType.fromDDL(wanted):
            if not isinstance(have, StringType):
                raise TypeError(f"{name} is {have.simpleString()}, not {wanted}")
            parsed = parse_number(column, wanted, name)
            column = F.when(column.isNotNull(), parsed)
        picked.append(column.alias(name))
    return frame.select(*picked)
