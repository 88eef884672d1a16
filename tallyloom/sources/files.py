"""File readers: text lines, delimited surveys, typed JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tallyloom.functions.checked import not_null_sql, quoted


# How JSON timestamps are written and read.
TIMESTAMPS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line, in column ``value``."""
    return spark.read.text(path)


def header_names(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line; only the first line is read."""
    return spark.read.option("header", True).csv(path).columns


def survey_schema(names: Sequence[str]) -> StructType:
    """First column text, all others double, none nullable."""
    if not names:
        raise ValueError("the header names no columns")
    first, *rest = names
    return StructType(
        [StructField(first, StringType(), False)]
        + [StructField(name, DoubleType(), False) for name in rest]
    )


def read_survey(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """Header-named CSV as text id plus doubles.

    File readers ignore ``nullable=False``, so the check is part of each column: a value that is
    missing or no number raises as soon as a query uses its column. An empty id is the empty text.
    """
    names = header_names(spark, path)
    raw = (
        spark.read.options(header=True, enforceSchema=False, mode="FAILFAST")
        .schema(survey_schema(names))
        .csv(path)
    )
    first, *rest = names
    identifier = f"coalesce({quoted(first)}, '') AS {quoted(first)}"
    return names, raw.selectExpr(identifier, *map(not_null_sql, rest))


def read_inferred(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """Header-named CSV with inferred types. Inference reads the whole input once more; broken lines raise."""
    frame = spark.read.options(header=True, inferSchema=True, mode="FAILFAST").csv(path)
    return frame.columns, frame


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines under a given schema, so nothing is inferred.

    A line that is no JSON and a value of another type raise. Timestamps may have microseconds.
    """
    return spark.read.schema(schema).options(mode="FAILFAST", **TIMESTAMPS).json(path)
