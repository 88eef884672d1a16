"""Schemas with columns of any type and name, which schema texts cannot hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType


def led_by(frame: DataFrame, column: str, name: str, rest: str) -> StructType:
    """``name`` with the type of a frame's column, then the columns of a schema text."""
    return StructType([StructField(name, frame.schema[column].dataType), *StructType.fromDDL(rest).fields])
