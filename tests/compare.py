"""Spark and DuckDB results as comparable rows."""

from __future__ import annotations

import glob
from pathlib import Path

import duckdb

# Spark type to the DuckDB type it must come out as.
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        connection.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    return "" if value is None else repr(value)


def difference(frame, connection, sql: str) -> str | None:
    """What differs between a frame and the SQL's result, None if nothing does."""
    names = sorted(frame.columns)
    spark_types = [TYPES.get(frame.schema[n].dataType.simpleString(), "?") for n in names]
    relation = connection.sql(sql)
    if sorted(relation.columns) != names:
        return f"columns {names} and {sorted(relation.columns)}"
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    oracle_types = [kinds[n] for n in names]
    if spark_types != oracle_types:
        return f"types of {names}: {spark_types} and {oracle_types}"
    ours = sorted(tuple(_cell(r[n]) for n in names) for r in frame.collect())
    places = [relation.columns.index(n) for n in names]
    theirs = sorted(tuple(_cell(r[i]) for i in places) for r in relation.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
