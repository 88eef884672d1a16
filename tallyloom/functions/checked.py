"""Casts that raise on bad input whatever the session's ANSI setting is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGER = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_PATTERNS = {"int": _INTEGER, "bigint": _INTEGER, "double": _NUMBER}


def _or_raise(value: Column, text: Column, message: str) -> Column:
    shown = F.coalesce(text.cast("string"), F.lit("<missing>"))
    return F.coalesce(value, F.raise_error(F.concat(F.lit(f"{message}: "), shown)))


def parse_number(text: Column, data_type: str, field: str) -> Column:
    """Text to ``int``, ``bigint`` or ``double``; missing, padded or malformed text raises."""
    value = F.when(text.rlike(_PATTERNS[data_type]), text.try_cast(data_type))
    return _or_raise(value, text, f"{field} is not a valid {data_type}")


def parse_optional_number(text: Column, data_type: str, field: str) -> Column:
    """Like :func:`parse_number`, but an empty field is null."""
    return F.when(text == "", F.lit(None)).otherwise(parse_number(text, data_type, field))


def quoted(name: str) -> str:
    """A column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def not_null_sql(name: str) -> str:
    """SQL text of a column that raises where it is null. It prunes like the plain column.

    Text, because hundreds of columns are parsed sooner than built one object at a time.
    """
    message = f"{name} must not be null".replace("\\", "\\\\").replace("'", "\\'")
    return f"coalesce({quoted(name)}, raise_error('{message}')) AS {quoted(name)}"
