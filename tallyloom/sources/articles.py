"""Articles from a markup dump, an article per line or per record of several lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the dump format.
SEPARATOR = "</title><text>"
HEAD_CHARS = 14
TAIL_CHARS = 16
RECORD_END = "</page>"


def decode_articles(
    lines: DataFrame,
    column: str = "value",
    *,
    head: int = HEAD_CHARS,
    tail: int = TAIL_CHARS,
    separator: str = SEPARATOR,
) -> DataFrame:
    """``title`` and ``text`` of each line.

    The title runs from the end of the head to the first separator, the text from there to the
    tail. A line too short for that, or without a separator, raises.
    """
    line = F.col(column)
    placed = lines.select(
        line.alias("line"),
        F.locate(separator, line).alias("at"),
        F.length(line).alias("n"),
    )
    text_length = F.col("n") - F.col("at") - (len(separator) + tail - 1)
    sound = (F.col("at") > head) & (text_length >= 0)
    failure = F.raise_error(F.concat(F.lit("not an article line: "), F.substring("line", 1, 80)))

    def part(start, length):
        return F.when(sound, F.substring(F.col("line"), start, length)).otherwise(failure)

    return placed.select(
        part(F.lit(head + 1), F.col("at") - (head + 1)).alias("title"),
        part(F.col("at") + len(separator), text_length).alias("text"),
    )


def read_articles(
    spark: SparkSession, path: str, *, end: str = RECORD_END, head: int = HEAD_CHARS, tail: int = TAIL_CHARS, separator: str = SEPARATOR
) -> DataFrame:
    """``title`` and ``text`` of the articles of a dump whose texts hold line breaks.

    A record ends with ``end`` and a line end, the last one perhaps without the latter. The reader looks for that
    separator, so large files are still split among tasks. White space between records is left out; a record
    that is no article raises.
    """
    if not end or tail < len(end):
        raise ValueError("the tail must hold the end of a record")
    records = spark.read.option("lineSep", f"{end}\n").text(path)
    # Only the last record can still have its end.
    whole = F.regexp_replace(F.regexp_replace("value", r"^\s+", ""), rf"\Q{end}\E\s*\z", "")
    full = records.select(whole.alias("value")).where("value <> ''")
    return decode_articles(full, head=head, tail=tail - len(end), separator=separator)
