"""Question-and-answer postings from comma-separated lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tallyloom.functions.checked import parse_number, parse_optional_number

POSTING_SCHEMA = StructType(
    [
        StructField("posting_type", IntegerType(), False),
        StructField("id", LongType(), False),
        StructField("accepted_answer", LongType(), True),
        StructField("parent_id", LongType(), True),
        StructField("score", IntegerType(), False),
        StructField("tags", StringType(), True),
    ]
)


def decode_postings(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines ``type,id,accepted,parent,score[,tags]`` as columns of ``POSTING_SCHEMA``.

    Fields are not quoted, fields past the sixth are ignored, empty fields at the end of a line
    count as absent, and a bad or missing number raises.
    """
    line = F.rtrim(F.col(column), F.lit(","))
    fields = lines.select(F.split(line, ",", len(POSTING_SCHEMA) + 1).alias("f"))

    def field(index: int):
        return F.get("f", F.lit(index))

    return fields.select(
        parse_number(field(0), "int", "posting_type").alias("posting_type"),
        parse_number(field(1), "bigint", "id").alias("id"),
        parse_optional_number(field(2), "bigint", "accepted_answer").alias("accepted_answer"),
        parse_optional_number(field(3), "bigint", "parent_id").alias("parent_id"),
        parse_number(field(4), "int", "score").alias("score"),
        field(5).alias("tags"),
    )


def encode_postings(postings: DataFrame) -> DataFrame:
    """The lines :func:`decode_postings` reads, in column ``value``."""
    empty = F.lit("")
    return postings.select(
        F.concat_ws(
            ",",
            F.col("posting_type").cast("string"),
            F.col("id").cast("string"),
            F.coalesce(F.col("accepted_answer").cast("string"), empty),
            F.coalesce(F.col("parent_id").cast("string"), empty),
            F.col("score").cast("string"),
            F.col("tags"),
        ).alias("value")
    )
