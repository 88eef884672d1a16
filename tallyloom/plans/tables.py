"""The star-schema test tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Four of the five order priorities, so that the fifth is an unknown topic.
TOPICS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")
# All pairs of small letters, far more terms than the articles mention.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
PAIR_TERMS = tuple(a + b for a in LETTERS for b in LETTERS)
# "in" and "the" are tied at one scale, "Clojure" does not occur.
TERMS = ("the", "in", "and", "The", "of", "with", "Clojure")

LOOKED_UP = (*TERMS, "is", "at", "by")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def postings(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as questions tagged with their priority, line items as answers.

    A third of the questions accept their first answer. Some answers have no parent or name none.
    """
    answer = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    questions = table(spark, folder, "orders").select(
        F.lit(1).alias("posting_type"),
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey") * 10 + 1).alias("accepted_answer"),
        F.lit(None).cast("bigint").alias("parent_id"),
        F.length("o_orderpriority").alias("score"),
        F.col("o_orderpriority").alias("tags"),
    )
    answers = table(spark, folder, "lineitem").select(
        F.lit(2).alias("posting_type"),
        answer.alias("id"),
        F.lit(None).cast("bigint").alias("accepted_answer"),
        F.when(answer % 97 == 0, F.lit(-1)).when(answer % 101 != 0, F.col("l_orderkey")).alias("parent_id"),
        (F.col("l_quantity").cast("int") - 25).alias("score"),
        F.lit(None).cast("string").alias("tags"),
    )
    return questions.unionByName(answers)


def articles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("title"), "text"
    )


def vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """Every token of three letters or more of the conversations, and the customers' names, which no article mentions."""
    spoken = table(spark, folder, "conversations").select(F.explode(F.split(F.coalesce("text", F.lit("")), " ")).alias("term"))
    named = table(spark, folder, "customer").select(F.col("c_name").alias("term"))
    terms = spoken.unionByName(named).where(F.length("term") >= 3).distinct()
    position = F.conv(F.substring(F.md5(F.col("term").cast("binary")), 1, 8), 16, 10).cast("bigint")
    return terms.select(position.alias("position"), "term")


def article_lines(spark: SparkSession, folder: str) -> DataFrame:
    line = F.concat(
        F.lit("<page> <title>"),
        F.col("title"),
        F.lit("</title><text>"),
        F.col("text"),
        F.lit("</text>  </page>"),
    )
    return articles(spark, folder).select(line.alias("value"))


def survey(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as respondents. All minutes are whole numbers held as doubles."""
    part, supplier, order = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey")
    line = F.col("l_linenumber")
    codes = {
        "telfs": 1 + part % 5,
        "tesex": 1 + supplier % 2,
        "teage": 10 + order % 75,
    }
    minutes = {
        "t010101": 300 + part % 301,
        "t030101": supplier % 61,
        "t110101": order % 91,
        "t180101": line * 5,
        "t180301": line * 3,
        "t050101": F.col("l_quantity") * 7,
        "t180501": supplier % 31,
        "t020101": part % 121,
        "t120301": order % 181,
        "t189999": line,
        "t170101": F.lit(999),
    }
    return table(spark, folder, "lineitem").select(
        F.concat_ws("-", F.lit("r"), order.cast("string"), line.cast("string")).alias("tucaseid"),
        *[code.cast("int").alias(name) for name, code in codes.items()],
        *[value.cast("double").alias(name) for name, value in minutes.items()],
    )


def employees(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("int").alias("id"),
        F.col("c_name").alias("fname"),
        F.concat(F.lit("Nation"), F.col("c_nationkey").cast("string")).alias("lname"),
        F.col("c_nationkey").alias("age"),
        F.col("c_mktsegment").alias("city"),
    )


def listings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("street"),
        F.col("o_custkey").cast("int").alias("zip"),
        F.floor("o_totalprice").cast("int").alias("price"),
    )


def posts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").cast("int").alias("author"),
        F.col("event_type").alias("forum"),
        F.floor("value").cast("int").alias("likes"),
        F.date_format("ts", "MMM d").alias("date"),
    )
