"""Rankings and indexes for a vocabulary that is itself a table, of any length.

The vocabulary is a frame of ``position, term``. Articles become narrow rows of distinct tokens that meet it in a hash join,
so neither the plan nor the work per article grows with the vocabulary. Whether its side is broadcast is left to the
optimiser, which knows its size; beyond that both sides are dealt by term and the adaptive join splits a frequent one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.tokens import tokens

# Bytes of text that one task of an index gives rows of. Parquet writers keep a dictionary of 1 MiB per column and file.
TASK_TEXT = 600_000


def checked_vocabulary(vocabulary: DataFrame) -> DataFrame:
    """``position, term``; empty, null and repeated terms raise, as they would make counts ambiguous."""
    term = F.coalesce("term", F.lit(""))
    grouped = vocabulary.groupBy(term.alias("term")).agg(F.min("position").alias("position"), F.count(F.lit(1)).alias("n"))
    failure = F.raise_error(F.concat(F.lit("empty or repeated term: '"), F.col("term"), F.lit("'")))
    sound = (F.col("n") == 1) & (F.col("term") != "")
    position = F.when(sound, F.coalesce("position", F.lit(0))).otherwise(failure.cast(vocabulary.schema["position"].dataType))
    return grouped.select(position.alias("position"), "term")


def article_tokens(articles: DataFrame, *columns: str, text: str = "text") -> DataFrame:
    """The given columns and ``term``, a row per article and distinct token of it."""
    # explode_outer, because a plain explode adds a filter that splits every text twice.
    found = articles.select(*columns, F.explode_outer(F.array_distinct(tokens(F.col(text)))).alias("term"))
    return found.where("term <> ''")


def token_counts(articles: DataFrame, text: str = "text") -> DataFrame:
    """``term, n``: the articles that mention each token. Frequent tokens are added up before they are shuffled."""
    return article_tokens(articles, text=text).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def rank_table(articles: DataFrame, vocabulary: DataFrame, text: str = "text", absent: bool = False) -> DataFrame:
    """``term, n`` by number of mentioning articles, ties by position, then term.

    With ``absent`` unmentioned terms come with 0, otherwise they are left out.
    """
    known = checked_vocabulary(vocabulary)
    counted = known.join(token_counts(articles, text), "term", "left" if absent else "inner")
    return counted.select("term", F.coalesce("n", F.lit(0)).alias("n"), "position").orderBy(F.desc("n"), "position", "term").select("term", "n")


def index_table(articles: DataFrame, vocabulary: DataFrame, key: str = "title", text: str = "text") -> DataFrame:
    """One row per vocabulary term and article that mentions it: ``term`` and all article columns.

    ``key`` tells articles apart. Only it and the tokens pass the join with the vocabulary; texts
    are attached to hits afterwards. A text comes once per term, so the rows hold many times the articles' bytes:
    articles are dealt by key over so many tasks that the different texts of one fit a Parquet writer's dictionary,
    which then stores each text once. For their number the texts' lengths are added up in a pass of its own.
    """
    size = articles.agg(F.sum(F.octet_length(text))).first()[0] or 0
    tasks = 1 + size // TASK_TEXT
    hits = article_tokens(articles, key, text=text).join(checked_vocabulary(vocabulary).where("position IS NOT NULL"), "term").select("term", key)
    return hits.repartition(tasks, key).join(articles.repartition(tasks, key), key).select("term", *articles.columns)
