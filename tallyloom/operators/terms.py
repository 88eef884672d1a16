"""Counting, ranking and indexing vocabulary terms by the articles that mention them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.tokens import (
    check_vocabulary,
    literal_array,
    mentioned_terms,
    mentions_term,
    tokens,
)

def vocabulary_frame(spark: SparkSession, vocabulary: Sequence[str]) -> DataFrame:
    """``position, term``, with positions from 0."""
    terms = check_vocabulary(vocabulary)
    return spark.range(1).select(F.posexplode(literal_array(terms)).alias("position", "term"))


def inverted_index(
    articles: DataFrame, vocabulary: Sequence[str], text: str = "text"
) -> DataFrame:
    """One row per (term, article mentioning it): ``term`` and all article columns.

    Flat, so that a term found in a third of all articles stays spread over the tasks that read
    them. The vocabulary, which the driver holds, is matched inside the scan: only hits carry the
    text, nothing is shuffled, and columns not used later are pruned from the scan.
    """
    terms = check_vocabulary(vocabulary)
    # explode_outer, because a plain explode adds a filter that matches every text twice.
    hits = mentioned_terms(F.col(text), terms)
    found = articles.select("*", F.explode_outer(hits).alias("term")).where("term IS NOT NULL")
    return found.select("term", *articles.columns)


def mention_counts(
    articles: DataFrame, vocabulary: Sequence[str], text: str = "text"
) -> DataFrame:
    """``term, n``: articles mentioning each vocabulary term, absent terms left out."""
    return _count_terms(inverted_index(articles, vocabulary, text))


def _count_terms(found: DataFrame) -> DataFrame:
    return found.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def _ranked(counts: DataFrame, vocabulary: Sequence[str], how: str) -> DataFrame:
    """Counts in descending order, ties in vocabulary order."""
    known = vocabulary_frame(counts.sparkSession, vocabulary)
    return (
        known.join(counts, "term", how)
        .select("term", F.coalesce("n", F.lit(0)).alias("n"), "position")
        .orderBy(F.desc("n"), "position")
        .select("term", "n")
    )


def mention_count(articles: DataFrame, term: str, text: str = "text") -> DataFrame:
    """One row ``term, n``: the number of articles mentioning one term."""
    hits = F.count_if(mentions_term(F.col(text), term))
    return articles.agg(hits.alias("n")).select(F.lit(term).alias("term"), "n")


def rank_scan(articles: DataFrame, vocabulary: Sequence[str], text: str = "text") -> DataFrame:
    """All vocabulary terms by number of mentioning articles, unmentioned terms with 0."""
    return _ranked(mention_counts(articles, vocabulary, text), vocabulary, "left")


def rank_reduce(articles: DataFrame, vocabulary: Sequence[str], text: str = "text") -> DataFrame:
    """Mentioned terms only, counted while scanning and combined before the shuffle."""
    return _ranked(mention_counts(articles, vocabulary, text), vocabulary, "inner")


def rank_index(index: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """Mentioned terms only, ranked by the size of their entry in an inverted index."""
    return _ranked(_count_terms(index), vocabulary, "inner")


def index_blocks(index: DataFrame, title: str = "title", block_titles: int = 10_000) -> DataFrame:
    """The index grouped by term, in blocks of about ``block_titles`` titles.

    Columns ``term, block, entries`` with ``entries array<struct<title, copies>>``. Copies of one
    title are added up before the shuffle, and a frequent term gets as many blocks as its number of
    titles asks for, so that no task ever holds a whole frequent term. Titles go to blocks by
    hash, which gives the same blocks when a task runs again. Whether the sizes are broadcast is left
    to the optimiser, which knows theirs; blocks are dealt anew after the join, whose partitioning by term
    would put all blocks of a term into one task.
    """
    entries = index.groupBy("term", F.col(title).alias("title")).agg(
        F.count(F.lit(1)).alias("copies")
    )
    # Counting by "copies" keeps that column here too, so both uses share one exchange.
    titles = F.count_if(F.col("copies") > 0)
    sizes = entries.groupBy("term").agg(
        F.ceil(titles / F.lit(block_titles)).cast("bigint").alias("blocks")
    )
    entry = F.struct("title", "copies")
    return (
        entries.join(sizes, "term")
        .withColumn("block", block_number(F.col("title"), F.col("blocks")))
        .repartition("term", "block")
        .groupBy("term", "block")
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    )


def block_number(key, blocks):
    """A block below ``blocks`` for a key, by a hash other engines can compute too."""
    digest = F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10)
    return F.when(blocks > 1, F.pmod(digest.cast("bigint"), blocks)).otherwise(
        F.lit(0).cast("bigint")
    )


def split_words(articles: DataFrame, text: str = "text") -> DataFrame:
    """One row ``word`` per token, the empty ones between adjoining spaces left out."""
    return articles.select(F.explode_outer(tokens(F.col(text))).alias("word")).where("word <> ''")


def word_count(words: DataFrame, word: str = "word") -> DataFrame:
    """``word, n, line``: how often each word occurs, and both as one line of text."""
    counted = words.groupBy(F.col(word).alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("word", "n", F.concat_ws(" ", "word", F.col("n").cast("string")).alias("line"))
