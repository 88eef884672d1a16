"""The three end-to-end jobs."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tallyloom.functions.tokens import check_vocabulary
from tallyloom.operators import kmeans as km
from tallyloom.operators.postings import posting_vectors
from tallyloom.operators.terms import inverted_index, rank_index, rank_reduce, rank_scan
from tallyloom.operators.timeuse import timeuse_grouped, timeuse_summary
from tallyloom.scratch import discard, written
from tallyloom.sources.articles import decode_articles
from tallyloom.sources.files import read_lines, read_survey
from tallyloom.sources.postings import decode_postings

# The default vocabulary.
LANGUAGES = (
    "JavaScript", "Java", "PHP", "Python", "C#", "C++", "Ruby", "CSS",
    "Objective-C", "Perl", "Scala", "Haskell", "MATLAB", "Clojure", "Groovy",
)


class PostingClusters(NamedTuple):
    clustering: km.Clustering
    points: DataFrame
    results: DataFrame

    def discard(self) -> None:
        """Deletes the table of points; results that were not taken before can no longer be read."""
        discard(self.points)


def cluster_postings(
    postings: DataFrame,
    vocabulary: Sequence[str] = LANGUAGES,
    *,
    kernels: int = km.KERNELS,
    spread: int = km.SPREAD,
    eta: float = km.ETA,
    start: int = 1,
    max_iterations: int = km.MAX_ITERATIONS,
    seed: int = km.SEED,
    few: bool = True,
) -> PostingClusters:
    """Postings to clusters: vectors, start points, k-means and the per-cluster summary.

    Vectors and points are written to the shared folder: drawing start points, compacting and each
    round then read a narrow table instead of repeating the join, also after an executor is lost.
    """
    terms = check_vocabulary(vocabulary)
    vectors = written(posting_vectors(postings, terms, spread), "vectors")
    points = written(km.compact(vectors), "points").persist()
    try:
        means = km.initial_means(vectors, len(terms), kernels, spread, seed)
        clustering = km.kmeans(
            points, means, start=start, max_iterations=max_iterations, eta=eta, few=few
        )
    finally:
        points.unpersist()
        discard(vectors)
    results = km.cluster_results(points, clustering.means, terms, spread)
    return PostingClusters(clustering, points, results)


def cluster_posting_file(
    spark: SparkSession, path: str, vocabulary: Sequence[str] = LANGUAGES, **parameters
) -> PostingClusters:
    """:func:`cluster_postings` from a file of posting lines."""
    return cluster_postings(decode_postings(read_lines(spark, path)), vocabulary, **parameters)


class TermRankings(NamedTuple):
    scan: DataFrame
    index: DataFrame
    reduce: DataFrame


def rank_article_dump(
    spark: SparkSession, path: str, vocabulary: Sequence[str] = LANGUAGES
) -> TermRankings:
    """The three rankings of a vocabulary over an article dump."""
    articles = decode_articles(read_lines(spark, path))
    index = inverted_index(articles, vocabulary)
    return TermRankings(
        rank_scan(articles, vocabulary),
        rank_index(index, vocabulary),
        rank_reduce(articles, vocabulary),
    )


def time_use_by_life_period(spark: SparkSession, path: str) -> DataFrame:
    """Mean hours per working status, sex and age from a survey file."""
    _, survey = read_survey(spark, path)
    return timeuse_grouped(timeuse_summary(survey))
