"""Every operator as a query over a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.geometry import nearest_center as closest_center
from tallyloom.operators import checks, kmeans as km, postings as po, relational as rel
from tallyloom.operators import sampling, selection, stored_index, terms, timeuse, wide_terms
from tallyloom.operators.bounded_kmeans import bounded_kmeans
from tallyloom.plans import tables
from tallyloom.plans.jobs import PostingClusters, cluster_postings
from tallyloom.scratch import new_path, written
from tallyloom.sources import articles as article_source
from tallyloom.sources import files
from tallyloom.sources import postings as posting_source

Query = Callable[[SparkSession, str], DataFrame]

PER_TOPIC = 3
KERNELS = PER_TOPIC * len(tables.TOPICS)
# Few rows per range, so that the test tables have many.
RANGE_ROWS = 500
# Small blocks, so that the test tables fill more than one.
BLOCK_ANSWERS = 8
BLOCK_TITLES = 100
# Lines of a packed survey file.
FILE_LINES = 1_000_000
# Vectors sampled from weighted points.
SAMPLED = 45

_registered: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _registered[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_registered)


# Sources: the tables are written in the format first, then read back by the reader under test.


_staged: dict[tuple[str, str, str], str] = {}


def _stage(spark: SparkSession, folder: str, label: str, write: Callable[[str], None]) -> str:
    """The table as a file, written once per application."""
    key = (spark.sparkContext.applicationId, folder, label)
    if key not in _staged:
        path = new_path(spark, label)
        write(path)
        _staged[key] = path
    return _staged[key]


def _posting_file(spark: SparkSession, folder: str) -> str:
    lines = posting_source.encode_postings(tables.postings(spark, folder))
    return _stage(spark, folder, "posting-lines", lines.write.text)


def _survey_file(spark: SparkSession, folder: str) -> str:
    """Packed, which a reader cannot split, and so in files of bounded size."""
    packed = {"header": True, "compression": "gzip", "maxRecordsPerFile": FILE_LINES}
    survey = tables.survey(spark, folder).write.options(**packed)
    return _stage(spark, folder, "survey", survey.csv)


def _event_file(spark: SparkSession, folder: str) -> str:
    events = tables.table(spark, folder, "events").write.options(**files.TIMESTAMPS)
    return _stage(spark, folder, "events-json", events.json)


def _dump_file(spark: SparkSession, folder: str) -> str:
    """Articles with the line breaks of their texts."""
    return _stage(spark, folder, "article-dump", tables.article_lines(spark, folder).write.text)


_indexes: dict[str, stored_index.StoredIndex] = {}


def _term_index(spark: SparkSession, folder: str) -> stored_index.StoredIndex:
    """An index of every token of the articles, written once per application."""
    def write(path: str) -> None:
        tokens = wide_terms.article_tokens(tables.articles(spark, folder), "title")
        _indexes[path] = stored_index.write_index(tokens, block_titles=BLOCK_TITLES, path=path)

    return _indexes[_stage(spark, folder, "term-index", write)]


def stage_inputs(spark: SparkSession, folder: str) -> None:
    """Writes what the file-source queries and lookups read, so that timing them times the readers."""
    for stage in (_posting_file, _survey_file, _event_file, _dump_file, _term_index):
        stage(spark, folder)


@_query
def src_text(spark, folder):
    return files.read_lines(spark, _posting_file(spark, folder))


@_query
def src_postings(spark, folder):
    return posting_source.decode_postings(files.read_lines(spark, _posting_file(spark, folder)))


@_query
def src_csv_header_typed(spark, folder):
    return files.read_survey(spark, _survey_file(spark, folder))[1]


@_query
def src_csv_infer(spark, folder):
    return files.read_inferred(spark, _survey_file(spark, folder))[1]


@_query
def src_json_typed(spark, folder):
    schema = tables.table(spark, folder, "events").schema
    return files.read_json(spark, _event_file(spark, folder), schema)


@_query
def src_article_dump(spark, folder):
    return article_source.decode_articles(tables.article_lines(spark, folder))


@_query
def src_article_records(spark, folder):
    return article_source.read_articles(spark, _dump_file(spark, folder))


# Terms.


@_query
def mention_count(spark, folder):
    return terms.mention_count(tables.articles(spark, folder), "the")


@_query
def rank_scan(spark, folder):
    return terms.rank_scan(tables.articles(spark, folder), tables.TERMS)


@_query
def rank_reduce(spark, folder):
    return terms.rank_reduce(tables.articles(spark, folder), tables.TERMS)


@_query
def rank_index(spark, folder):
    index = terms.inverted_index(tables.articles(spark, folder), tables.TERMS)
    return terms.rank_index(index, tables.TERMS)


@_query
def inverted_index(spark, folder):
    return terms.inverted_index(tables.articles(spark, folder), tables.TERMS)


@_query
def inverted_index_blocks(spark, folder):
    return _blocks(terms.inverted_index(tables.articles(spark, folder), tables.TERMS))


@_query
def rank_index_long(spark, folder):
    index = terms.inverted_index(tables.articles(spark, folder), tables.PAIR_TERMS)
    return terms.rank_index(index, tables.PAIR_TERMS)


@_query
def inverted_index_long(spark, folder):
    return terms.inverted_index(tables.articles(spark, folder), tables.PAIR_TERMS)


@_query
def inverted_index_blocks_long(spark, folder):
    return _blocks(terms.inverted_index(tables.articles(spark, folder), tables.PAIR_TERMS))


def _blocks(index):
    blocks = terms.index_blocks(index, block_titles=BLOCK_TITLES)
    return blocks.select(
        "term",
        "block",
        F.array_join("entries.title", ",").alias("titles"),
        F.aggregate("entries.copies", F.lit(0).cast("bigint"), lambda a, c: a + c).alias("n"),
    )


@_query
def rank_vocabulary_table(spark, folder):
    return wide_terms.rank_table(tables.articles(spark, folder), tables.vocabulary(spark, folder), absent=True)


@_query
def index_vocabulary_table(spark, folder):
    return wide_terms.index_table(tables.articles(spark, folder), tables.vocabulary(spark, folder))


@_query
def stored_index_lookup(spark, folder):
    return stored_index.lookup(spark, _term_index(spark, folder), tables.LOOKED_UP)


@_query
def stored_index_rank(spark, folder):
    return stored_index.rank_stored(spark, _term_index(spark, folder), tables.LOOKED_UP)


@_query
def word_count(spark, folder):
    return terms.word_count(terms.split_words(tables.articles(spark, folder)))


# Relational samples.


@_query
def select_where_sort(spark, folder):
    return rel.young_team(tables.employees(spark, folder), city="BUILDING", below=15)


@_query
def group_max(spark, folder):
    return rel.group_max(tables.listings(spark, folder), "zip", "price")


@_query
def group_min(spark, folder):
    return rel.group_min(tables.listings(spark, folder), "zip", "price")


@_query
def group_avg(spark, folder):
    return rel.group_avg(tables.listings(spark, folder), "zip", "price")


@_query
def group_avg_typed(spark, folder):
    return rel.group_avg_typed(tables.listings(spark, folder), "zip", "price")


@_query
def group_count_2key(spark, folder):
    return rel.group_count_2key(tables.posts(spark, folder), "author", "forum")


@_query
def row_count(spark, folder):
    return rel.row_count(tables.table(spark, folder, "lineitem"))


@_query
def global_sum(spark, folder):
    return rel.global_sum(tables.postings(spark, folder).select("score"), "score")


@_query
def global_max(spark, folder):
    return rel.global_max(tables.listings(spark, folder), "price")


@_query
def row_extract(spark, folder):
    averages = rel.group_avg(tables.listings(spark, folder), "zip", "price")
    untyped = averages.select(F.col("zip").cast("string").alias("zip"), "avg_price")
    return rel.row_extract(untyped, {"zip": "int", "avg_price": "double"})


# Time use.


@_query
def column_classify(spark, folder):
    return timeuse.activity_minutes(tables.survey(spark, folder))


@_query
def timeuse_summary(spark, folder):
    return timeuse.timeuse_summary(tables.survey(spark, folder))


@_query
def timeuse_typed_rows(spark, folder):
    return timeuse.timeuse_typed_rows(timeuse.timeuse_summary(tables.survey(spark, folder)))


@_query
def timeuse_grouped(spark, folder):
    return timeuse.timeuse_grouped(timeuse.timeuse_summary(tables.survey(spark, folder)))


@_query
def timeuse_sql(spark, folder):
    return timeuse.timeuse_sql(timeuse.timeuse_summary(tables.survey(spark, folder)))


@_query
def timeuse_typed(spark, folder):
    return timeuse.timeuse_typed(timeuse.timeuse_summary(tables.survey(spark, folder)))


@_query
def timeuse_summary_long(spark, folder):
    return timeuse.timeuse_summary_long(tables.survey(spark, folder))


# Postings.


@_query
def posting_pairs(spark, folder):
    pairs = po.posting_pairs(tables.postings(spark, folder))
    return pairs.select(
        "qid",
        F.col("question.tags").alias("tags"),
        F.col("answer.id").alias("answer_id"),
        F.col("answer.score").alias("answer_score"),
    )


@_query
def posting_groups(spark, folder):
    groups = po.posting_groups(tables.postings(spark, folder), BLOCK_ANSWERS)
    pair = F.transform("answers", lambda a: F.concat_ws(
        ":", a["answer"]["id"].cast("string"), a["answer"]["score"].cast("string"), a["copies"].cast("string")
    ))
    return groups.select(
        "qid", "block", F.col("question.tags").alias("tags"), F.array_join(pair, ",").alias("answers")
    )


@_query
def posting_highscore(spark, folder):
    return po.posting_highscore(tables.postings(spark, folder))


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return po.posting_vectors(tables.postings(spark, folder), tables.TOPICS)


@_query
def posting_vectors(spark, folder):
    return _vectors(spark, folder)


# Sampling and clustering.


@_query
def sample_uniform(spark, folder):
    return sampling.sample_uniform(_vectors(spark, folder), 45)


@_query
def sample_stratified(spark, folder):
    return sampling.sample_stratified(_vectors(spark, folder), PER_TOPIC)


def _start(spark: SparkSession, folder: str) -> tuple[DataFrame, list[tuple[int, int]]]:
    vectors = written(_vectors(spark, folder), "vectors")
    return vectors, km.initial_means(vectors, len(tables.TOPICS), KERNELS)


@_query
def nearest_center(spark, folder):
    vectors, means = _start(spark, folder)
    return vectors.withColumn("cluster", closest_center("x", "y", means))


@_query
def kmeans_step(spark, folder):
    vectors, start = _start(spark, folder)
    means = km.kmeans_step(km.compact(vectors), start)
    return km.Clustering(means, False).means_frame(spark)


def _clusters(spark: SparkSession, folder: str, **parameters) -> PostingClusters:
    postings = tables.postings(spark, folder)
    return cluster_postings(postings, tables.TOPICS, kernels=KERNELS, **parameters)


def _means(spark: SparkSession, folder: str, **parameters) -> DataFrame:
    found = _clusters(spark, folder, **parameters)
    found.discard()
    return found.clustering.means_frame(spark)


def _results(spark: SparkSession, folder: str) -> DataFrame:
    """A row per cluster. The table of points stays, as the rows are read from it."""
    return _clusters(spark, folder).results


@_query
def kmeans(spark, folder):
    return _means(spark, folder)


@_query
def kmeans_compiled(spark, folder):
    """With compiled distances, as for points by the million."""
    return _means(spark, folder, few=False)


@_query
def kmeans_late_start(spark, folder):
    """At most three rounds: the round number starts at 118 of 120."""
    return _means(spark, folder, start=118)


@_query
def kmeans_bounded(spark, folder):
    vectors, start = _start(spark, folder)
    return bounded_kmeans(km.compact(vectors), start).means_frame(spark)


@_query
def kmeans_history(spark, folder):
    found = _clusters(spark, folder)
    found.discard()
    return found.clustering.history_frame(spark)


@_query
def sample_points(spark, folder):
    return sampling.sample_points(km.compact(_vectors(spark, folder)), SAMPLED).select("x", "y", "copy")


@_query
def sample_points_stratified(spark, folder):
    drawn = sampling.sample_points(km.compact(_vectors(spark, folder)), SAMPLED, stratum="x")
    return drawn.select("x", "y", "copy", "rank")


@_query
def group_median(spark, folder):
    """The median price, in cents, of the line items with each return flag."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents")
    prices = tables.table(spark, folder, "lineitem").select("l_returnflag", cents, F.lit(1).alias("wt"))
    return selection.weighted_median(prices, "l_returnflag", "cents", "wt")


@_query
def cluster_results(spark, folder):
    return _results(spark, folder)


@_query
def cluster_report(spark, folder):
    return km.cluster_report(_results(spark, folder))


@_query
def cluster_report_rows(spark, folder):
    return km.report_rows(_results(spark, folder))


# Checks.


@_query
def set_reconcile(spark, folder):
    """Orders that have line items against all orders, and the other way round."""
    lines = tables.table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("key"))
    orders = tables.table(spark, folder, "orders").select(F.col("o_orderkey").alias("key"))
    return checks.set_reconcile(lines, orders)


@_query
def order_check(spark, folder):
    events = tables.table(spark, folder, "events")
    return checks.order_check(events, ["user_id"], "event_id", "value")


@_query
def order_check_ranges(spark, folder):
    events = tables.table(spark, folder, "events")
    return checks.order_check(events, ["user_id"], "ts", "value", range_rows=RANGE_ROWS)
