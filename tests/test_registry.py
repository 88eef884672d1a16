"""Every registered query against its SQL, and the shape of the plans that matter at scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import compare
from tallyloom.operators.postings import posting_pairs
from tallyloom.plans import oracles, queries

FOLDER = entry.SMOKE_FOLDER
# Optional parts register queries of their own; they have their own tests.
QUERIES = queries.registered()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, connection, name):
    assert compare.difference(QUERIES[name](spark, FOLDER), connection, ORACLES[name]) is None


def test_the_rounds_of_the_kmeans_sql_suffice(connection):
    assert connection.sql(oracles.kmeans_converged()).fetchall() == [(True,)]


def test_the_entry_has_all_of_them():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).columns == ["label", "percent", "size", "median"]


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_plan_has_a_product_or_python(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert operator not in text


def test_scans_read_only_what_is_used(spark):
    text = plan(spark, "posting_vectors")
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in text
    assert "ReadSchema: struct<text:string>" in plan(spark, "rank_reduce")
    assert "PushedFilters: [IsNotNull(c_mktsegment)" in plan(spark, "select_where_sort")


def test_answers_are_combined_before_the_shuffle(spark):
    vectors = plan(spark, "posting_vectors")
    assert "partial_max(answer_score" in vectors
    assert vectors.count("Exchange") == 1 and "Join" not in vectors
    assert "partial_max(answer_score" in plan(spark, "posting_highscore")
    assert plan(spark, "sample_stratified").count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(spark, "sample_uniform")


def test_pairs_of_a_hot_question_are_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        ids = spark.range(200_000)
        hot = ids.selectExpr(
            "2 AS posting_type", "id + 1000000 AS id", "cast(null AS bigint) AS accepted_answer",
            "if(id % 3 = 0, 7, id % 20000) AS parent_id", "1 AS score", "'a' AS tags",
        )
        questions = spark.range(20_000).selectExpr(
            "1 AS posting_type", "id", "cast(null AS bigint) AS accepted_answer",
            "cast(null AS bigint) AS parent_id", "1 AS score", "'b' AS tags",
        )
        pairs = posting_pairs(questions.unionByName(hot)).select("qid", "answer.id")
        assert len(pairs.collect()) == 200_000
        text = pairs._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in text
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_an_index_without_text_shuffles_nothing(spark):
    assert "Exchange" not in plan(spark, "inverted_index")
