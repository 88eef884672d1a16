"""Vocabularies as tables, the stored index, bounded k-means, selection, weighted samples, long surveys, records."""

from __future__ import annotations

import random
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import compare
from tallyloom.functions.geometry import means_distance
from tallyloom.operators import kmeans as km
from tallyloom.operators import sampling, selection, stored_index, terms, timeuse, wide_terms
from tallyloom.operators.bounded_kmeans import bounded_kmeans
from tallyloom.plans import oracles
from tallyloom.sources.articles import read_articles


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def details(frame):
    explain = frame.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString
    return explain(frame._jdf.queryExecution(), "formatted")


def opened_buckets(frame):
    """Bucket numbers of the files that the tasks of a plan without shuffles would open."""
    files = [f.filePath().toString() for p in frame._jdf.queryExecution().toRdd().partitions() for f in p.files()]
    return {int(re.search(r"_(\d{5})\.", f)[1]) for f in files}


# Vocabularies as tables

ARTICLES = [("a", "red green red blue"), ("b", "green  t99999 t5"), ("c", "no colour"), ("d", ""), ("e", None), ("f", "red, red t5")]


def vocabulary(spark, words):
    return spark.createDataFrame(list(enumerate(words)), "position long, term string")


def test_rankings_of_a_hundred_thousand_terms(spark, rows):
    articles = spark.createDataFrame(ARTICLES, "title string, text string")
    known = spark.range(100_000).select(F.col("id").alias("position"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("term"))
    known = known.unionByName(vocabulary(spark, ["red", "green", "mauve"]).withColumn("position", F.col("position") + 200_000))
    ranked = wide_terms.rank_table(articles, known)
    assert rows(ranked) == [("t5", 2), ("red", 2), ("green", 2), ("t99999", 1)]
    full = wide_terms.rank_table(articles, known, absent=True)
    assert full.count() == 100_003 and rows(full)[4] == ("t0", 0)
    index = wide_terms.index_table(articles, known)
    texts = dict(ARTICLES)
    assert sorted(rows(index)) == sorted((t, a, texts[a]) for t, a in [("red", "a"), ("red", "f"), ("green", "a"), ("green", "b"), ("t5", "b"), ("t5", "f"), ("t99999", "b")])
    for frame in (ranked, index):
        assert "t99999" not in plan(frame) and "array(t0" not in plan(frame)


def test_the_text_does_not_pass_the_join_with_the_vocabulary(spark):
    articles = spark.createDataFrame(ARTICLES, "title string, text string")
    optimized = wide_terms.index_table(articles, vocabulary(spark, ["red"]))._jdf.queryExecution().optimizedPlan().toString()
    inner = optimized[optimized.index("Project [term#", 10) :] if optimized.count("Project [term#") > 1 else optimized
    assert re.search(r"Join Inner, \(title#\d+ = title#\d+\)", optimized) and "Generate explode" in inner


@pytest.mark.parametrize("words", [["red", "red"], ["red", ""], ["red", None]])
def test_repeated_and_empty_terms_raise(spark, words):
    articles = spark.createDataFrame(ARTICLES, "title string, text string")
    for frame in (wide_terms.rank_table(articles, vocabulary(spark, words), absent=True), wide_terms.index_table(articles, vocabulary(spark, ["red", *words]))):
        with pytest.raises(Exception, match="empty or repeated term"):
            frame.collect()


def test_vocabulary_tables_give_what_lists_give(spark, rows):
    articles = spark.createDataFrame(ARTICLES, "title string, text string")
    words = ["green", "red", "t5", "mauve"]
    assert rows(wide_terms.rank_table(articles, vocabulary(spark, words))) == rows(terms.rank_reduce(articles, words))
    assert rows(wide_terms.rank_table(articles, vocabulary(spark, words), absent=True)) == rows(terms.rank_scan(articles, words))
    assert sorted(rows(wide_terms.index_table(articles, vocabulary(spark, words)))) == sorted(rows(terms.inverted_index(articles, words)))
    assert wide_terms.rank_table(articles.limit(0), vocabulary(spark, words)).count() == 0


def test_rows_of_an_index_are_written_with_each_text_once(spark, tmp_path):
    # Longer than the window of the writer's compression.
    noise = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(2500)), lambda i: F.sha2(F.concat(F.col("id").cast("string"), i.cast("string")), 256)))
    text = F.concat_ws(" ", noise, *[F.lit(f"w{k}") for k in range(10)])
    spark.range(30).select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("title"), text.alias("text")).write.parquet(f"{tmp_path}/articles")
    index = wide_terms.index_table(spark.read.parquet(f"{tmp_path}/articles"), vocabulary(spark, [f"w{k}" for k in range(10)]))
    index.write.parquet(f"{tmp_path}/index")
    given, kept = (sum(f.stat().st_size for f in (tmp_path / name).glob("*.parquet")) for name in ("articles", "index"))
    assert spark.read.parquet(f"{tmp_path}/index").count() == 300 and kept < 3 * given


def test_indexes_keep_rows_of_repeated_and_null_titles(spark, rows):
    articles = spark.createDataFrame([("a", "x y"), ("a", "x"), (None, "x")], "title string, text string")
    found = rows(wide_terms.index_table(articles, vocabulary(spark, ["x", "y"])))
    assert Counter(found) == Counter({("x", "a", "x y"): 2, ("x", "a", "x"): 2, ("y", "a", "x y"): 1, ("y", "a", "x"): 1})


# The stored index


@pytest.fixture(scope="module")
def many_articles(spark):
    text = F.concat_ws(" ", F.lit("hot"), *[F.concat(F.lit("w"), (F.col("id") * k % 997).cast("string")) for k in (1, 3, 7)])
    return spark.range(6000).select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("title"), text.alias("text")).repartition(7)


def test_lookups_open_only_their_buckets(spark, rows, many_articles):
    index = stored_index.write_index(wide_terms.article_tokens(many_articles, "title"), buckets=32, block_titles=500)
    wanted = ["w5", "w700", "hot", "absent"]
    found = stored_index.lookup(spark, index, wanted)
    assert 1 < len(opened_buckets(found)) <= len(wanted) and "In(term" in details(found)
    ranking = stored_index.rank_stored(spark, index, wanted)
    assert 1 < int(re.search(r"SelectedBucketsCount: (\d+) out of 32", details(ranking))[1]) <= len(wanted)
    assert "entries" not in re.search(r"ReadSchema: \S+", details(ranking))[0]
    assert rows(ranking) == rows(terms.rank_reduce(many_articles, wanted))
    found = Counter(r.term for r in found.collect())
    assert found == Counter(r.term for r in terms.inverted_index(many_articles, wanted).collect())
    again = stored_index.open_index(spark, index.path, index.buckets)
    assert rows(stored_index.rank_stored(spark, again, wanted)) == rows(ranking)
    assert opened_buckets(stored_index.lookup(spark, again, wanted)) == opened_buckets(stored_index.lookup(spark, index, wanted))


def test_a_frequent_term_is_written_by_several_tasks(spark, many_articles):
    # As with more data: so little of it would be put into one task.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _frequent_term(spark, many_articles)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _frequent_term(spark, many_articles):
    index = stored_index.write_index(wide_terms.article_tokens(many_articles, "title"), buckets=8, block_titles=200)
    hot = index.read(spark).where("term = 'hot'")
    assert hot.count() == 30 and hot.agg(F.sum("articles")).first()[0] == 6000
    assert hot.select(F.input_file_name()).distinct().count() > 1
    assert len(list(Path(index.path.removeprefix("file:")).glob("*.parquet"))) <= 8 * 8


def test_copies_of_an_article_are_added_up(spark, rows):
    articles = spark.createDataFrame([("a", "x y"), ("a", "x")], "title string, text string")
    index = stored_index.write_index(wide_terms.article_tokens(articles, "title"), buckets=4)
    assert rows(stored_index.lookup(spark, index, ["x"])) == [("x", "a", 2)]
    assert rows(stored_index.rank_stored(spark, index, ["y", "x"])) == [("x", 2), ("y", 1)]


def test_an_index_shuffles_mentions_once(spark, many_articles):
    mentions = wide_terms.article_tokens(many_articles, "title").select("term", "title")
    frequent, total = stored_index._frequent(mentions, 200)
    assert total == mentions.count() and rows_of(frequent) == {"hot": 30}
    physical = stored_index._dealt_blocks(mentions, frequent, total, 8)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Aggregate|SortMergeJoin", physical) and physical.count("Exchange hashpartitioning") == 1


def rows_of(frame):
    return {row[0]: row[1] for row in frame.collect()}


def test_blocks_that_go_on_over_batches(spark):
    """Blocks of many batches, copies that lie in different ones, null titles."""
    title = F.when(F.col("id") % 1000 < 999, F.concat(F.lit("a"), (F.col("id") % 1000).cast("string")))
    mentions = spark.range(4000).select(F.when(F.col("id") % 1000 < 5, "rare").otherwise("hot").alias("term"), title.alias("title")).repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        index = stored_index.write_index(mentions, buckets=3, block_titles=500)
        found = index.read(spark).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert Counter({(r.term, e.title): e.copies for r in found for e in r.entries}) == Counter(tuple(r) for r in mentions.collect())
    assert all(r.articles == sum(e.copies for e in r.entries) for r in found) and len({(r.term, r.block) for r in found}) == len(found)
    for row in found:
        titles = [e.title or "" for e in row.entries]
        assert titles == sorted(set(titles))


# Bounded k-means


@pytest.mark.parametrize("seed", range(4))
def test_bounds_change_no_round(spark, seed):
    rng = random.Random(seed)
    spread = rng.choice([4, 60, 50_000])
    data = sorted({(rng.randrange(4) * spread, rng.randrange(rng.choice([6, 300]))) for _ in range(150)})
    points = spark.createDataFrame([(x, y, rng.randint(1, 9)) for x, y in data], "x int, y int, wt long")
    means = [data[rng.randrange(len(data))] for _ in range(7)]  # some are equal
    plain = km.kmeans(points, means, eta=0.5, max_iterations=12)
    bounded = bounded_kmeans(points, means, eta=0.5, max_iterations=12)
    show = lambda c: [(r.iteration, r.distance, r.old, r.new, r.sizes) for r in c.history]
    assert show(bounded) == show(plain) and bounded.means == plain.means and bounded.converged == plain.converged


def test_ever_fewer_distances_are_computed(spark):
    rng = random.Random(1)
    data = {(50_000 * rng.randrange(12), int(rng.gauss(400 * rng.randrange(4), 60))) for _ in range(6000)}
    points = spark.createDataFrame([(x, y, 1) for x, y in data], "x int, y int, wt long")
    found = bounded_kmeans(points, rng.sample(sorted(data), 36), eta=0.5, max_iterations=8)
    computed = [r.computed for r in found.history]
    assert computed[0] == 36 * len(data) and sum(computed[1:]) < 0.3 * computed[0] * (len(computed) - 1)
    assert computed[-1] < computed[1] < computed[0] / 2
    assert [tuple(r) for r in found.rounds_frame(spark).collect()] == [(r.iteration, r.distance, r.computed) for r in found.history]


def test_history_has_a_row_per_round_and_cluster(spark):
    points = spark.createDataFrame([(0, 1, 2), (0, 9, 1), (50_000, 4, 3)], "x int, y int, wt long")
    found = km.kmeans(points, [(0, 0), (0, 90), (50_000, 5)], eta=0.5)
    history = [tuple(r) for r in found.history_frame(spark).collect()]
    assert history[0] == (1, 0, 0, 0, 0, 3, 3, 9.0) and history[1] == (1, 1, 0, 90, 0, 90, 0, 0.0) and history[2] == (1, 2, 50_000, 5, 50_000, 4, 3, 1.0)
    assert len(history) == 3 * len(found.history)
    assert sum(r[-1] for r in history[:3]) == means_distance([(0, 0), (0, 90), (50_000, 5)], found.history[0].new)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_the_rounds_of_the_kmeans_sql_suffice_where_results_are_compared(folder):
    assert compare.connect(folder).sql(oracles.kmeans_converged()).fetchall() == [(True,)]


# Selection


@pytest.mark.parametrize("kind,low,high", [("int", -(2**31), 2**31 - 1), ("bigint", -(2**63), 2**63 - 1), ("smallint", -(2**15), 2**15 - 1), ("int", -3, 3)])
def test_ranks_by_ranges_equal_sorting(spark, kind, low, high):
    rng = random.Random(f"{kind}{high}")
    data = [(g, rng.choice([low, high, rng.randint(low, high), rng.randint(max(low, -9), min(high, 9))]), rng.randint(0, 4)) for g in (0, 1, None) for _ in range(rng.randint(1, 80))]
    data += [(0, None, 5), (7, 3, 0)]
    frame = spark.createDataFrame(data, f"g int, v {kind}, w int")
    total = F.col("total")
    got = {(r.group, r.which): r.value for r in selection.weighted_ranks(frame, "g", "v", "w", [F.lit(0), F.floor((total - 1) / 2), total - 1]).collect()}
    for g in (0, 1, None):
        values = sorted(v for a, v, w in data if a == g and v is not None for _ in range(w))
        assert [got[g, i] for i in range(3)] == [values[0], values[(len(values) - 1) // 2], values[-1]]
    assert len(got) == 9


def test_median_of_millions_of_different_scores_buffers_nothing(spark):
    frame = spark.range(2_000_001).select((F.col("id") % 2).alias("g"), (F.col("id") * 1021 % 2_000_003 - 900_000).cast("int").alias("v"), F.lit(1).alias("w"))
    found = selection.weighted_median(frame, "g", "v", "w")
    want = frame.groupBy("g").agg(F.percentile("v", F.lit(0.5)).alias("m"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    text = plan(found)
    assert "percentile" not in text and "collect_" not in text and "ObjectHashAggregate" not in text


def test_cluster_results_buffer_no_scores(spark):
    points = spark.createDataFrame([(0, 1, 1), (0, 2, 2), (0, 9, 1), (50_000, -3, 1), (50_000, -4, 1)], "x int, y int, wt long")
    found = km.cluster_results(points, [(0, 0), (50_000, 0), (99_999, 0)], ["a", "b"])
    assert [tuple(r) for r in found.collect()] == [("b", 100.0, 2, -3), ("a", 100.0, 4, 2)]
    assert "percentile" not in plan(found)
    report = [tuple(r) for r in km.report_rows(found).orderBy("number").collect()]
    assert [line for _, line in report[:3]] == list(km.REPORT_HEADER) and [n for n, _ in report] == [1, 2, 3, 4, 5]
    assert report[3][1] == km.REPORT_LINE % (-3, "b", 100.0, 2)


# Weighted samples


def test_samples_of_points_have_their_size_and_merge(spark):
    rng = random.Random(4)
    data = [(x, y, rng.choice([1, 2, 50])) for x in (0, 50_000) for y in range(40)]
    points = spark.createDataFrame(data, "x int, y int, wt long")
    drawn = sampling.sample_points(points, 30).collect()
    assert len(drawn) == 30 == len({(r.x, r.y, r.copy) for r in drawn})
    weights = {(x, y): w for x, y, w in data}
    assert all(r.copy <= weights[r.x, r.y] for r in drawn)
    assert sampling.sample_points(points.repartition(5), 30).collect() == drawn
    parts = [sampling.sample_points(points.where(c), 30) for c in ("y < 11", "y >= 11")]
    assert parts[0].unionByName(parts[1]).orderBy("key", "x", "y").limit(30).collect() == drawn
    assert sampling.sample_points(points, 30, seed=1).collect() != drawn
    small = spark.createDataFrame([(1, 1, 2), (1, 2, 1), (1, 3, 0)], "x int, y int, wt long")
    assert sorted((r.x, r.y, r.copy) for r in sampling.sample_points(small, 9).collect()) == [(1, 1, 1), (1, 1, 2), (1, 2, 1)]
    strata = Counter(r.x for r in sampling.sample_points(points, 7, stratum="x").collect())
    assert strata == {0: 7, 50_000: 7}


def test_samples_of_points_are_drawn_by_weight(spark):
    """With 60 of 100 vectors at one point, draws of 10 hold six of them on average, as without replacement."""
    points = spark.createDataFrame([(0, 0, 60), (0, 1, 30), (0, 2, 10)], "x int, y int, wt long")
    seeds = [sampling.sample_points(points, 10, seed=s).select("y", F.lit(s).alias("s")) for s in range(120)]
    union = seeds[0]
    for other in seeds[1:]:
        union = union.unionByName(other)
    counts = Counter(r.y for r in union.collect())
    for y, share in ((0, 0.6), (1, 0.3), (2, 0.1)):
        # Variance of a hypergeometric count of 10 from 100.
        deviation = (120 * 10 * share * (1 - share) * 90 / 99) ** 0.5
        assert abs(counts[y] - 1200 * share) < 4 * deviation


# Long surveys


def test_the_long_survey_equals_the_wide_one_for_450_columns(spark, rows):
    rng = random.Random(9)
    names = [f"t{n:02d}{m:02d}{k:02d}" for n in range(1, 19) for m in range(1, 6) for k in range(1, 6)]
    assert len(names) == 450
    data = [(f"r{i % 33}", rng.randint(1, 5), rng.randint(1, 2), rng.randint(10, 80), *[float(rng.randrange(90)) for _ in names]) for i in range(36)]
    data += [data[0], data[0]]  # equal rows
    survey = spark.createDataFrame(data, "tucaseid string, telfs int, tesex int, teage int, " + ", ".join(f"{n} double" for n in names))
    wide, long = timeuse.timeuse_summary(survey), timeuse.timeuse_summary_long(survey)
    assert long.columns == wide.columns and sorted(rows(long)) == sorted(rows(wide))


def test_classes_are_data(spark, rows):
    classes = spark.createDataFrame([("t1", "work", 1), ("t18", "other", 0)], "prefix string, category string, rank int")
    survey = spark.createDataFrame([("a", 1, 1, 20, 60, 120, 180)], "tucaseid string, telfs int, tesex int, teage int, t1801 int, t1 int, x int")
    assert rows(timeuse.timeuse_summary_long(survey, classes=classes)) == [("working", "male", "young", 0.0, 2.0, 1.0)]
    bare = survey.select("tucaseid", "telfs", "tesex", "teage")
    assert rows(timeuse.timeuse_summary_long(bare)) == [("working", "male", "young", 0.0, 0.0, 0.0)]


# Records


def record(title, text):
    return f"<page> <title>{title}</title><text>{text}</text>  </page>"


def test_articles_with_line_breaks_are_read_from_split_files(spark, tmp_path):
    data = [(f"title {i}", f"line\n\nof {i}\n" * (i % 5) + "ü end") for i in range(2000)] + [("last", "")]
    (tmp_path / "dump").mkdir()
    (tmp_path / "dump" / "a.dat").write_text("\n".join(record(*d) for d in data[:1500]) + "\n", "utf-8")
    (tmp_path / "dump" / "b.dat").write_text("\n\n".join(record(*d) for d in data[1500:]), "utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        found = read_articles(spark, str(tmp_path / "dump"))
        assert found.select(F.spark_partition_id()).distinct().count() > 10
        assert sorted(tuple(r) for r in found.collect()) == sorted(data)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_records_that_are_no_articles_raise(spark, tmp_path):
    (tmp_path / "x").write_text(record("a", "b") + "\nnothing of the kind\n</page>\n")
    with pytest.raises(Exception, match="not an article line"):
        read_articles(spark, str(tmp_path / "x")).collect()
    with pytest.raises(ValueError):
        read_articles(spark, "x", end="")
