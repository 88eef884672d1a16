"""Vectors, archives, helpers and the pipeline."""

from __future__ import annotations

import collections
import hashlib
import io
import zipfile

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tallyloom.llm import components, neighbours, queries, warc
from tallyloom.llm.shipping import ship

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


# 1 Neighbours


def brute_neighbours(rows, k):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows])
    for i, v in rows:
        if i % 20 == 0:
            score = (vectors * v).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            yield i, [int(ids[j]) for j in order], [float(score[j]) for j in order]


def test_neighbours_find_nine_in_ten_and_handle_odd_vectors(spark):
    random = np.random.default_rng(3)
    centres = random.standard_normal((6, 24))
    rows = [(i, centres[i % 6] + 0.1 * random.standard_normal(24)) for i in range(1500)]
    rows += [(2000 + i, centres[0]) for i in range(400)]  # one vector many times
    data = [(i, v.tolist()) for i, v in rows]
    odd = [(20_000, None), (20_020, [0.0] * 24), (20_040, [1.0] * 3), (20_060, [float("nan")] + [1.0] * 23), (None, [1.0] * 24), (20_080, [None] + [1.0] * 23)]
    frame = spark.createDataFrame(data + odd, "vec_id long, embedding array<double>")
    found = collections.defaultdict(list)
    for r in neighbours.nearest_neighbours(frame, lambda i: i % 20 == 0, shard_rows=256, sample_rows=500).collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    shares = []
    for query, ids, scores in brute_neighbours(rows, 20):
        own = sorted(found.pop(query))
        assert [rank for rank, _, _ in own] == list(range(1, 21))
        assert [(-s, v) for _, v, s in own] == sorted((-s, v) for _, v, s in own)
        shares.append(len({v for _, v, _ in own} & set(ids)) / 20)
    assert not found and np.mean(shares) >= 0.9
    small = spark.createDataFrame([(20, [1.0, 0.0]), (3, [0.5, 0.5]), (20, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in neighbours.nearest_neighbours(small, lambda i: i % 20 == 0).collect()] == [(20, 1, 3, 0.5)]
    assert neighbours.nearest_neighbours(small.limit(0), lambda i: i % 20 == 0).count() == 0


def test_rows_that_repeat_take_no_place_among_the_neighbours(spark):
    random = np.random.default_rng(5)
    rows = [(i, random.standard_normal(16)) for i in range(300)]
    data = [(i, v.tolist()) for i, v in rows for _ in range(2 + i % 3)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    found = collections.defaultdict(list)
    for r in neighbours.nearest_neighbours(frame, lambda i: i % 20 == 0, shard_rows=64, sample_rows=100).collect():
        found[r.query_id].append((r.rank, r.vec_id))
    shares = []
    for query, ids, _ in brute_neighbours(rows, 20):
        own = sorted(found.pop(query))
        assert [rank for rank, _ in own] == list(range(1, 21)) and len({v for _, v in own}) == 20
        shares.append(len({v for _, v in own} & set(ids)) / 20)
    assert not found and np.mean(shares) >= 0.9


def test_one_id_with_vectors_of_one_score_counts_once_in_a_search():
    points = np.array([[1.0, float(i)] for i in range(30)] + [[0.5, 0.0], [0.4, 0.0]])
    ids = np.array([1] * 30 + [2, 3])
    found, scores = neighbours.search(neighbours.build_tree(points), points, ids, points, np.array([1.0, 0.0]), np.zeros(2), 9, 1e3, 3, np.inf, 2.0)
    assert found.tolist() == [1, 2, 3] and scores.tolist() == [1.0, 0.5, 0.4]


def test_chi_square_quantiles():
    assert abs(neighbours.chi_square_quantile(0.95, 8) - 15.507) < 1e-3
    assert abs(neighbours.chi_square_quantile(0.5, 2) - 1.386) < 1e-3


# 3 WARC


@pytest.mark.parametrize("options", [{}, {"archive_bytes": 20_000, "always64": True}])
def test_pages_come_back_from_the_archives(spark, options):
    data = [(i, f"http://x/{i % 7}", f"<p>{i % 40}</p>" * 200) for i in range(120)]
    data += [(901, "http://x/é y\n", None), (902, None, ""), (903, "u", "z" * 999), (904, "u", "z" * 999), (905, "u", "q" * 1000), (907, "u", "q" * 1000)]
    data += [(907, "u", "q" * 1000), (None, "n", "q" * 1000), (None, "n", "w" * 2000), (None, "n", "w" * 2000), (910, "é", "é" * 600), (911, "é", "é" * 600), (912, "u", "long " * 100_000)]
    pages = spark.createDataFrame([(*d, "extra") for d in data], "page_id long, url string, html string, digest string")
    archives = warc.write_archives(warc.with_revisits(pages), **options)
    first = {}
    for i, _, html in data:
        if len((html or "").encode()) >= 1000:
            first[html] = max(first.get(html, -1), -1 if i is None else i)
    expected = collections.Counter()
    for i, _, html in data:
        raw = (html or "").encode()
        revisit = html in first and first[html] >= 0 and i != first[html]
        expected[i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first[html] if revisit else None] += 1
    read = warc.read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert collections.Counter(map(tuple, read.collect())) == expected
    for row in archives.collect():
        with zipfile.ZipFile(row.path.removeprefix("file:")) as archive:
            assert archive.testzip() is None and archive.namelist() == [warc.RECORDS, warc.INDEX]
    assert warc.read_archives(warc.write_archives(warc.with_revisits(pages.limit(0)))).count() == 0


def test_foreign_zip_files_with_a_comment_are_read():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr("a.txt", "hello")
        archive.writestr("b.txt", "PK\x05\x06 inside")
        archive.comment = b"a comment, PK\x05\x06 and all" + b"x" * 30
    handle = pa.BufferReader(raw.getvalue())
    found = warc.members(handle)
    assert list(found) == ["a.txt", "b.txt"]
    assert handle.read_at(5, warc.data_offset(handle, found["a.txt"])) == b"hello"


# Components


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, j) for j in range(101, 140)] + [(300, 299), (5, 5)]
    found = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert {found[i] for i in range(61)} == {0} and {found[j] for j in range(100, 140)} == {100} and found[300] == found[299] == 299
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# Queries and pipeline


@pytest.mark.parametrize("name", sorted(queries.registered()))
def test_queries_run_over_the_smallest_tables(spark, name):
    result = queries.registered()[name](spark, FOLDER)
    table = {"op1": "embeddings", "op3": "pages"}.get(name.partition("_")[0], "documents")
    whole = spark.read.parquet(f"{FOLDER}/{table}.parquet").count()
    assert result.count() == whole if table != "embeddings" else result.count() > 0


def test_stages_keep_the_columns_and_their_decisions_take_effect(spark):
    columns, docs = None, spark.read.parquet(f"{FOLDER}/documents.parquet")
    documents, sizes = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, FOLDER), name)
        columns = columns or documents.columns
        assert docs.columns == columns and docs.schema.simpleString() == documents.schema.simpleString()
        sizes.append(docs.count())
        assert 0 < sizes[-1] <= documents.count() * 3
    assert sizes[1] < documents.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and last.count() == sizes[-1]


def test_stages_take_odd_rows(spark):
    odd = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "the cat and the dog", "en", None, 1), (3, "the cat and the dog", "en", None, 1), (None, "x y z", "en", "b", 5)]
    docs = spark.createDataFrame(odd, spark.read.parquet(f"{FOLDER}/documents.parquet").schema)
    for start in (docs, docs.limit(0)):
        current = start
        for name, stage in corpus_pipeline.STAGES:
            current = corpus_pipeline.written(stage(spark, current, FOLDER), name)
        assert current.count() <= 9
