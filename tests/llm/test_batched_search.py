"""The search of a batch of queries against one of each query alone, and how much of it is done pair by pair."""

from __future__ import annotations

import numpy as np

from tallyloom.llm import neighbours


def shard(rows: int, copies: int):
    random = np.random.default_rng(11)
    vectors = random.standard_normal((rows, 24))
    vectors[:copies] = vectors[0]
    ids = np.arange(rows)
    top = float((vectors * vectors).sum(axis=1).max())
    matrix = random.standard_normal((25, neighbours.DIMENSIONS))
    cells = neighbours.Cells(np.zeros(1, np.int64), np.zeros(1), 0, matrix, top)
    points = cells.project(vectors, True)
    asked = np.arange(0, rows, 7)
    return neighbours.build_tree(points), points, ids, vectors, vectors[asked], cells.project(vectors[asked], False), ids[asked], top


def test_a_batch_of_queries_finds_what_exhaustive_scoring_finds():
    *rest, queries, at, own, top = shard(900, 200)
    ids, vectors = rest[2], rest[3]
    found = neighbours.search_batch(*rest, queries, at, own, top, 20, np.full(len(own), np.inf), 1e9)
    for i, query in enumerate(queries):
        scores = (vectors * query).sum(axis=1)
        best = [j for j in np.lexsort((ids, -scores)) if ids[j] != own[i]][:20]
        assert found.ids[found.query == i].tolist() == ids[best].tolist()
        assert found.scores[found.query == i].tolist() == scores[best].tolist()


def test_a_batch_finds_what_each_query_finds_alone():
    *rest, queries, at, own, top = shard(900, 0)
    factor = neighbours.chi_square_quantile(0.5, neighbours.DIMENSIONS)
    found = neighbours.search_batch(*rest, queries, at, own, top, 20, np.full(len(own), np.inf), factor)
    for i in range(len(own)):
        ids, scores = neighbours.search(*rest, queries[i], at[i], int(own[i]), top, 20, np.inf, factor)
        assert found.ids[found.query == i].tolist() == ids.tolist() and found.scores[found.query == i].tolist() == scores.tolist()


def test_few_pairs_are_scored_one_by_one(monkeypatch):
    *rest, queries, at, own, top = shard(4000, 0)
    scored, score = [], neighbours._scores
    monkeypatch.setattr(neighbours, "_scores", lambda v, q, row, query: scored.append(len(row)) or score(v, q, row, query))
    neighbours.search_batch(*rest, queries, at, own, top, 20, np.full(len(own), np.inf), 1e9)
    assert sum(scored) < len(queries) * len(rest[2]) / 10


def test_long_leaves_and_many_pairs_lose_nothing(monkeypatch):
    *rest, queries, at, own, top = shard(600, 300)
    whole = neighbours.search_batch(*rest, queries, at, own, top, 20, np.full(len(own), np.inf), 1e9)
    for name in ("RUN_ROWS", "SCORED_PAIRS", "MOST_PAIRS"):
        monkeypatch.setattr(neighbours, name, 50)
    again = neighbours.search_batch(*rest, queries, at, own, top, 20, np.full(len(own), np.inf), 1e9)
    assert all(np.array_equal(a, b) for a, b in zip(whole, again))
