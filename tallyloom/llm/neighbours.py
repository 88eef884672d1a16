"""Approximate nearest neighbours by largest inner product: stable projections in a kd-tree.

Vectors get one further component that makes all their lengths equal, so the largest inner product is the smallest
Euclidean distance. Gaussian (2-stable) projections to ``DIMENSIONS`` numbers keep distances up to a chi-square law:
a point at distance ``d`` lies within ``d * sqrt(quantile(CONFIDENCE))`` after projection with that confidence. Projected
points are visited leaf by leaf in order of their distance, those near enough are verified on the whole
vectors, and a query stops once the next leaf lies beyond that radius for its k-th best distance.

The top of the kd-tree is fitted on a bounded sample of projected points (``SAMPLE_ROWS``) and has at most ``MOST_CELLS``
cells, whose boxes are the broadcast; every row is indexed. A cell of many rows, say of one vector many times, is
dealt to several shards. Each query first searches its own cell, which gives a bound, then the other
cells that the radius reaches. A task holds one shard's vectors and a batch of queries at a time.

Defined cases: vectors that are null, zero, of another length than most, or hold null or non-finite components take no part, nor
do null ids; rows of the query's own id are no candidates; equal rows of one id count once; ties go to the smaller id; fewer candidates give fewer
rows; an empty table gives no rows.
"""

from __future__ import annotations

from math import exp, inf
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.stages import stored

DIMENSIONS = 8
CONFIDENCE = 0.97
SAMPLE_ROWS = 20_000
SHARD_ROWS = 8_192
MOST_CELLS = 1 << 12
LEAF = 64
# Queries searched together, their distances from boxes at once, rows multiplied with them at once, pairs scored at once
# and pairs held before they are cut to the best.
BATCH_QUERIES = 1_024
BATCH_BOXES = 1 << 17
RUN_ROWS = 1_024
SCORED_PAIRS = 1 << 12
MOST_PAIRS = 1 << 18
SEED = 7


def chi_square_quantile(share: float, dimensions: int) -> float:
    """The value that a chi-square variable of an even number of dimensions stays under with this probability."""
    def below(x: float) -> float:
        term, total = 1.0, 0.0
        for i in range(dimensions // 2):
            total += term
            term *= x / 2 / (i + 1)
        return 1 - exp(-x / 2) * total

    low, high = 0.0, 1.0
    while below(high) < share:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < share else (low, middle)
    return high


class Cells(NamedTuple):
    """The tree's splits, its cells' boxes and the projection."""

    axis: np.ndarray
    cut: np.ndarray
    levels: int
    matrix: np.ndarray
    top: float  # largest squared length

    def project(self, vectors: np.ndarray, data: bool) -> np.ndarray:
        extra = np.sqrt(np.maximum(self.top - (vectors * vectors).sum(axis=1), 0)) if data else np.zeros(len(vectors))
        return vectors @ self.matrix[:-1] + extra[:, None] * self.matrix[-1]

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.levels):
            right = points[np.arange(len(points)), self.axis[node]] > self.cut[node]
            node = 2 * node + 1 + right
        return node - (2**self.levels - 1)


def _fit_cells(sample: np.ndarray, matrix: np.ndarray, top: float, levels: int) -> Cells:
    inner = 2**levels - 1
    axis, cut = np.zeros(max(inner, 1), np.int64), np.zeros(max(inner, 1))
    cells = Cells(axis, cut, levels, matrix, top)
    members = {0: cells.project(sample, True)}
    for node in range(inner):
        points = members.pop(node)
        if len(points):
            axis[node] = int(np.argmax(np.ptp(points, axis=0)))
            cut[node] = float(np.median(points[:, axis[node]]))
        right = points[:, axis[node]] > cut[node]
        members[2 * node + 1], members[2 * node + 2] = points[~right], points[right]
    return cells


class Tree(NamedTuple):
    """A shard's leaves: boxes and the rows in each."""

    low: np.ndarray
    high: np.ndarray
    rows: list[np.ndarray]


def build_tree(points: np.ndarray, leaf: int = LEAF) -> Tree:
    rows, waiting = [], [np.arange(len(points))]
    while waiting:
        own = waiting.pop()
        spread = np.ptp(points[own], axis=0)
        axis = int(spread.argmax())
        if len(own) <= leaf or spread[axis] == 0:
            rows.append(own)
            continue
        order = own[np.argpartition(points[own, axis], len(own) // 2)]
        waiting += [order[: len(own) // 2], order[len(own) // 2 :]]
    return Tree(np.array([points[r].min(axis=0) for r in rows]), np.array([points[r].max(axis=0) for r in rows]), rows)


def _box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points from boxes: a row per point."""
    outside = np.maximum(np.maximum(low - points[:, None], points[:, None] - high), 0)
    return (outside * outside).sum(axis=2)


class Found(NamedTuple):
    """Neighbours found, by number of the query, best first."""

    query: np.ndarray
    ids: np.ndarray
    scores: np.ndarray


def _best(found: list[Found], k: int) -> Found:
    """The best ``k`` of each query, each pair of id and score once."""
    query, ids, scores = (np.concatenate(column) for column in zip(*found))
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    fresh = np.ones(len(ids), bool)
    fresh[1:] = (query[1:] != query[:-1]) | (ids[1:] != ids[:-1]) | (scores[1:] != scores[:-1])
    query, ids, scores = query[fresh], ids[fresh], scores[fresh]
    keep = np.arange(len(query)) - np.searchsorted(query, query) < k
    return Found(query[keep], ids[keep], scores[keep])


def _kth(found: Found, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The queries that have ``k`` neighbours, and the score of the last."""
    last = np.flatnonzero(np.arange(len(found.query)) - np.searchsorted(found.query, found.query) == k - 1)
    return found.query[last], found.scores[last]


def search_batch(tree: Tree, points: np.ndarray, ids: np.ndarray, vectors: np.ndarray, queries: np.ndarray, at: np.ndarray, own: np.ndarray,
                 top: float, k: int, worst: np.ndarray, factor: float) -> Found:
    """Ids and inner products of the best ``k`` in the shard of each query; ``worst`` are known squared distances of their k-th.

    Queries go through their leaves in step, each in its own order. The queries that come to a leaf are multiplied with
    its vectors at once; only pairs that may enter a query's best are then checked and scored one by one.
    Candidates worse than a known k-th may be left out.
    """
    worst = worst.copy()
    base = top + (queries * queries).sum(axis=1)
    # Rounding of a product is far below this.
    room = 1e-9 * base
    enough = (base - worst) / 2 - room
    enough[~np.isfinite(enough)] = -inf
    near = _box_distances(at, tree.low, tree.high)
    order = np.argsort(near, axis=1, kind="stable")
    found = Found(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    place, step = 0, 1
    while place < order.shape[1]:
        visited = order[:, place : place + step]
        reach = np.take_along_axis(near, visited, axis=1) <= (worst * factor)[:, None]
        if not reach.any():
            break
        place, step = place + step, min(2 * step, 64)
        asking, column = np.nonzero(reach)
        leaf = visited[asking, column]
        by_leaf = np.argsort(leaf, kind="stable")
        asking, leaf = asking[by_leaf], leaf[by_leaf]
        edges = np.append(np.flatnonzero(np.diff(leaf, prepend=-1)), len(leaf))
        fresh, held = [found], 0
        for low, high in zip(edges, edges[1:]):
            who = asking[low:high]
            for rows in _runs(tree.rows[leaf[low]]):
                near_enough = ~(vectors[rows] @ queries[who].T < enough[who])
                row, query = np.nonzero(near_enough)
                row, query = rows[row], who[query]
                apart = points[row] - at[query]
                fine = (ids[row] != own[query]) & (np.isinf(worst[query]) | ((apart * apart).sum(axis=1) <= worst[query] * factor))
                row, query = row[fine], query[fine]
                fresh.append(Found(query, ids[row], _scores(vectors, queries, row, query)))
                held += len(row)
                if held > MOST_PAIRS:
                    fresh, held = [_best(fresh, k)], 0
        found = _best(fresh, k)
        full, score = _kth(found, k)
        # A hair of room, so that rounding never closes out equal scores.
        worst[full] = np.minimum(worst[full], np.maximum(base[full] - 2 * score, 0) * (1 + 1e-9) + 1e-12)
        enough[full] = np.maximum(enough[full], score - room[full])
    return found


def search(tree: Tree, points: np.ndarray, ids: np.ndarray, vectors: np.ndarray, query: np.ndarray, point: np.ndarray, own: int,
           top: float, k: int, worst: float, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """The same for one query."""
    found = search_batch(tree, points, ids, vectors, query[None], point[None], np.array([own]), top, k, np.array([worst], float), factor)
    return found.ids, found.scores


def _scores(vectors: np.ndarray, queries: np.ndarray, row: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of pairs, each by itself, so that equal vectors have equal scores."""
    out = np.empty(len(row))
    for i in range(0, len(row), SCORED_PAIRS):
        some = slice(i, i + SCORED_PAIRS)
        out[some] = (vectors[row[some]] * queries[query[some]]).sum(axis=1)
    return out


def _runs(rows: np.ndarray) -> list[np.ndarray]:
    """A leaf's rows in runs; only leaves of equal points are long."""
    return [rows[i : i + RUN_ROWS] for i in range(0, len(rows), RUN_ROWS)]


def _dense(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)


SHARD = "cell int, salt int, query boolean, id bigint, worst double, vector array<double>"


def _placed(vectors: DataFrame, shared, length: int) -> DataFrame:
    """Valid vectors with their cell."""

    def run(batches):
        cells = shared.value
        for batch in batches:
            dense = _dense(batch.column(1), length)
            cell = cells.cell(cells.project(dense, True))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cell.astype(np.int32)), batch.column(1)], names=["id", "cell", "vector"])

    return vectors.mapInArrow(run, "id bigint, cell int, vector array<double>")


def _searched(rows: DataFrame, shared, length: int, k: int, factor: float) -> DataFrame:
    """``query_id, vec_id, score`` of every shard's queries, from shards' vectors and queries."""

    def run(batches):
        cells = shared.value
        key, parts, index = None, [], None

        def build():
            ids = np.concatenate([p[0] for p in parts])
            dense = np.concatenate([p[1] for p in parts])
            points = cells.project(dense, True)
            return build_tree(points), points, ids, dense

        for batch in batches:
            cell, salt = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            asks = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            ids, worst = batch.column(3).to_numpy(), batch.column(4).to_numpy(zero_copy_only=False)
            dense = _dense(batch.column(5), length)
            out: list[Found] = []
            edges = np.flatnonzero(np.diff(cell) | np.diff(salt) | np.diff(asks.astype(np.int8))) + 1
            for low, high in zip([0, *edges], [*edges, len(cell)]):
                if low == high:
                    continue
                if (cell[low], salt[low]) != key:
                    key, parts, index = (cell[low], salt[low]), [], None
                if not asks[low]:
                    parts.append((ids[low:high], dense[low:high]))
                    continue
                if not parts:
                    continue
                index = index or build()
                points = cells.project(dense[low:high], False)
                bounds = np.where(np.isnan(worst[low:high]), inf, worst[low:high])
                step = min(BATCH_QUERIES, max(1, BATCH_BOXES // len(index[0].rows)))
                for first in range(low, high, step):
                    some, own = slice(first, min(first + step, high)), slice(first - low, first - low + step)
                    found = search_batch(*index, dense[some], points[own], ids[some], cells.top, k, bounds[own], factor)
                    out.append(found._replace(query=ids[some][found.query]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(column)) for column in zip(*out)], names=["query_id", "vec_id", "score"])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "cell", "salt").sortWithinPartitions("cell", "salt", "query")
    return dealt.mapInArrow(run, "query_id bigint, vec_id bigint, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_neighbours(
    vectors: DataFrame, is_query, *, vec_id="vec_id", vector="embedding", k: int = 20, dimensions: int = DIMENSIONS,
    confidence: float = CONFIDENCE, sample_rows: int = SAMPLE_ROWS, shard_rows: int = SHARD_ROWS, seed: int = SEED,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: up to ``k`` neighbours of the rows where ``is_query`` (a column of ``id``) holds."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector")).where("id IS NOT NULL")
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < inf)) & F.exists("vector", lambda v: v != 0)
    valid = rows.where(F.coalesce(finite, F.lit(False)))
    length = F.size("vector")
    squared = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v)
    sizes = valid.groupBy(length.alias("length")).agg(F.count(F.lit(1)).alias("n"), F.max(squared).alias("top"))
    most = sizes.orderBy(F.desc("n"), "length").first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if most is None:
        return empty
    # Equal rows of one id are one row from here on: every cut to k counts them once.
    valid = stored(valid.where(length == most["length"]).distinct(), "vectors")
    levels = min(int(np.log2(MOST_CELLS)), max(0, int(np.ceil(np.log2(max(1, most["n"] / shard_rows))))))
    sample = valid.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(sample_rows).select("vector")
    sampled = np.array([r.vector for r in sample.collect()], float)
    matrix = np.random.default_rng(seed).standard_normal((most["length"] + 1, dimensions))
    cells = _fit_cells(sampled, matrix, float(most["top"]), levels)
    shared = spark.sparkContext.broadcast(cells)
    placed = stored(_placed(valid, shared, most["length"]), "placed", valid)

    def points(batches):
        for batch in batches:
            projected = shared.value.project(_dense(batch.column(1), most["length"]), True)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(projected.ravel()), dimensions).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["cell", "point"])

    axes = range(dimensions)
    boxes = placed.select("cell", "vector").mapInArrow(points, "cell int, point array<double>").groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), *[F.min(F.col("point")[i]).alias(f"low{i}") for i in axes], *[F.max(F.col("point")[i]).alias(f"high{i}") for i in axes]
    ).orderBy("cell").collect()  # at most MOST_CELLS rows
    low = np.array([[b[f"low{i}"] for i in axes] for b in boxes])
    high = np.array([[b[f"high{i}"] for i in axes] for b in boxes])
    numbers = np.array([b.cell for b in boxes])
    salts = np.array([-(-b.n // shard_rows) for b in boxes])
    factor = chi_square_quantile(confidence, dimensions)
    layout = spark.sparkContext.broadcast((low, high, numbers, salts))

    def salted(batches):
        _, _, known, parts = layout.value
        for batch in batches:
            ids, cell = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            salt = (ids * 2654435761 % 2**31) % parts[np.searchsorted(known, cell)]
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(salt.astype(np.int32)), pa.array(np.zeros(n, bool)), batch.column(0), pa.nulls(n, pa.float64()), batch.column(2)],
                names=["cell", "salt", "query", "id", "worst", "vector"],
            )

    data = placed.mapInArrow(salted, SHARD)

    def visits(home: bool):
        """A row for each shard a query visits: those of its own cell, or those of the others in reach."""
        def run(batches):
            lows, highs, known, parts = layout.value
            for batch in batches:
                ids, cell, worst = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
                at = shared.value.project(_dense(batch.column(3), most["length"]), False)
                take, into, salt = [], [], []
                step = max(1, BATCH_BOXES // len(known))
                for first in range(0, len(ids), step):
                    some = slice(first, first + step)
                    own = known == cell[some, None]
                    if not home:
                        reach = np.where(np.isnan(worst[some]), inf, worst[some] * factor)
                        own = ~own & (_box_distances(at[some], lows, highs) <= reach[:, None])
                    asking, c = np.nonzero(own)
                    take.append(np.repeat(first + asking, parts[c]))
                    into.append(np.repeat(known[c], parts[c]))
                    salt.append(np.arange(parts[c].sum()) - np.repeat(np.cumsum(parts[c]) - parts[c], parts[c]))
                take, into, salt = (np.concatenate([np.zeros(0, np.int64), *column]) for column in (take, into, salt))
                n, taken = len(take), pa.array(take)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(into.astype(np.int32)), pa.array(salt.astype(np.int32)), pa.array(np.ones(n, bool)), batch.column(0).take(taken), batch.column(2).take(taken), batch.column(3).take(taken)],
                    names=["cell", "salt", "query", "id", "worst", "vector"],
                )

        return run

    asked = placed.where(is_query(F.col("id")))
    first = asked.select("id", "cell", F.lit(None).cast("double").alias("worst"), "vector").mapInArrow(visits(True), SHARD)
    near = stored(_ranked(_searched(data.unionByName(first), shared, most["length"], k, factor).distinct(), k), "near")
    kth = near.where(F.col("rank") == k).select(F.col("query_id").alias("id"), "score")
    # A query with fewer than k so far has no bound; greatest() alone would make null a bound of 0.
    bound = F.greatest(F.lit(float(most["top"])) + F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v) - 2 * F.col("score"), F.lit(0.0)) * (1 + 1e-9) + 1e-12
    again = asked.join(kth, "id", "left").select("id", "cell", F.when(F.col("score").isNotNull(), bound).alias("worst"), "vector").distinct().mapInArrow(visits(False), SHARD)
    far = _searched(data.unionByName(again), shared, most["length"], k, factor)
    both = near.select("query_id", "vec_id", "score").unionByName(far).distinct()
    return _ranked(both, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
