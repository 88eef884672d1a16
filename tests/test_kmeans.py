from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.geometry import means_distance, nearest_center, nearest_center_few
from tallyloom.operators import kmeans as km
from tallyloom.operators import sampling

CENTERS = [(0, 5), (0, 5), (50_000, 3)]


def vectors(spark, data):
    rows = [(i, x, y) for i, (x, y) in enumerate(data)]
    return spark.createDataFrame(rows, "qid bigint, x int, y int")


def some_points(count, topics=3, seed=1):
    chance = random.Random(seed)
    return [(chance.randrange(topics) * 50_000, int(chance.expovariate(0.05))) for _ in range(count)]


def brute_nearest(point, centers):
    distances = [(point[0] - x) ** 2 + (point[1] - y) ** 2 for x, y in centers]
    return distances.index(min(distances))


def brute_kmeans(points, means, start, limit, eta):
    iteration = start
    while True:
        clusters = {}
        for p in points:
            clusters.setdefault(brute_nearest(p, means), []).append(p)
        new = [
            tuple(sum(c) // len(clusters[i]) for c in zip(*clusters[i])) if i in clusters else m
            for i, m in enumerate(means)
        ]
        moved = sum((a - c) ** 2 + (b - d) ** 2 for (a, b), (c, d) in zip(means, new))
        means = new
        if moved < eta or iteration >= limit:
            return means, iteration - start + 1
        iteration += 1


@pytest.mark.parametrize("closest", [nearest_center, nearest_center_few])
def test_ties_go_to_the_lowest_index(spark, rows, closest):
    frame = vectors(spark, [(0, 1), (0, 9), (50_000, 9), (50_000, 4)])
    assert rows(frame.orderBy("qid").select(closest("x", "y", CENTERS))) == [(0,), (0,), (2,), (2,)]


@pytest.mark.parametrize("closest", [nearest_center, nearest_center_few])
def test_nearest_center_equals_brute_force(spark, rows, closest):
    points = some_points(300)
    chance = random.Random(5)
    centers = [(chance.randrange(110_000), chance.randrange(-20, 80)) for _ in range(45)]
    found = rows(vectors(spark, points).orderBy("qid").select(closest("x", "y", centers)))
    assert found == [(brute_nearest(p, centers),) for p in points]
    assert rows(vectors(spark, points[:1]).select(closest("x", "y", centers[:1]))) == [(0,)]
    with pytest.raises(ValueError):
        closest("x", "y", [])


def test_distances_are_squared():
    assert means_distance([(0, 0), (1, 1)], [(3, 4), (1, 1)]) == 25.0
    with pytest.raises(ValueError):
        means_distance([(0, 0)], [])


def test_a_step_truncates_and_keeps_empty_means(spark):
    points = km.compact(vectors(spark, [(0, 1), (0, 9), (50_000, 9), (50_000, 4)]))
    for few in (True, False):
        assert km.kmeans_step(points, CENTERS, few) == [(0, 5), (0, 5), (50_000, 6)]


@pytest.mark.parametrize("few", [False, True])
@pytest.mark.parametrize("start", [1, 118])
def test_kmeans_equals_brute_force_on_uncompacted_points(spark, few, start):
    points = some_points(400)
    means = points[:9]
    found = km.kmeans(km.compact(vectors(spark, points)), means, start=start, eta=1.0)
    expected, rounds = brute_kmeans(points, means, start, 120, 1.0)
    assert (found.means, len(found.history)) == (expected, rounds)
    assert found.converged == (found.history[-1].distance < 1.0)
    assert found.history[0].old == means and found.history[-1].new == found.means


def test_a_late_start_leaves_three_rounds(spark):
    points = km.compact(vectors(spark, some_points(400)))
    found = km.kmeans(points, some_points(400)[:9], start=118, eta=0.0)
    assert [r.iteration for r in found.history] == [118, 119, 120]
    assert not found.converged
    assert found.history_frame(spark).count() == 27


def test_median_percent_and_label(spark, rows):
    points = [(0, 1), (0, 2), (0, 5), (0, 8), (50_000, 3), (50_000, 4), (100_000, 9), (100_000, 1)]
    means = [(0, 0), (75_000, 0), (900_000, 900)]
    results = km.cluster_results(km.compact(vectors(spark, points)), means, ["A", "B", "C"])
    assert results.columns == ["label", "percent", "size", "median"]
    # Scores 1, 3, 4, 9 and 1, 2, 5, 8 both have the median 3.5, cut to 3; B and C are tied.
    assert rows(results) == [("A", 100.0, 4, 3), ("B", 50.0, 4, 3)]
    report = km.cluster_report(results)
    assert rows(report)[0] == ("      3  A                 (100.0%)            4",)


def test_report_is_printed_with_its_header(spark, capsys):
    points = km.compact(vectors(spark, [(0, 1)]))
    km.print_report(km.cluster_results(points, [(0, 0)], ["A"]))
    printed = capsys.readouterr().out.splitlines()
    assert printed[:3] == list(km.REPORT_HEADER)
    assert printed[3:] == ["      1  A                 (100.0%)            1"]


def test_invariants_of_a_whole_clustering(spark):
    points = some_points(500, topics=4)
    frame = vectors(spark, points)
    means = km.initial_means(frame, 4, 12)
    compacted = km.compact(frame)
    found = km.kmeans(compacted, means)
    results = km.cluster_results(compacted, found.means, ["A", "B", "C", "D"]).collect()
    assert sum(r["size"] for r in results) == len(points)
    assert len(results) <= 12
    assert {r["label"] for r in results} <= set("ABCD")
    assert all(r["percent"] == 100.0 for r in results)
    assert [r["median"] for r in results] == sorted(r["median"] for r in results)


def test_samples_do_not_depend_on_partitions(spark, rows):
    points = some_points(300)
    for draw in (
        lambda f: sampling.sample_uniform(f, 20),
        lambda f: sampling.sample_stratified(f, 4),
    ):
        one = sorted(rows(draw(vectors(spark, points).coalesce(1))))
        assert one == sorted(rows(draw(vectors(spark, points).repartition(7))))
    assert len(one) == 12 and {x for _, x, _, _ in one} == {0, 50_000, 100_000}
    other = sampling.sample_uniform(vectors(spark, points), 20, seed=7)
    assert sorted(rows(other)) != sorted(rows(sampling.sample_uniform(vectors(spark, points), 20)))


def test_samples_are_exact_and_without_replacement(spark):
    frame = vectors(spark, some_points(300))
    drawn = sampling.sample_uniform(frame, 45).select("qid").collect()
    assert len({r["qid"] for r in drawn}) == 45
    assert sampling.sample_uniform(frame, 1000).count() == 300


def test_every_row_is_drawn_about_equally_often(spark):
    frame = vectors(spark, [(0, i) for i in range(20)]).persist()
    hits = [0] * 20
    for seed in range(60):
        for row in sampling.sample_stratified(frame, 5, seed).collect():
            hits[row["qid"]] += 1
    assert sum(hits) == 300 and min(hits) > 3 and max(hits) < 30


def test_start_points(spark):
    frame = vectors(spark, some_points(300))
    means = km.initial_means(frame, 3, 9)
    assert [x for x, _ in means] == [0] * 3 + [50_000] * 3 + [100_000] * 3
    near = frame.withColumn("x", F.col("x") / 500)
    assert len(km.initial_means(near.select("qid", F.col("x").cast("int"), "y"), 3, 10, spread=100)) == 10


def test_start_points_need_enough_vectors(spark):
    few = vectors(spark, [(0, 1), (0, 2), (50_000, 1)])
    with pytest.raises(ValueError, match="fewer than 2"):
        km.initial_means(few, 2, 4)
    with pytest.raises(ValueError, match="multiple"):
        km.initial_means(few, 2, 5)
    with pytest.raises(ValueError, match="needed"):
        km.initial_means(few, 3, 3)
    with pytest.raises(ValueError, match="needed"):
        km.initial_means(few, 3, 6, spread=100)
