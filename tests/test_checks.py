from __future__ import annotations

import random

import pytest

from tallyloom.operators import checks


def test_set_reconcile_ignores_copies_and_matches_nulls(spark, rows):
    schema = "k int, s string"
    actual = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c"), (3, "c")], schema)
    expected = spark.createDataFrame([(1, "a"), (2, None), (4, "d"), (4, "d")], schema)
    assert sorted(rows(checks.set_reconcile(actual, expected))) == [
        ("missing", 4, "d"), ("unexpected", 3, "c"),
    ]
    assert rows(checks.set_reconcile(actual, actual)) == []


def brute_rises(data):
    found = []
    for group in {g for g, _, _ in data}:
        line = sorted((p, v) for g, p, v in data if g == group)
        for (_, before), (position, value) in zip(line, line[1:]):
            if before is not None and value is not None and before < value:
                found.append((group, position, value, before))
    return sorted(found)


@pytest.mark.parametrize("range_rows", [5_000_000, 37, 5, 1])
def test_order_check_equals_brute_force_whatever_the_ranges(spark, rows, range_rows):
    chance = random.Random(2)
    data = [("hot", p * 3, chance.randrange(50)) for p in range(300)]
    data += [(f"g{i % 40}", 1000 - i, chance.randrange(50)) for i in range(400)]
    frame = spark.createDataFrame(data, "g string, p int, v int")
    found = checks.order_check(frame, ["g"], "p", "v", range_rows)
    assert found.columns == ["g", "p", "v", "previous"]
    assert sorted(rows(found)) == brute_rises(data)


def test_order_check_on_a_ranking(spark, rows):
    ranking = spark.createDataFrame([("r", 0, 3), ("r", 1, 3), ("r", 2, 1)], "r string, i int, n int")
    assert rows(checks.order_check(ranking, ["r"], "i", "n")) == []
    empty = ranking.limit(0)
    assert rows(checks.order_check(empty, ["r"], "i", "n")) == []


@pytest.mark.parametrize("range_rows", [100, 1])
def test_a_null_position_comes_first(spark, rows, range_rows):
    frame = spark.createDataFrame([("g", None, 1), ("g", 1, 5), ("g", 2, 3), ("g", 3, 9)], "g string, p int, v int")
    found = checks.order_check(frame, ["g"], "p", "v", range_rows)
    assert sorted(rows(found)) == [("g", 1, 5, 1), ("g", 3, 9, 3)]


@pytest.mark.parametrize("range_rows", [1000, 7])
@pytest.mark.parametrize("kind", ["date", "timestamp"])
def test_dates_and_timestamps_are_positions(spark, rows, range_rows, kind):
    numbers = spark.range(60).selectExpr("1 AS g", "cast(id AS int) AS i", "cast((id * 37) % 11 AS int) AS v")
    day = {"date": "date_add(date'2020-01-01', i)", "timestamp": "timestamp'2020-01-01' + make_interval(0, 0, 0, 0, i)"}
    frame = numbers.selectExpr("g", f"{day[kind]} AS p", "v")
    found = checks.order_check(frame, ["g"], "p", "v", range_rows).select("v", "previous")
    values = [(i * 37) % 11 for i in range(60)]
    assert sorted(rows(found)) == sorted((b, a) for a, b in zip(values, values[1:]) if a < b)


def test_text_positions_are_refused(spark):
    frame = spark.createDataFrame([("g", "a", 1)], "g string, p string, v int")
    with pytest.raises(ValueError, match="positions must be"):
        checks.order_check(frame, ["g"], "p", "v")
