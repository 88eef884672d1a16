from __future__ import annotations

import pytest

from tallyloom.operators import relational as rel

PEOPLE = [
    (1, "Ida", "Lund", "Oslo"),
    (2, "Per", "Holm", "Bergen"),
    (3, "Liv", "Lund", "Atlanta"),
    (4, "Kaja", "Lund", "Atlanta"),
    (5, "Bo", "Lund", "Atlanta"),
]
LISTINGS = [
    ("Mill Lane 1", 20111, 310000),
    ("Mill Lane 2", 20111, 410000),
    ("Mill Lane 3", 20111, 210000),
    ("High Street 1", 20222, 840000),
    ("High Street 2", 20222, 740000),
    ("High Street 3", 20222, 640000),
]
POSTS = (
    [(7, "tea", 2, "Feb 1"), (7, "rye", 2, "Feb 1"), (7, "tea", 9, "May 3")]
    + [(8, "rye", 9, "May 3"), (8, "ale", 9, "May 3"), (8, "rye", 4, "Aug 9")]
    + [(9, "ale", 6, "Sep 2")] * 4
)


@pytest.fixture
def listings(spark):
    return spark.createDataFrame(LISTINGS, rel.LISTING_SCHEMA)


@pytest.mark.parametrize("ages", [(49, 49, 17, 13, 8), (50, 50, 18, 14, 10)])
def test_young_team(spark, rows, ages):
    people = [(i, f, n, age, c) for (i, f, n, c), age in zip(PEOPLE, ages)]
    employees = spark.createDataFrame(people, rel.EMPLOYEE_SCHEMA)
    assert rows(rel.young_team(employees)) == [(4, "Lund", "Kaja"), (5, "Lund", "Bo")]
    atlanta = rel.select_where_sort(employees, ["id"], "city == 'Atlanta'", ["id"])
    assert rows(atlanta) == [(3,), (4,), (5,)]


def test_groups(listings, rows):
    assert sorted(rows(rel.group_max(listings, "zip", "price"))) == [(20111, 410000), (20222, 840000)]
    assert sorted(rows(rel.group_min(listings, "zip", "price"))) == [(20111, 210000), (20222, 640000)]
    means = [(20111, 310000.0), (20222, 740000.0)]
    assert sorted(rows(rel.group_avg(listings, "zip", "price"))) == means
    typed = rel.group_avg_typed(listings, "zip", "price")
    assert sorted(rows(typed)) == means
    assert [f.dataType.simpleString() for f in typed.schema] == ["int", "double"]


def test_posts_per_author_and_forum(spark, rows):
    posts = spark.createDataFrame(POSTS, rel.POST_SCHEMA)
    assert rows(rel.group_count_2key(posts, "author", "forum")) == [
        (9, "ale", 4), (8, "ale", 1), (8, "rye", 2), (7, "rye", 1), (7, "tea", 2),
    ]


def test_unknown_authors_do_not_count(spark, rows):
    posts = spark.createDataFrame([(None, "fun", 1, "x"), (1, "fun", 1, "x")], rel.POST_SCHEMA)
    assert sorted(rows(rel.group_count_2key(posts, "author", "forum")), key=str) == [
        (1, "fun", 1), (None, "fun", 0),
    ]


@pytest.mark.parametrize("numbers, total, largest", [((1, 2, 0), 3, 2), ((3, 7, 2), 12, 7), ((-5,), -5, -5)])
def test_sum_and_max(spark, rows, numbers, total, largest):
    frame = spark.createDataFrame([(n,) for n in numbers], "x int")
    assert rows(rel.global_sum(frame, "x")) == [(total,)]
    assert rows(rel.global_max(frame, "x")) == [(largest,)]
    assert rows(rel.row_count(frame)) == [(len(numbers),)]


def test_no_rows(spark, rows):
    empty = spark.createDataFrame([], "x int")
    assert rows(rel.global_sum(empty, "x")) == [(0,)]
    assert rows(rel.row_count(empty)) == [(0,)]
    with pytest.raises(Exception, match="not defined"):
        rel.global_max(empty, "x").collect()


def test_row_extract(spark, rows, listings):
    averages = rel.group_avg(listings, "zip", "price")
    typed = rel.row_extract(averages, {"zip": "int", "avg_price": "double"})
    assert sorted(rows(typed)) == [(20111, 310000.0), (20222, 740000.0)]
    with pytest.raises(TypeError):
        rel.row_extract(averages, {"zip": "string", "avg_price": "int"})
    text = spark.createDataFrame([("7", "2.5"), (None, None)], "a string, b string")
    assert rows(rel.row_extract(text, {"a": "int", "b": "double"})) == [(7, 2.5), (None, None)]
    with pytest.raises(Exception, match="not a valid int"):
        rel.row_extract(text, {"b": "int"}).collect()


def test_showing_collecting_and_printing_a_schema(listings, capsys):
    averages = rel.group_avg(listings, "zip", "price")
    averages.orderBy("zip").show()
    averages.printSchema()
    printed = capsys.readouterr().out
    assert "|20111| 310000.0|" in printed
    assert " |-- zip: integer (nullable = true)" in printed
    assert " |-- avg_price: double (nullable = true)" in printed
    assert {r["zip"]: r["avg_price"] for r in averages.collect()} == {20111: 310000.0, 20222: 740000.0}
