from __future__ import annotations

import pytest

from tallyloom.operators import timeuse

COLUMNS = (
    "tucaseid string, telfs double, tesex double, teage double, t010101 double, t180301 double, "
    "t050101 double, t180501 double, t020101 double, t189999 double, t170101 double"
)
PEOPLE = [
    ("a", 1.0, 1.0, 22.0, 480.0, 60.0, 240.0, 60.0, 30.0, 30.0, 999.0),
    ("b", 3.0, 2.0, 23.0, 600.0, 0.0, 0.0, 0.0, 120.0, 0.0, 999.0),
    ("c", 4.0, 2.0, 56.0, 540.0, 0.0, 0.0, 0.0, 60.0, 60.0, 999.0),
    ("d", 5.0, 1.0, 40.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 999.0),
]
SUMMARY = [
    ("working", "male", "young", 9.0, 5.0, 1.0),
    ("not working", "female", "active", 10.0, 0.0, 2.0),
    ("not working", "female", "elder", 9.0, 0.0, 2.0),
]


@pytest.fixture
def summary(spark):
    return timeuse.timeuse_summary(spark.createDataFrame(PEOPLE, COLUMNS))


def test_columns_are_classified_by_the_first_fitting_prefix():
    names = ["tucaseid", "t010101", "t180101", "t180301", "t180501", "t181801", "t05", "t1", "t17", "t50", "telfs", "t16"]
    assert timeuse.classify_columns(names) == (
        ["t010101", "t180101", "t180301"],
        ["t180501", "t05"],
        ["t181801", "t16"],
    )


def test_summary(summary, rows):
    assert summary.columns == timeuse.TIME_USAGE_SCHEMA.names
    assert rows(summary) == SUMMARY


@pytest.mark.parametrize(
    "telfs, teage, expected",
    [
        (0, 14, ("not working", "elder")),
        (1, 15, ("working", "young")),
        (2, 22, ("working", "young")),
        (3, 23, ("not working", "active")),
        (4, 55, ("not working", "active")),
        (2, 56, ("working", "elder")),
        (5, 30, None),
        (None, 30, None),
    ],
)
def test_label_edges(spark, rows, telfs, teage, expected):
    data = [(telfs, 1, teage, 60.0)]
    frame = spark.createDataFrame(data, "telfs int, tesex int, teage int, t010101 double")
    found = [(r[0], r[2]) for r in rows(timeuse.timeuse_summary(frame))]
    assert found == ([expected] if expected else [])


def test_the_three_routes_agree(spark, rows, summary):
    doubled = summary.unionByName(summary.withColumn("work", summary["work"] + 0.5))
    expected = [
        ("not working", "female", "active", 10.0, 0.3, 2.0),
        ("not working", "female", "elder", 9.0, 0.3, 2.0),
        ("working", "male", "young", 9.0, 5.3, 1.0),
    ]
    assert rows(timeuse.timeuse_grouped(doubled)) == expected
    assert rows(timeuse.timeuse_sql(doubled)) == expected
    assert rows(timeuse.timeuse_sql(doubled, "other_view")) == expected
    typed = timeuse.timeuse_typed(timeuse.timeuse_typed_rows(doubled))
    assert rows(typed) == expected
    fixed = [(f.name, f.dataType) for f in timeuse.TIME_USAGE_SCHEMA]
    assert [(f.name, f.dataType) for f in typed.schema] == fixed


def test_rows_that_do_not_fit_the_schema_fail(spark, summary):
    with pytest.raises(Exception):
        timeuse.timeuse_typed_rows(summary.drop("work"))
    with pytest.raises(Exception):
        timeuse.timeuse_typed_rows(summary.withColumn("work", summary["sex"]))


def test_activity_minutes(spark, rows):
    found = rows(timeuse.activity_minutes(spark.createDataFrame(PEOPLE, COLUMNS)))
    assert ("t180301", "primaryNeeds", 61.0) in found
    assert ("t170101", None, 3996.0) in found
    assert len(found) == 7
