from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from tallyloom import scratch
from tallyloom.operators import timeuse
from tallyloom.plans import queries, tables
from tallyloom.sources import articles, files


def save(tmp_path, name, *lines):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_lines(spark, rows, tmp_path):
    assert rows(files.read_lines(spark, save(tmp_path, "a.txt", "x,y", "", "z"))) == [
        ("x,y",), ("",), ("z",),
    ]


def test_survey_types_come_from_the_header(spark, rows, tmp_path):
    path = save(tmp_path, "s.csv", "tucaseid,telfs,t010101", "a,1,30", ",2.5,0")
    names, survey = files.read_survey(spark, path)
    assert names == ["tucaseid", "telfs", "t010101"]
    assert [f.dataType for f in survey.schema] == [StringType(), DoubleType(), DoubleType()]
    assert sorted(rows(survey)) == [("", 2.5, 0.0), ("a", 1.0, 30.0)]
    assert not any(f.nullable for f in files.survey_schema(names))
    with pytest.raises(ValueError):
        files.survey_schema([])


def test_headers_of_all_files_in_a_folder_are_dropped(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        save(tmp_path, name, "id,x", f"{name},1")
    _, survey = files.read_survey(spark, str(tmp_path))
    assert survey.count() == 2


@pytest.mark.parametrize("line", ["a,1,", "a,1,x", "a,1", "a,1,2,3"])
def test_bad_survey_lines_raise(spark, tmp_path, line):
    _, survey = files.read_survey(spark, save(tmp_path, "s.csv", "id,telfs,t010101", line))
    with pytest.raises(Exception):
        survey.collect()


def test_a_bad_value_raises_once_its_column_is_used(spark, tmp_path):
    _, survey = files.read_survey(spark, save(tmp_path, "s.csv", "id,telfs,t01", "a,1,"))
    with pytest.raises(Exception, match="t01 must not be null"):
        survey.select("t01").collect()


def test_odd_column_names(spark, rows, tmp_path):
    path = save(tmp_path, "s.csv", "id,it's.a `b`\\c,x y", "a,1,2", "b,3,")
    names, survey = files.read_survey(spark, path)
    assert survey.columns == names == ["id", "it's.a `b`\\c", "x y"]
    assert rows(survey.select("id")) == [("a",), ("b",)]
    with pytest.raises(Exception, match="x y must not be null"):
        survey.collect()


def test_inferred_types(spark, rows, tmp_path):
    names, frame = files.read_inferred(spark, save(tmp_path, "s.csv", "id,n,x", "a,1,1.5", "b,2,2"))
    assert names == ["id", "n", "x"]
    assert [f.dataType.simpleString() for f in frame.schema] == ["string", "int", "double"]
    assert sorted(rows(frame)) == [("a", 1, 1.5), ("b", 2, 2.0)]


def test_the_survey_file_is_packed_and_has_the_same_rows(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "FILE_LINES", 1500)
    number = F.col("id").cast("long")
    keys = [(number * k % 1000).alias(name) for k, name in ((7, "l_partkey"), (3, "l_suppkey"), (1, "l_orderkey"))]
    lines = spark.range(20_000).select(*keys, (number / 1000).cast("int").alias("l_linenumber"), (number % 50).cast("double").alias("l_quantity"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    survey = tables.survey(spark, str(tmp_path))
    survey.write.option("header", True).csv(f"{tmp_path}/plain")
    found = queries.src_csv_infer(spark, str(tmp_path))
    packed = [Path(file.removeprefix("file:")) for file in found.inputFiles()]
    plain = list((tmp_path / "plain").glob("*.csv"))
    assert 2 * sum(f.stat().st_size for f in packed) < sum(f.stat().st_size for f in plain) and len(packed) > len(plain)
    assert sorted(rows(found)) == sorted(rows(survey))


def test_typed_json(spark, rows, tmp_path):
    path = save(tmp_path, "p.json", '{"name": "Ann", "age": 3, "more": 1}', '{"name": "Bo"}')
    people = files.read_json(spark, path, "name string, age bigint")
    assert sorted(rows(people)) == [("Ann", 3), ("Bo", None)]


@pytest.mark.parametrize("line", ['{"age": "x"}', "no json", '{"name": "Ann", "age": 1'])
def test_broken_json_raises(spark, tmp_path, line):
    path = save(tmp_path, "p.json", '{"name": "Bo", "age": 1}', line)
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        files.read_json(spark, path, "name string, age bigint").collect()


def article_line(title, text):
    return f"<page> <title>{title}</title><text>{text}</text>  </page>"


def test_articles(spark, rows, tmp_path):
    path = save(
        tmp_path,
        "dump.dat",
        article_line("Java", "Java is </title><text> here"),
        article_line("", ""),
        article_line("Été", "naïve text"),
    )
    found = rows(articles.decode_articles(files.read_lines(spark, path)))
    assert found == [("Java", "Java is </title><text> here"), ("", ""), ("Été", "naïve text")]


@pytest.mark.parametrize(
    "line", ["", "no markup", "<title>x</title><text>y</text>", article_line("a", "")[:-1]]
)
def test_bad_article_lines_raise(spark, line):
    frame = spark.createDataFrame([(line,)], "value string")
    with pytest.raises(Exception, match="not an article line"):
        articles.decode_articles(frame).collect()


def test_tables_can_be_removed_and_nothing_else(spark, tmp_path):
    table = scratch.written(spark.range(3).toDF("n"), "gone")
    files_before = table.inputFiles()
    scratch.discard(table)
    assert not any(Path(f.removeprefix("file:")).exists() for f in files_before)
    with pytest.raises(ValueError):
        scratch.remove(spark, str(tmp_path))


def test_written_tables_land_in_the_shared_folder(spark, rows):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert scratch.shared_folder(spark) == folder
    frame = scratch.written(spark.range(5).toDF("n"), "numbers")
    assert sorted(rows(frame)) == [(i,) for i in range(5)]
    assert all(f"{folder}/numbers-" in path for path in frame.inputFiles())


def test_a_survey_of_hundreds_of_columns(spark, rows, tmp_path):
    codes = [f"t{a:02d}{b:02d}{c:02d}" for a in range(1, 19) for b in range(1, 6) for c in range(1, 6)]
    minutes = [str(i % 7) for i in range(len(codes))]
    path = save(
        tmp_path,
        "wide.csv",
        ",".join(["tucaseid", "telfs", "tesex", "teage", *codes]),
        ",".join(["a", "1", "1", "30", *minutes]),
    )
    groups = timeuse.classify_columns(codes)
    value = dict(zip(codes, map(int, minutes)))
    _, survey = files.read_survey(spark, path)
    hours = rows(timeuse.timeuse_summary(survey))[0][3:]
    assert hours == tuple(sum(value[name] for name in group) / 60.0 for group in groups)
    minutes_of = {n: m for n, _, m in rows(timeuse.activity_minutes(survey))}
    assert minutes_of == value


def test_survey_file_to_groups(spark, rows, tmp_path):
    path = save(
        tmp_path,
        "s.csv",
        "tucaseid,telfs,tesex,teage,t010101,t050101,t020101",
        "a,1,1,22,60,90,30",
        "b,2,1,20,120,90,30",
        "c,5,1,20,0,0,0",
    )
    from tallyloom.plans.jobs import time_use_by_life_period

    assert rows(time_use_by_life_period(spark, path)) == [("working", "male", "young", 1.5, 1.5, 0.5)]
    assert timeuse.HOURS == ["primaryNeeds", "work", "other"]
