"""Time-use surveys: classify activity columns, summarise respondents, average per group."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, NumericType, StringType, StructField, StructType

# Activity code prefixes of the survey.
PRIMARY_PREFIXES = ("t01", "t03", "t11", "t1801", "t1803")
WORK_PREFIXES = ("t05", "t1805")
OTHER_PREFIXES = (
    "t02", "t04", "t06", "t07", "t08", "t09", "t10", "t12", "t13", "t14", "t15", "t16", "t18",
)

TIME_USAGE_SCHEMA = StructType(
    [
        StructField("working", StringType()),
        StructField("sex", StringType()),
        StructField("age", StringType()),
        StructField("primaryNeeds", DoubleType()),
        StructField("work", DoubleType()),
        StructField("other", DoubleType()),
    ]
)
KEYS = TIME_USAGE_SCHEMA.names[:3]
HOURS = TIME_USAGE_SCHEMA.names[3:]


class ActivityColumns(NamedTuple):
    primary_needs: list[str]
    work: list[str]
    other: list[str]


def classify_columns(names: Sequence[str]) -> ActivityColumns:
    """Column names by activity group; the first group whose prefix fits wins."""
    groups = ActivityColumns([], [], [])
    for name in names:
        for members, prefixes in zip(groups, (PRIMARY_PREFIXES, WORK_PREFIXES, OTHER_PREFIXES)):
            if name.startswith(prefixes):
                members.append(name)
                break
    return groups


def _hours(names: Sequence[str]) -> Column:
    """Sum of minute columns, in hours.

    Columns are added in pairs, then the pairs, and so on: a real survey has hundreds of them, and
    one long chain of additions would be too deep for the analyser. Whole minutes add up exactly
    in any order.
    """
    terms = [F.col(f"`{name}`") for name in names] or [F.lit(0.0)]
    while len(terms) > 1:
        paired = [a + b for a, b in zip(terms[::2], terms[1::2])]
        terms = paired + terms[2 * len(paired) :]
    return terms[0] / F.lit(60.0)


def _labels() -> list[Column]:
    working = F.when((F.col("telfs") >= 1) & (F.col("telfs") < 3), "working")
    sex = F.when(F.col("tesex") == 1, "male")
    age = F.when(F.col("teage").between(15, 22), "young").when(
        F.col("teage").between(23, 55), "active"
    )
    return [
        working.otherwise("not working").alias("working"),
        sex.otherwise("female").alias("sex"),
        age.otherwise("elder").alias("age"),
    ]


def timeuse_summary(survey: DataFrame, groups: ActivityColumns | None = None) -> DataFrame:
    """One row per employable respondent: three labels and three sums of hours."""
    groups = groups or classify_columns(survey.columns)
    return survey.where("telfs <= 4").select(
        *_labels(),
        _hours(groups.primary_needs).alias("primaryNeeds"),
        _hours(groups.work).alias("work"),
        _hours(groups.other).alias("other"),
    )


def activity_classes(spark: SparkSession) -> DataFrame:
    """``prefix, category, rank``: the prefixes as a table; of several that fit the lowest rank wins."""
    groups = (("primaryNeeds", PRIMARY_PREFIXES), ("work", WORK_PREFIXES), ("other", OTHER_PREFIXES))
    rows = ", ".join(f"('{p}', '{category}', {rank})" for rank, (category, prefixes) in enumerate(groups) for p in prefixes)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS classes(prefix, category, rank)")


def classified_names(names: DataFrame, classes: DataFrame) -> DataFrame:
    """``name, category`` of the names that start with a prefix. Every beginning of a name is looked up, by equality."""
    beginnings = F.transform(F.sequence(F.lit(1), F.length("name")), lambda n: F.left("name", n))
    found = names.distinct().select("name", F.explode(beginnings).alias("prefix")).join(classes, "prefix")
    return found.groupBy("name").agg(F.min(F.struct("rank", "category"))["category"].alias("category"))


def timeuse_summary_long(survey: DataFrame, respondent: str = "tucaseid", classes: DataFrame | None = None) -> DataFrame:
    """:func:`timeuse_summary` with the classes as data: minutes in long form meet a table of prefixes.

    Rows are put together again by ``respondent`` and a fingerprint of their numbers; equal rows are told apart by how often
    their names come. A row's minutes are made and added up again in one task, so a row per respondent is shuffled. The
    table of names has a row per column of the survey, which bounds what the join broadcasts.
    """
    spark = survey.sparkSession
    labelled = {"telfs", "tesex", "teage", respondent}
    numbers = [f.name for f in survey.schema if f.name not in labelled and isinstance(f.dataType, NumericType)]
    if not numbers:
        return timeuse_summary(survey)
    names = spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in numbers])).alias("name"))
    category = classified_names(names, classes or activity_classes(spark))
    columns = [F.col(f"`{n}`").cast("double").alias(n) for n in numbers]
    short = survey.where("telfs <= 4").select(F.struct(F.col(f"`{respondent}`"), F.xxhash64(*columns)).alias("_row"), *_labels(), *columns)
    long = short.unpivot(["_row", *KEYS], [F.col(f"`{n}`") for n in numbers], "name", "minutes")
    grouped = long.join(F.broadcast(category), "name", "left").groupBy("_row", *KEYS)
    hours = [F.sum(F.when(F.col("category") == name, F.col("minutes")).otherwise(0.0)).alias(name) for name in HOURS]
    copies = (F.count(F.lit(1)) / F.lit(len(numbers))).cast("int").alias("_copies")
    each = [(F.col(name) / F.col("_copies") / F.lit(60.0)).alias(name) for name in HOURS]
    return grouped.agg(*hours, copies).select(*KEYS, *each, F.explode(F.sequence(F.lit(1), "_copies"))).drop("col")


def timeuse_typed_rows(summary: DataFrame) -> DataFrame:
    """The summary under its fixed schema; a frame that does not fit fails at analysis.

    The columns are selected first, as a missing one would otherwise be filled with nulls.
    """
    return summary.select(*TIME_USAGE_SCHEMA.names).to(TIME_USAGE_SCHEMA)


def timeuse_grouped(summary: DataFrame) -> DataFrame:
    """Mean hours to one decimal per working status, sex and age, in that order."""
    means = [F.round(F.avg(name), 1).alias(name) for name in HOURS]
    return summary.groupBy(*KEYS).agg(*means).orderBy(*KEYS)


def grouped_sql(view: str) -> str:
    """The SQL text that does the same over a view."""
    return f"""
        SELECT working, sex, age,
               round(avg(primaryNeeds), 1) AS primaryNeeds,
               round(avg(work), 1) AS work,
               round(avg(other), 1) AS other
        FROM `{view}`
        GROUP BY working, sex, age
        ORDER BY working, sex, age
    """


def timeuse_sql(summary: DataFrame, view: str = "summed") -> DataFrame:
    """Like :func:`timeuse_grouped`, as SQL over a registered view."""
    summary.createOrReplaceTempView(view)
    return summary.sparkSession.sql(grouped_sql(view))


def timeuse_typed(rows: DataFrame) -> DataFrame:
    """Like :func:`timeuse_grouped`, from and to rows of the fixed schema."""
    return timeuse_typed_rows(timeuse_grouped(timeuse_typed_rows(rows)))


def activity_minutes(survey: DataFrame) -> DataFrame:
    """``name, category, minutes`` per activity column: how it is classified and its total.

    Columns in no group have a null category. One pass that sums every column at once.
    """
    groups = classify_columns(survey.columns)
    labels = {
        name: label
        for label, members in zip(("primaryNeeds", "work", "other"), groups)
        for name in members
    }
    names = [name for name in survey.columns if name.startswith("t") and name[1:].isdigit()]
    totals = survey.agg(*[F.sum(F.col(f"`{name}`")).alias(name) for name in names])
    entries = [
        F.struct(
            F.lit(name).alias("name"),
            F.lit(labels.get(name)).cast("string").alias("category"),
            F.col(f"`{name}`").alias("minutes"),
        )
        for name in names
    ]
    return totals.select(F.inline(F.array(*entries)))
