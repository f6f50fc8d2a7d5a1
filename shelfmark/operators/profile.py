"""Dataset profiles, each in as few passes as Spark allows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.predicates import is_missing_number
from shelfmark.functions.scalars import has_zero_or_nan
from shelfmark.operators.aggregates import distinct_count, distinct_per_group, rows_per_group
from shelfmark.operators.joins import join_null_safe
from shelfmark.sources.storage import stored


def describe(df: DataFrame) -> DataFrame:
    """count, mean, stddev, min and max of the string and numeric columns."""
    return df.describe()


def size_summary(df: DataFrame, column: str, below: int) -> DataFrame:
    """Summary statistics, cut to ints, of a size column where it is ``< below``.

    The quartiles interpolate between neighbours. ``percentile`` keeps a count
    per distinct value, and an int column under a bound has few of those.
    """
    c = F.col(column)
    statistics = {
        "count": F.count(c),
        "mean": F.avg(c),
        "std": F.stddev_samp(c),
        "min": F.min(c),
        "25%": F.percentile(c, F.lit(0.25)),
        "50%": F.percentile(c, F.lit(0.5)),
        "75%": F.percentile(c, F.lit(0.75)),
        "max": F.max(c),
    }
    return df.where(c < below).agg(*(s.cast("int").alias(n) for n, s in statistics.items()))


def missing_counts(df: DataFrame, strings: list[str], numbers: list[str], arrays: list[str]) -> DataFrame:
    """Missing values per column in one pass; the rule follows the column's kind.

    An array column reports two counts: arrays holding a 0 or NaN, and NULL arrays.
    """
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in strings]
    counts += [F.count_if(is_missing_number(F.col(c))).alias(c) for c in numbers]
    for c in arrays:
        counts.append(F.count_if(has_zero_or_nan(F.col(c))).alias(f"{c}_zero_or_nan"))
        counts.append(F.count_if(F.col(c).isNull()).alias(f"{c}_null_array"))
    return df.agg(*counts)


def workout_totals(df: DataFrame) -> DataFrame:
    """Users, activity types, workouts and records of the whole dataset."""
    return df.agg(
        distinct_count("userId").alias("user_count"),
        distinct_count("sport").alias("activity_types_count"),
        distinct_count("id").alias("workouts_count"),
        F.sum("per_workout_record_count").alias("total_records_count"),
    )


def users_and_workouts_by_gender(df: DataFrame) -> DataFrame:
    """Distinct users and workouts per gender, a missing gender being a group."""
    return df.groupBy("gender").agg(
        distinct_count("userId").alias("user_count"), F.count(F.lit(1)).alias("workouts_count")
    )


def users_joined_to_workouts(df: DataFrame) -> DataFrame:
    """The same table from two groupings joined on the gender."""
    users = distinct_per_group(df, "gender", "userId", "user_count")
    workouts = rows_per_group(df, "gender", name="workouts_count")
    return join_null_safe(users, workouts, ["gender"])


def dataset_profile(df: DataFrame, size: str, below: int, strings: list[str], numbers: list[str], arrays: list[str]) -> DataFrame:
    """The whole profile of the workouts as ``measure`` and ``value``.

    Totals, the size summary, missing values, the summary statistics of the
    string and numeric columns (their numbers; a text has only a count), and users and workouts per
    gender. The columns are read and the arrays reduced once, to a narrow table
    in the shared folder that all measures are taken from.
    """
    flags = {}
    for c in arrays:
        flags[f"{c}_zero_or_nan"], flags[f"{c}_null_array"] = has_zero_or_nan(F.col(c)), F.col(c).isNull()
    narrow = stored(df.select(*strings, *numbers, size, *(v.alias(n) for n, v in flags.items())), "profile")
    missing = [F.count_if(F.col(c).isNull()).alias(c) for c in strings]
    missing += [F.count_if(is_missing_number(F.col(c))).alias(c) for c in numbers]
    missing += [F.count_if(n).alias(n) for n in flags]
    described = describe(narrow.select(*strings, *numbers))
    columns = [F.struct(F.lit(c).alias("name"), F.col(c).try_cast("double").alias("value")) for c in (*strings, *numbers)]
    described = described.select("summary", F.inline(F.array(*columns))).where("value is not null")
    genders = users_and_workouts_by_gender(narrow)
    gender = F.coalesce("gender", F.lit("none"))
    parts = [
        *(_listed(part) for part in (workout_totals(narrow), size_summary(narrow, size, below), narrow.agg(*missing))),
        described.select(F.concat_ws("_", "summary", "name").alias("measure"), "value"),
        *(
            genders.select(F.concat_ws("_", gender, F.lit(c)).alias("measure"), F.col(c).cast("double").alias("value"))
            for c in ("user_count", "workouts_count")
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def _listed(row: DataFrame) -> DataFrame:
    """One row as ``measure`` and ``value`` rows."""
    values = row.select(*(F.col(f"`{c}`").cast("double").alias(c) for c in row.columns))
    return values.unpivot([], [f"`{c}`" for c in values.columns], "measure", "value")
