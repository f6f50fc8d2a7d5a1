"""Counts, averages and one-row-per-key groupings.

All of them combine within each input partition before the shuffle, so a key
that holds a large share of the rows costs its task no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def distinct_count(column: str) -> Column:
    """Number of distinct values, NULL counting as one value."""
    return F.count_distinct(column) + F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))


def approx_distinct(column: str, error: float = 0.05) -> Column:
    """Estimated number of distinct values, for callers who ask for an estimate."""
    return F.approx_count_distinct(column, error)


def distinct_per_group(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Distinct (group, value) pairs, counted per group; a NULL value is a value."""
    return df.select(group, value).distinct().groupBy(group).agg(F.count(F.lit(1)).alias(name))


def rows_per_group(df: DataFrame, *groups: str, name: str = "row_count") -> DataFrame:
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias(name))


def sum_numeric(df: DataFrame) -> DataFrame:
    """One row with the sum of each numeric column, under the column's name."""
    kinds = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return df.agg(*(F.sum(n).alias(n) for n, k in df.dtypes if k in kinds or k.startswith("decimal")))


def yearly_averages(enriched: DataFrame, entity: str, measures: dict[str, str]) -> DataFrame:
    """Averages per entity and year; an unreadable date forms its own NULL year."""
    return (
        enriched.select(entity, F.year("review_date").alias("year"), *measures)
        .groupBy(entity, "year")
        .agg(*(F.avg(source).alias(name) for source, name in measures.items()))
    )


def rating_summary(enriched: DataFrame, entity: str) -> DataFrame:
    """Average rating and number of ratings per entity."""
    return enriched.groupBy(entity).agg(
        F.avg("rating").alias("avg_rating"), F.count("rating").alias("rating_count")
    )


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the smallest by ``order``, so the choice is repeatable."""
    rest = [c for c in order if c != key] + [c for c in df.columns if c not in (key, *order)]
    picked = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    return picked.select(*(F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns))
