"""Orderings, top-k tables and shares of a total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.scalars import percent_of


def top_k(df: DataFrame, measure: str, key: str, k: int) -> DataFrame:
    """The ``k`` rows with the largest measure; ties in key order."""
    return df.orderBy(F.desc(measure), F.asc_nulls_last(key)).limit(k)


def order_by_count(df: DataFrame, count: str, key: str) -> DataFrame:
    return df.orderBy(F.desc(count), F.asc_nulls_last(key))


def append_rows(df: DataFrame, extra: DataFrame) -> DataFrame:
    """Union of all rows, columns matched by name."""
    return df.unionByName(extra)


def shares_with_others(counts: DataFrame, key: str, count: str, k: int = 5, others: str = "others") -> DataFrame:
    """Top-k groups with their percentage of the total, plus one row for the rest.

    ``counts`` holds one row per group. The rest row is present even when it is
    empty, and its percentage is what the top groups leave of 100.
    """
    top = top_k(counts, count, key, k)
    total = counts.agg(F.sum(count)).scalar()
    named = top.select(key, count, percent_of(F.col(count), total).alias("percentage"))
    summed = top.agg(F.coalesce(F.sum(count), F.lit(0)).alias("_top"))
    rest = summed.select(
        F.lit(others).alias(key),
        (F.coalesce(total, F.lit(0)) - F.col("_top")).alias(count),
        (F.lit(100.0) - F.coalesce(percent_of(F.col("_top"), total), F.lit(0.0))).alias("percentage"),
    )
    return append_rows(named, rest)
