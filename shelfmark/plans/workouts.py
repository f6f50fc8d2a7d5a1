"""Queries over the workout logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.scalars import array_mean_int
from shelfmark.operators.aggregates import distinct_per_group
from shelfmark.operators.ranking import order_by_count, shares_with_others, top_k


def with_record_count(workouts: DataFrame, samples: str = "timestamp") -> DataFrame:
    """Number of samples per workout; NULL where the array is NULL."""
    return workouts.withColumn("per_workout_record_count", F.size(samples))


def with_mean_heart_rate(workouts: DataFrame) -> DataFrame:
    return workouts.withColumn("avg_heart_rate", array_mean_int(F.col("heart_rate")))


def sports_by_users(workouts: DataFrame) -> DataFrame:
    return order_by_count(distinct_per_group(workouts, "sport", "userId", "users_count"), "users_count", "sport")


def top_sports_with_others(workouts: DataFrame, k: int = 5) -> DataFrame:
    """Sports with the most users, their share, and one row for all others.

    The total counts a user once per sport, so it exceeds the number of users.
    """
    return shares_with_others(distinct_per_group(workouts, "sport", "userId", "users_count"), "sport", "users_count", k)


def sports_by_mean_heart_rates(workouts: DataFrame, k: int = 20) -> DataFrame:
    """Sports by their number of distinct mean heart rates, with the mean itself.

    A workout without a mean counts as one more value, but not in the mean.
    """
    pairs = (
        with_mean_heart_rate(workouts)
        .groupBy("sport", "avg_heart_rate")
        .agg(F.count("avg_heart_rate").alias("_n"), F.sum("avg_heart_rate").alias("_sum"))
    )
    per_sport = pairs.groupBy("sport").agg(
        F.count(F.lit(1)).alias("distinct_means"),
        F.try_divide(F.sum("_sum"), F.sum("_n")).alias("mean_heart_rate"),
    )
    return top_k(per_sport, "distinct_means", "sport", k)
