"""Key and constraint checks, and dense surrogate keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators.joins import lookup_join
from shelfmark.sources.storage import stored


def primary_key_violations(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that are NULL or occur more than once, with their row counts."""
    no_key = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where((F.col("row_count") > 1) | no_key)


def foreign_key_violations(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key is set but absent from the parent table."""
    return lookup_join(df.where(F.col(key).isNotNull()), parent.select(key).distinct(), [key], "left_anti")


def length_violations(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """One row per text value longer than its column allows."""
    over = F.array(
        *(
            F.when(
                F.length(c) > limit,
                F.struct(F.lit(c).alias("column_name"), F.length(c).alias("length"), F.col(c).alias("value")),
            )
            for c, limit in limits.items()
        )
    )
    return df.select(F.inline(F.filter(over, lambda v: v.isNotNull())))


def add_surrogate_key(df: DataFrame, name: str = "review_id", order: list[str] | None = None) -> DataFrame:
    """Numbers the rows 1..n without sorting them in one task.

    Each partition numbers its own rows and the partitions' offsets are added by
    a join with one row per partition. The placed rows are stored in the shared
    folder first: a shuffle that is run again could place them differently. With
    ``order`` the number is the row's rank by these columns; rows that are alike
    in them may be placed in several ranges, so that many of a kind do not have
    to be sorted by one task.
    """
    placed = df
    if order:
        tie = F.xxhash64(F.spark_partition_id(), *df.columns)
        by = [*order, "_tie"]
        placed = df.withColumn("_tie", tie).repartitionByRange(*by).sortWithinPartitions(*by)
    position = F.monotonically_increasing_id()
    numbered = placed.select(
        *df.columns,
        F.spark_partition_id().alias("_partition"),
        position.bitwiseAND(F.lit((1 << 33) - 1)).alias("_position"),
    )
    pinned = stored(numbered, "numbered")
    sizes = pinned.groupBy("_partition").agg(F.count(F.lit(1)).alias("_size"))
    # one row per partition, so the window without a partitioning stays tiny
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_partition", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (
        pinned.join(F.broadcast(offsets), "_partition")
        .withColumn(name, F.col("_offset") + F.col("_position") + 1)
        .select(name, *df.columns)
    )
