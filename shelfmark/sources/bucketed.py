"""Tables laid out for a join: bucketed by its key, so that the join moves no row.

Both sides lie in the same number of buckets of the key's hash. A key with more
than a million rows is written by many tasks, and at the join its rows meet the
few matching ones by broadcast, so that its bucket does not become one task.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.sizing import ROWS_PER_SLICE, fits_broadcast, hot_keys
from shelfmark.sources.storage import fresh_path

BUCKETS = 200


@dataclass(frozen=True)
class BucketedTable:
    """A table of the session's catalog, its key, and the keys that have too many rows for one task (or None)."""

    name: str
    key: str
    buckets: int
    hot: DataFrame | None

    def rows(self, spark) -> DataFrame:
        return spark.table(self.name)


def lay_out(df: DataFrame, key: str, buckets: int = BUCKETS, rows_per_slice: int = ROWS_PER_SLICE, name: str | None = None) -> BucketedTable:
    """Writes ``df`` to the shared folder, one sorted file per bucket; rows without the key are left out, as no join finds them.

    Choose ``buckets`` once for all tables that are joined by the key, such that a
    bucket of the largest is some hundred megabytes. Rows of a hot key stay in the
    tasks they come from, each of which adds a file to the key's bucket.
    """
    name = name or f"bucketed_{uuid.uuid4().hex}"
    rows = df.where(F.col(key).isNotNull())
    hot = hot_keys(rows, [key], rows_per_slice)
    if hot is None:
        dealt = rows.repartition(buckets, key)
    else:
        cold, many = _split(rows, key, hot)
        dealt = cold.repartition(buckets, key).unionByName(many)
    path = fresh_path(df.sparkSession, name)
    dealt.write.option("path", path).bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(name)
    return BucketedTable(name, key, buckets, hot)


def _split(rows: DataFrame, key: str, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of the other keys, and those of the hot ones; no row is moved while the hot keys are few."""
    keys = hot.select(key)
    keys = F.broadcast(keys) if fits_broadcast(keys) else keys
    return rows.join(keys, key, "left_anti"), rows.join(keys, key, "left_semi")


def bucketed_join(large: BucketedTable, small: BucketedTable, spark) -> DataFrame:
    """The inner join of two tables by their key; ``small`` holds each key once.

    Rows are not shuffled: a bucket of one side meets the same bucket of the other.
    The rows of hot keys are joined to the broadcast rows of these keys, of which
    there are no more than keys.
    """
    if (large.key, large.buckets) != (small.key, small.buckets):
        raise ValueError("both tables must have the same key and number of buckets")
    key, rows, matches = large.key, large.rows(spark), small.rows(spark)
    if large.hot is None:
        return rows.join(matches.hint("merge"), key)
    cold, many = _split(rows, key, large.hot)
    _, few = _split(matches, key, large.hot)
    met = many.join(F.broadcast(few) if fits_broadcast(few) else few, key)
    return cold.join(matches.hint("merge"), key).unionByName(met)
