"""A table with a key that can be loaded again: rows are merged by key, file group by file group.

The rows lie in a fixed number of hash buckets. A load rewrites the buckets its
keys fall into and leaves the files of all others as they are. The new version
counts once its note stands in the commit log, so a reader sees the table
before or after a load, never between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.operators.aggregates import first_per_key
from shelfmark.sources import folders
from shelfmark.sources.commits import CommitLog
from shelfmark.sources.storage import stored

BUCKETS = 64


class KeyedTable:
    """A stored table of ``schema`` with at most one row per ``key``.

    ``buckets`` is fixed with the first load; choose it such that a bucket is some
    hundred megabytes. A version's note names, for each bucket, the load that
    wrote it, so its size depends on the buckets alone.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.key = spark, path, schema, key
        self.log = CommitLog(spark, f"{path}/_commits")
        self.buckets = (self.log.latest() or {"buckets": buckets})["buckets"]

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def version(self) -> int:
        """The number of loads so far; a frame of ``read`` keeps the version it was made of."""
        return (self.log.latest() or {"commit": 0})["commit"]

    def _files(self, places: dict[str, int], wanted: list[int] | None = None) -> DataFrame:
        """The rows, with their bucket, of all buckets or of those ``wanted``."""
        schema = T.StructType([*self.schema.fields, T.StructField("_bucket", T.IntegerType())])
        found = [(int(b), load) for b, load in places.items() if wanted is None or int(b) in wanted]
        if not found:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/load={load}/_bucket={bucket}" for bucket, load in sorted(found)]
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths).select(*schema.names)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the last one if none is named; none before the first load."""
        note = self.log.latest() if version is None else self.log.note(version)
        return self._files(note["places"] if note else {}).drop("_bucket")

    def read_keys(self, keys: DataFrame) -> DataFrame:
        """The rows whose key is in ``keys``, read from the buckets that may hold one."""
        note = self.log.latest()
        wanted = self._touched(keys.withColumn("_bucket", self.bucket_of(F.col(self.key))))
        return self._files(note["places"] if note else {}, wanted).drop("_bucket").join(keys.select(self.key).distinct(), self.key, "left_semi")

    def _touched(self, rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select("_bucket").distinct().collect())

    def merge(self, rows: DataFrame, order: list[str]) -> int:
        """Loads ``rows``: a new key is added, a row of a known key replaces the old one. Returns the new version.

        Of several new rows with one key the smallest by ``order`` counts. Rows
        without a key are an error, as in a table with a primary key. Only rows of
        the touched buckets are read and moved, and the rows of a key are combined
        before they are: old and new rows meet in a minimum, not in a join.
        """
        last = self.log.latest()
        typed = rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema))
        new = stored(first_per_key(typed, self.key, order).withColumn("_bucket", self.bucket_of(F.col(self.key))), "new-rows")
        if not new.where(F.col(self.key).isNull()).isEmpty():
            raise ValueError(f"rows without {self.key} cannot be loaded")
        touched = self._touched(new)
        if not touched:
            return self.version()
        places = last["places"] if last else {}
        both = self._files(places, touched).withColumn("_age", F.lit(1)).unionByName(new.withColumn("_age", F.lit(0)))
        kept = [c for c in self.schema.names if c != self.key]
        newest = both.groupBy("_bucket", self.key).agg(F.min(F.struct("_age", *kept)).alias("_row"))
        merged = newest.select("_bucket", *(F.col(c) if c == self.key else F.col(f"_row.{c}").alias(c) for c in self.schema.names))
        load = (last["commit"] if last else 0) + 1
        # sorted by key, so that a look-up by key skips most of a bucket's row groups
        dealt = merged.repartition("_bucket").sortWithinPartitions("_bucket", self.key)
        dealt.write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/load={load}")
        now = {**places, **{str(b): load for b in touched}}
        return self.log.append(last, {"buckets": self.buckets, "places": now, "touched": touched})["commit"]

    def remove_replaced(self) -> int:
        """Deletes the files that the last version does not use; frames of older versions can then no longer be read."""
        note = self.log.latest()
        if note is None:
            return 0
        live = {f"load={load}/_bucket={bucket}" for bucket, load in note["places"].items()}
        found = [path for path, _ in folders.matching(self.spark, f"{self.path}/load=*/_bucket=*")]
        old = [path for path in found if "/".join(path.rsplit("/", 2)[1:]) not in live]
        for path in old:
            folders.remove(self.spark, path)
        return len(old)
