"""Yearly marts that follow a loaded table batch by batch.

A mart holds sums and counts per key and year, which can be added up. Each step
reads the batches that were loaded since the last one, and nothing older, and
adds their partial sums as a small table; now and then these are folded into
one. Averages are worked out when the mart is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.sources import folders
from shelfmark.sources.commits import CommitLog
from shelfmark.streaming import feed

FOLDED_AFTER = 16


@dataclass(frozen=True)
class LiveMart:
    """Averages of ``measures`` (source column to name) per ``entity`` and year.

    ``target`` is the table the feed loads, ``schema`` its columns, ``path`` the
    mart's own folder. ``folded_after`` partial tables are added up to one.
    """

    path: str
    target: str
    schema: T.StructType
    entity: str
    measures: dict[str, str]
    folded_after: int = FOLDED_AFTER

    def _log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(spark, f"{self.path}/_commits")

    def partial(self, reviews: DataFrame) -> DataFrame:
        """Sums and counts of some reviews; a key whose values are all missing has a count of 0."""
        sums = [F.sum(source).alias(f"{name}_sum") for source, name in self.measures.items()]
        counts = [F.count(source).alias(f"{name}_count") for source, name in self.measures.items()]
        by = [F.col(self.entity), F.year("review_date").alias("year")]
        return reviews.groupBy(*by).agg(*sums, *counts)

    def _added(self, partials: DataFrame) -> DataFrame:
        names = [f"{name}_{part}" for part in ("sum", "count") for name in self.measures.values()]
        return partials.groupBy(self.entity, "year").agg(*(F.sum(n).alias(n) for n in names))

    def _stored(self, spark: SparkSession, note: dict) -> DataFrame:
        return spark.read.parquet(*(f"{self.path}/{folder}" for folder in note["folders"]))

    def follow(self, spark: SparkSession) -> int:
        """Takes in the batches loaded since the last call; returns the last commit of the target that is in the mart.

        It may be called after each batch, or less often, or again after a failure:
        which batches are in stands in the same note that makes them count, so each
        is taken in once.
        """
        log = self._log(spark)
        last = log.latest()
        through = last["through"] if last else 0
        found = feed.new_batches(spark, self.target, self.schema, through)
        if found is None:
            return through
        batch, through = found
        number = (last["commit"] if last else 0) + 1
        kept = last["folders"] if last else []
        folder = f"partial-{number}"
        self.partial(batch).write.mode("overwrite").parquet(f"{self.path}/{folder}")
        kept = [*kept, folder]
        if len(kept) > self.folded_after:
            folded = f"folded-{number}"
            self._added(self._stored(spark, {"folders": kept})).write.mode("overwrite").parquet(f"{self.path}/{folded}")
            kept = [folded]
        log.append(last, {"through": through, "folders": kept})
        return through

    def sums(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The sums and counts so far, or as they stood after the given number of steps."""
        log = self._log(spark)
        note = log.latest() if version is None else log.note(version)
        if note is not None:
            return self._added(self._stored(spark, note))
        rows = spark.createDataFrame([], T.StructType([f for f in self.schema if f.name in (self.entity, "review_date", *self.measures)]))
        return self.partial(rows)

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """(entity, year, averages) as ``yearly_averages`` gives them over all reviews loaded so far.

        The frame reads the partial tables of its time, which stay until ``remove_replaced``.
        """
        averages = [(F.col(f"{n}_sum") / F.when(F.col(f"{n}_count") > 0, F.col(f"{n}_count"))).alias(n) for n in self.measures.values()]
        return self.sums(spark, version).select(self.entity, "year", *averages)

    def rebuild(self, spark: SparkSession) -> None:
        """Works the mart out anew from all that is loaded, for a changed definition or after batches were removed unread."""
        log = self._log(spark)
        last = log.latest()
        # what is loaded between these two lines is taken in twice by none: it stands behind ``through``
        loaded = feed.commit_log(spark, self.target).latest()
        if loaded is None:
            return
        folder = f"folded-{(last['commit'] if last else 0) + 1}"
        rows = feed.loaded_table(spark, self.target, self.schema, through=loaded["commit"])
        self.partial(rows).write.mode("overwrite").parquet(f"{self.path}/{folder}")
        log.append(last, {"through": loaded["commit"], "folders": [folder]})

    def remove_replaced(self, spark: SparkSession) -> int:
        """Deletes the partial tables that were folded; the number deleted."""
        note = self._log(spark).latest()
        live = set(note["folders"]) if note else set()
        found = [p for kind in ("partial", "folded") for p, _ in folders.matching(spark, f"{self.path}/{kind}-*")]
        old = [p for p in found if p.rsplit("/", 1)[1] not in live]
        for path in old:
            folders.remove(spark, path)
        return len(old)
