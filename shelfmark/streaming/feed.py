"""The review feed: files in, enriched reviews out, each batch exactly once.

The feed is a folder of JSON files. Spark's checkpoint remembers which files
were handed out, so a restarted query goes on after the last finished batch. A
batch is stored under its own number and counts once its note stands in the
table's commit log; a batch that is run again replaces itself or, if its note
stands already, is passed over. No review is lost or stored twice.

The note holds the batch's row count, taken while it was written, and the last
review number given out, so the cost of a batch does not grow with the table.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfmark.operators.keys import add_surrogate_key
from shelfmark.sources import folders
from shelfmark.sources.commits import CommitLog
from shelfmark.sources.counted import write_counted

# Reviews per fetched file and the time between two fetches.
FETCH_SIZE = 100_000
FETCH_INTERVAL = "2 minutes"

PLACES = T.StructType([T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])
NOTE = "kind string, run string, batch_id long, folder string, rows_loaded long, rows_so_far long, through long"
ROWS_PER_FILE = 1_000_000


def write_feed(reviews: DataFrame, path: str, fetch_size: int = FETCH_SIZE) -> None:
    """Stores reviews as feed files of at most ``fetch_size`` records each."""
    reviews.write.option("maxRecordsPerFile", fetch_size).json(path)


def read_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_batch: int,
    archive: str | None = None,
) -> DataFrame:
    """The feed as a stream; with ``archive``, loaded files are moved there.

    One file per batch is the pace of a single fetch; a long backlog is loaded
    faster with as many as keep all cores busy. The number is the caller's, so
    that the batches do not depend on the cluster.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(path)


def commit_log(spark: SparkSession, target: str) -> CommitLog:
    return CommitLog(spark, f"{target}/_commits")


def load_feed(
    feed: DataFrame,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    interval: str | None = None,
    number: str | None = None,
    after_batch: Callable[[SparkSession], None] = lambda spark: None,
) -> StreamingQuery:
    """Starts loading the feed into ``target``, one folder per run and batch.

    A run is what one checkpoint remembers, so neither a second feed with a
    checkpoint of its own nor a new checkpoint overwrites what is there. Only one
    feed may load a target at a time. With ``number``, stored rows get a column of
    that name that goes on from the last number given out. ``after_batch`` is
    called once a batch counts; what follows the table can take in the new rows
    there. Without ``interval`` the query takes everything that is there, in
    batches, and stops; with it, it keeps looking for new files.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        run = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        log = commit_log(session, target)
        last = log.latest()
        state = _state(last)
        # a note that stands without its checkpoint: the batch is stored, but Spark does not know it yet
        if batch_id > state["batches"].get(run, -1):
            rows = transform(batch)
            if number is not None:
                rows = add_surrogate_key(rows, number).withColumn(number, F.col(number) + state["last_number"])
            folder = f"run={run}/batch_id={batch_id}"
            loaded = write_counted(rows, f"{target}/{folder}")
            log.append(last, _after_batch(state, run, batch_id, folder, loaded, number is not None))
        after_batch(session)

    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return feed.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _state(last: dict[str, Any] | None) -> dict[str, Any]:
    """What the next batch must know of those before: numbers given out, batches and rows per run, what compaction replaced."""
    last = last or {}
    return {
        "last_number": last.get("last_number", 0),
        "batches": last.get("batches", {}),
        "rows_of_run": last.get("rows_of_run", {}),
        "compacted": last.get("compacted"),
        "through": last.get("through", 0),
    }


def _after_batch(state: dict[str, Any], run: str, batch_id: int, folder: str, loaded: int, numbered: bool) -> dict[str, Any]:
    so_far = state["rows_of_run"].get(run, 0) + loaded
    return {
        **state,
        "kind": "batch",
        "run": run,
        "batch_id": batch_id,
        "folder": folder,
        "rows_loaded": loaded,
        "rows_so_far": so_far,
        "last_number": state["last_number"] + (loaded if numbered else 0),
        "batches": {**state["batches"], run: batch_id},
        "rows_of_run": {**state["rows_of_run"], run: so_far},
    }


def follow_feed(
    feed: DataFrame,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    interval: str = FETCH_INTERVAL,
    number: str | None = None,
) -> StreamingQuery:
    """Keeps loading new files at the pace of the fetches until it is stopped."""
    return load_feed(feed, target, checkpoint, transform, interval, number)


def load_to_end(
    feed: DataFrame,
    target: str,
    checkpoint: str,
    transform=lambda batch: batch,
    number: str | None = None,
    after_batch: Callable[[SparkSession], None] = lambda spark: None,
) -> None:
    """Loads what the feed holds now and returns; raises if a batch failed."""
    load_feed(feed, target, checkpoint, transform, number=number, after_batch=after_batch).awaitTermination()


def new_batches(spark: SparkSession, target: str, schema: T.StructType, after: int) -> tuple[DataFrame, int] | None:
    """The rows of the batches whose notes stand behind commit ``after``, and the last commit; None if there are none.

    Only the folders of those batches are read. They must not have been removed.
    """
    log = commit_log(spark, target)
    last = log.latest()
    if last is None or last["commit"] <= after:
        return None
    notes = log.notes(NOTE).where((F.col("kind") == "batch") & (F.col("commit") > after) & (F.col("commit") <= last["commit"]))
    return _batches(spark, target, schema, [r.folder for r in notes.select("folder").collect()]), last["commit"]


def _batches(spark: SparkSession, target: str, schema: T.StructType, found: list[str]) -> DataFrame:
    whole = T.StructType([*schema.fields, *PLACES.fields])
    if not found:
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).option("basePath", target).parquet(*(f"{target}/{folder}" for folder in found))


def loaded_table(spark: SparkSession, target: str, schema: T.StructType, through: int | None = None) -> DataFrame:
    """Everything loaded so far, with the ``run`` and ``batch_id`` of each row; an empty feed has loaded no rows.

    The rows are those whose notes stand when it is called, or stood at commit
    ``through``: neither a batch that is being written nor a compaction changes
    what the frame reads.
    """
    log = commit_log(spark, target)
    last = log.latest() if through is None else log.note(through)
    state = _state(last)
    found = []
    if last is not None:
        notes = log.notes(NOTE).where((F.col("kind") == "batch") & (F.col("commit") > state["through"]) & (F.col("commit") <= last["commit"]))
        found = [r.folder for r in notes.select("folder").collect()]
    batches = _batches(spark, target, schema, found)
    if state["compacted"] is None:
        return batches
    merged = spark.read.schema(batches.schema).parquet(f"{target}/{state['compacted']}")
    return merged.unionByName(batches) if found else merged


def load_progress(loaded: DataFrame) -> DataFrame:
    """Rows per run and batch, and of the run up to that batch, counted in any table that has both columns."""
    per_batch = loaded.groupBy("run", "batch_id").agg(F.count(F.lit(1)).alias("rows_loaded"))
    so_far = Window.partitionBy("run").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_batch.withColumn("rows_so_far", F.sum("rows_loaded").over(so_far))


def committed_progress(spark: SparkSession, target: str) -> DataFrame:
    """The same from the notes of the batches: the table itself is not read. Batches without rows are listed too."""
    columns = ("run", "batch_id", "rows_loaded", "rows_so_far")
    notes = commit_log(spark, target).notes(NOTE)
    if notes is None:
        return spark.createDataFrame([], "run string, batch_id long, rows_loaded long, rows_so_far long")
    return notes.where(F.col("kind") == "batch").select(*columns)


def compact(spark: SparkSession, target: str, schema: T.StructType, rows_per_file: int = ROWS_PER_FILE) -> bool:
    """Merges all batches loaded so far into files of about ``rows_per_file`` rows; False if there is none to merge.

    The merged files are written beside the batches and count, in place of them,
    once their note stands. Frames opened before go on reading the batches'
    folders until ``remove_replaced`` takes them away.
    """
    log = commit_log(spark, target)
    last = log.latest()
    if last is None or last["commit"] == last.get("through"):
        return False
    state = _state(last)
    rows = loaded_table(spark, target, schema)
    files = max(1, -(-sum(state["rows_of_run"].values()) // rows_per_file))
    folder = f"_compacted/commit-{last['commit'] + 1}"
    # dealt out by content and place, as a batch of one kind of row must not make one long file
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id()), F.lit(files))
    rows.repartition(files, spread).write.mode("overwrite").parquet(f"{target}/{folder}")
    log.append(last, {**state, "kind": "compaction", "compacted": folder, "through": last["commit"] + 1})
    return True


def remove_replaced(spark: SparkSession, target: str) -> int:
    """Deletes the folders that compactions have replaced, once nobody reads them; the number of folders deleted."""
    log = commit_log(spark, target)
    last = log.latest()
    state = _state(last)
    if state["compacted"] is None:
        return 0
    notes = log.notes(NOTE).where((F.col("kind") == "batch") & (F.col("commit") <= state["through"]))
    old = [f"{target}/{r.folder}" for r in notes.select("folder").collect()]
    old += [path for path, _ in folders.matching(spark, f"{target}/_compacted/*") if not path.endswith(f"/{state['compacted']}")]
    old = [path for path in old if folders.exists(spark, path)]
    for path in old:
        folders.remove(spark, path)
    return len(old)
