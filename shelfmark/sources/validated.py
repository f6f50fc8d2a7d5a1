"""A table that only takes rows that keep its rules; the others go to a quarantine table with the reasons.

The rules are those of a database table: required values, longest texts, a
primary key, and values that must occur in another table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.operators.key_filter import FILTER_BYTES, found_among, key_filter, mark_members
from shelfmark.operators.sizing import ROWS_PER_SLICE, add_slices, have_keys, hot_keys, slice_of
from shelfmark.sources.commits import CommitLog
from shelfmark.sources.counted import write_counted
from shelfmark.sources.storage import stored

# a filter over new keys pays where the known ones are so many times the new rows
KNOWN_PER_NEW = 4

REASONS = T.StructField("reasons", T.ArrayType(T.StringType()))


@dataclass(frozen=True)
class Rules:
    """What a row must keep.

    ``key`` columns are present and tell all rows apart; ``required`` are present;
    ``max_lengths`` bound texts, in characters; each column of ``parents`` is null
    or occurs in the table that the function returns, in the column of that name.
    """

    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    max_lengths: dict[str, int] = field(default_factory=dict)
    parents: dict[str, Callable[[], DataFrame]] = field(default_factory=dict)


def check_rows(
    rows: DataFrame,
    rules: Rules,
    known: DataFrame | None = None,
    order: list[str] | None = None,
    max_bytes: int = FILTER_BYTES,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """The rows with ``reasons``, an array that is empty for a good row.

    The reasons are, in this order: ``missing c``, ``too long c``, ``no parent c``
    and, for rows without any of these, ``key exists`` if the key is in ``known``
    and the row is the first of its key, and ``repeated key`` if it is not. First
    is the smallest by ``order`` (all columns by default); of rows that are alike
    one is first.

    The rows are stored once. Parents are compared as distinct keys and the rows
    marked where they lie (see ``mark_members``), so rows with a fault are never
    moved by key. The others meet once, by their key. A key of more than
    ``rows_per_slice`` rows is cut into slices, and only the first rows of its
    slices meet, so neither a key nor a parent that holds a third of all rows
    meets in one task.
    """
    faulty, sound = _judged(rows, rules, known, order, max_bytes, rows_per_slice)
    return faulty.unionByName(_listed(sound))


def _judged(
    rows: DataFrame,
    rules: Rules,
    known: DataFrame | None,
    order: list[str] | None = None,
    max_bytes: int = FILTER_BYTES,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> tuple[DataFrame, DataFrame]:
    """The rows with reasons of their own, and the others with what is wrong about their key as ``_about``."""
    columns, key = rows.columns, list(rules.key)
    required = [*key, *(c for c in rules.required if c not in key)]
    faults = [(F.col(c).isNull(), f"missing {c}") for c in required]
    faults += [(F.coalesce(F.length(c) > limit, F.lit(False)), f"too long {c}") for c, limit in rules.max_lengths.items()]
    # rows that are alike by an order that is given are told apart by their place
    pinned = stored(rows if order is None else rows.withColumn("_row", F.monotonically_increasing_id()), "checked-rows")
    marked = pinned
    for n, (column, parent) in enumerate(rules.parents.items()):
        values = stored(pinned.select(column).where(F.col(column).isNotNull()).distinct(), "child-keys")
        found = stored(found_among(values, parent(), max_bytes), "found-parents")
        orphans = stored(values.join(found, column, "left_anti"), "orphans")
        marked = mark_members(marked, orphans, found, f"_orphan_{n}", max_bytes)
        faults.append((F.col(f"_orphan_{n}"), f"no parent {column}"))
    none = F.array().cast("array<string>")
    has_fault = reduce(or_, (fault for fault, _ in faults))
    reasons = F.concat(*(F.when(fault, F.array(F.lit(reason))).otherwise(none) for fault, reason in faults))
    faulty = marked.where(has_fault).select(*columns, reasons.alias("reasons"))
    sound = marked.where(~has_fault).select(*pinned.columns)

    by = [c for c in (order or columns) if c not in key] + ([] if order is None else ["_row"])
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*(by or key)))
    hot = hot_keys(pinned, key, rows_per_slice)
    if hot is None:
        firsts, rest = sound.withColumn("_place", place), None
    else:
        in_slice = F.row_number().over(Window.partitionBy(*key, "_slice").orderBy(*(by or key)))
        dealt = add_slices(sound, key, hot).withColumn("_slice", slice_of(*columns)).drop("_slices")
        ranked = stored(dealt.withColumn("_place", in_slice), "ranked-rows")
        firsts, rest = ranked.where(F.col("_place") == 1).withColumn("_place", place), ranked.where(F.col("_place") > 1)
    about_key = F.when(F.col("_place") > 1, F.lit("repeated key"))
    if known is not None:
        old = known.select(*key).where(have_keys(key))
        if known.count() > KNOWN_PER_NEW * pinned.count():
            keep = key_filter(stored(sound.select(*key).distinct(), "wanted-keys"), max_bytes)
            old = old if keep is None else keep.may_hold(old)
        firsts = firsts.join(old.distinct().withColumn("_old", F.lit(True)), key, "left")
        about_key = about_key.when(F.col("_old"), F.lit("key exists"))
    judged = firsts.select(*columns, about_key.alias("_about"))
    if rest is not None:
        judged = judged.unionByName(rest.select(*columns, F.lit("repeated key").alias("_about")))
    return faulty, judged


def _listed(judged: DataFrame) -> DataFrame:
    """``_about`` as ``reasons``. A text is stored for less than an array, so the array is made last."""
    none = F.array().cast("array<string>")
    reasons = F.when(F.col("_about").isNull(), none).otherwise(F.array("_about"))
    return judged.withColumn("reasons", reasons).drop("_about")


class ValidatedTable:
    """A stored table under ``rules``, and its quarantine.

    Every load is a folder of good rows and one of bad rows; both count once the
    load's note stands in the commit log. One writer at a time may load.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, rules: Rules):
        self.spark, self.path, self.schema, self.rules = spark, path, schema, rules
        self.log = CommitLog(spark, f"{path}/_commits")

    def _loads(self, kind: str, schema: T.StructType) -> DataFrame:
        whole = T.StructType([*schema.fields, T.StructField("load", T.IntegerType())])
        last = (self.log.latest() or {"commit": 0})["commit"]
        if not last:
            return self.spark.createDataFrame([], whole)
        paths = [f"{self.path}/{kind}/load={n}" for n in range(1, last + 1)]
        return self.spark.read.schema(whole).option("basePath", f"{self.path}/{kind}").parquet(*paths)

    def read(self) -> DataFrame:
        """The good rows of all loads, with the number of their load."""
        return self._loads("rows", self.schema)

    def quarantine(self) -> DataFrame:
        """The rows that were turned away, with their reasons and the number of their load."""
        return self._loads("quarantine", T.StructType([*self.schema.fields, REASONS]))

    def load(self, rows: DataFrame, name: str | None = None) -> dict:
        """Checks and stores ``rows``; returns the load's note with the counts ``rows`` and ``rejected``.

        A load that is run again under the ``name`` of the last one is passed over.
        The keys stored so far are read by column; where they are many times the new
        rows, only those are moved that pass a filter over the new keys.
        """
        last = self.log.latest()
        if last is not None and name is not None and last["name"] == name:
            return last
        number = (last["commit"] if last else 0) + 1
        typed = rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema))
        faulty, sound = _judged(typed, self.rules, self.read() if last else None)
        sound = stored(sound, "judged-rows")
        good = write_counted(sound.where(F.col("_about").isNull()).drop("_about"), f"{self.path}/rows/load={number}")
        refused = faulty.unionByName(_listed(sound.where(F.col("_about").isNotNull())))
        bad = write_counted(refused, f"{self.path}/quarantine/load={number}")
        return self.log.append(last, {"name": name, "rows": good, "rejected": bad})
