"""Size checks and hot-key handling shared by the joins.

One key may hold a third of all rows. Sums and counts need no care, because
Spark combines them before the shuffle. Joins do: they spread a hot key over
several slices, chosen here.

Which keys are hot is only a matter of speed. It may therefore be estimated from
a sample; every row takes part in the result whatever the sample says.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.sources.storage import stored

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
ROWS_PER_SLICE = 1_000_000
SAMPLED_PER_HOT_KEY = 1_000


def _width(field: T.StructField) -> Column:
    """The bytes of a value, nested ones by the length of their JSON text."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        value = F.to_json(F.struct(value))
    elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.lit(16)
    return F.coalesce(F.octet_length(value), F.lit(0)) + 8


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measures ``df`` with one aggregate; True when it may be broadcast."""
    width = reduce(lambda a, b: a + b, (_width(field) for field in df.schema), F.lit(0))
    measured = df.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("size")
    ).first()
    return measured.n <= max_rows and measured["size"] <= max_bytes


def have_keys(keys: list[str]) -> Column:
    """Whether a row has all its keys; without one it matches nothing."""
    return reduce(and_, (F.col(k).isNotNull() for k in keys))


def hot_keys(df: DataFrame, keys: list[str], rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame | None:
    """The keys with more than ``rows_per_slice`` rows and the slices each needs, or None.

    The bound is the same for a table of any size, and so is the number of keys
    that may be hot. A key of that size is seen about 1,000 times in the sample
    that is counted, enough to tell it and to size it. The keys found are written
    to the shared folder, so that both sides of a join slice alike.
    """
    fraction = min(1.0, SAMPLED_PER_HOT_KEY / rows_per_slice)
    only_keys = df.select(*keys).where(have_keys(keys))
    seen = only_keys if fraction == 1.0 else only_keys.sample(fraction, seed=1)
    limit = rows_per_slice * fraction
    counts = seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    hot = stored(counts.select(*keys, F.ceil(F.col("_n") / limit).cast("int").alias("_slices")), "hot-keys")
    return None if hot.isEmpty() else hot


def add_slices(df: DataFrame, keys: list[str], hot: DataFrame | None) -> DataFrame:
    """Adds ``_slices``: how many slices the row's key is cut into (1 if not hot)."""
    if hot is None:
        return df.withColumn("_slices", F.lit(1))
    names = {k: f"_hot_{k}" for k in keys}
    renamed = hot.withColumnsRenamed(names)
    renamed = F.broadcast(renamed) if fits_broadcast(hot) else renamed
    same = reduce(and_, (F.col(k) == F.col(names[k]) for k in keys))
    return (
        df.join(renamed, same, "left")
        .drop(*names.values())
        .withColumn("_slices", F.coalesce("_slices", F.lit(1)))
    )


def slice_of(*columns: str) -> Column:
    """The slice of a row, the same each time its task is run.

    The partition number takes part so that copies of one row, which hash alike,
    do not all meet in one slice.
    """
    return F.pmod(F.xxhash64(F.spark_partition_id(), *columns), F.col("_slices")).cast("int")


def any_slice(*columns: str) -> Column:
    """A slice for a row without a key, which may go anywhere: as many as there are rows."""
    return F.pmod(F.xxhash64(F.spark_partition_id(), *columns), F.lit(2**31 - 1)).cast("int")
