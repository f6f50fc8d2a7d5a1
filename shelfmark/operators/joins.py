"""Equi-joins of a large side with a look-up side."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.sizing import (
    ROWS_PER_SLICE,
    add_slices,
    any_slice,
    fits_broadcast,
    have_keys,
    hot_keys,
    slice_of,
)
from shelfmark.sources.storage import stored


def sliced_join(
    large: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str = "inner",
    rows_per_slice: int = ROWS_PER_SLICE,
    sizes_from: DataFrame | None = None,
) -> DataFrame:
    """Shuffle join in which a hot key of ``large`` is spread over many tasks.

    The rows of a hot key go to numbered slices and the matching rows of
    ``small`` are repeated once per slice, so each row still meets every match
    exactly once. Rows without a key match nothing: an inner or semi join drops
    them before the shuffle, any other spreads them one by one. ``how`` is inner,
    left, left_semi or left_anti.

    The keys are sized from ``sizes_from`` where it is given. A table from which
    ``large`` was filtered by other columns spares reading those twice.
    """
    hot = hot_keys(large if sizes_from is None else sizes_from, keys, rows_per_slice)
    small = small.where(have_keys(keys))
    if how in ("inner", "left_semi"):
        large = large.where(have_keys(keys))
        if hot is None:
            return large.join(small, keys, how)
    own = F.when(have_keys(keys), slice_of(*large.columns)).otherwise(any_slice(*large.columns))
    rows = add_slices(large, keys, hot).withColumn("_slice", own).drop("_slices")
    matches = (
        add_slices(small, keys, hot)
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
        .drop("_slices")
    )
    return rows.join(matches, [*keys, "_slice"], how).drop("_slice")


def lookup_join(
    large: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", sizes_from: DataFrame | None = None
) -> DataFrame:
    """Joins a look-up table, broadcast when measured small enough, else by ``sliced_join``.

    The look-up side is worked out once: it is written to the shared folder,
    measured there and joined from there.
    """
    small = stored(small, "lookup")
    if fits_broadcast(small):
        return large.join(F.broadcast(small), keys, how)
    return sliced_join(large, small, keys, how, sizes_from=sizes_from)


def restrict_to_keys(catalog: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Catalog rows whose key occurs in the batch; nothing goes through the driver.

    The batch's keys are written once, and broadcast when measured small enough.
    """
    wanted = stored(batch.select(key).where(F.col(key).isNotNull()).distinct(), "batch-keys")
    return catalog.join(F.broadcast(wanted) if fits_broadcast(wanted) else wanted, key, "left_semi")


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which a missing key matches a missing key; keys kept once.

    Meant for grouped tables, which hold each key once on either side.
    """
    names = {k: f"_right_{k}" for k in keys}
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(names[k])) for k in keys))
    return left.join(right.withColumnsRenamed(names), same, "inner").drop(*names.values())
