"""Derived tables: SQL text, rebuild, typed load, append and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.operators.keys import add_surrogate_key


def run_sql(spark: SparkSession, text: str, **parameters) -> DataFrame:
    """SQL text with named parameters (``:name``), bound rather than pasted in.

    DataFrames are given as ``{name}`` parameters, values as ``:name`` ones.
    """
    frames = {k: v for k, v in parameters.items() if isinstance(v, DataFrame)}
    values = {k: v for k, v in parameters.items() if k not in frames}
    return spark.sql(text, args=values or None, **frames)


def rebuild_table(df: DataFrame, path: str) -> DataFrame:
    """Drops and rebuilds a derived table; returns the stored one."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def rebuild_named_table(df: DataFrame, table: str) -> DataFrame:
    """The same for a table of the session's catalog."""
    df.write.mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def load_typed(df: DataFrame, path: str, schema: T.StructType) -> DataFrame:
    """Casts to the declared columns and loads them into a fresh table."""
    typed = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))
    typed.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def append_to_table(df: DataFrame, path: str) -> DataFrame:
    """Appends the rows to a stored table; returns the whole table."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def page(df: DataFrame, key: str | list[str], offset: int, size: int) -> DataFrame:
    """``size`` rows after the first ``offset`` ones, in the order of ``key``.

    A page needs an order that tells all rows apart, or rows may repeat or be
    missed between pages. The rows are ranked in ranges, not by one task, and the
    ranked table is written; reading on through a large table is better done
    with ``page_after``, which ranks no more than a page.
    """
    order = [key] if isinstance(key, str) else key
    ranked = add_surrogate_key(df, "_place", order)
    return ranked.where((F.col("_place") > offset) & (F.col("_place") <= offset + size)).orderBy("_place").drop("_place")


def page_after(df: DataFrame, key: str, last, size: int) -> DataFrame:
    """``size`` rows after the one whose ``key`` is ``last`` (None for the first page).

    The key filter reaches the scan, and only ``size`` rows are ranked however
    far into the table the page lies.
    """
    rest = df if last is None else df.where(F.col(key) > F.lit(last))
    return rest.orderBy(key).limit(size)


def preview(df: DataFrame, key: str | list[str], rows: int = 20) -> DataFrame:
    return df.orderBy(key).limit(rows)
