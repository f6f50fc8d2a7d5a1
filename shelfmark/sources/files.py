"""File readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON record per line; malformed lines are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_json_arrays(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Batch files with a JSON array per line; each element becomes a row."""
    return spark.read.schema(schema).json(path)


def read_envelopes(spark: SparkSession, path: str, schema: T.StructType, rows: str) -> DataFrame:
    """One JSON envelope per line; the records of its array ``rows`` become rows."""
    return spark.read.schema(schema).json(path).select(F.inline(rows))


def parse_json(text: Column, schema: T.StructType) -> Column:
    """A JSON record in a text column; NULL fields where it cannot be read."""
    return F.from_json(text, schema)
