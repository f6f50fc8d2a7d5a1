"""Database tables over JDBC.

The driver jar and the database are the caller's. Reads and writes run in
parallel only when told how to split, so both take the split explicitly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """Ranges of a numeric, date or timestamp column, one per connection.

    The bounds only shape the ranges; rows outside them are read as well.
    """

    column: str
    lower: str
    upper: str
    connections: int


def read_query(
    spark: SparkSession, url: str, query: str, properties: dict[str, str] | None = None, split: Split | None = None
) -> DataFrame:
    """The rows of a subquery, which the database evaluates.

    Filters and column choices made later on the result are pushed into it.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
    # a split cannot be combined with the `query` option, only with a derived table
    reader = reader.option("dbtable", f"({query}) subquery")
    if split is not None:
        reader = reader.options(
            partitionColumn=split.column,
            lowerBound=split.lower,
            upperBound=split.upper,
            numPartitions=split.connections,
        )
    return reader.load()


def append_rows(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, connections: int = 8
) -> None:
    """Appends the rows over at most ``connections`` connections.

    A plain append is not repeatable: a batch that is written again adds its
    rows again. ``streaming.feed`` writes by batch number instead.
    """
    (
        df.write.format("jdbc")
        .mode("append")
        .option("url", url)
        .option("dbtable", table)
        .option("numPartitions", connections)
        .options(**(properties or {}))
        .save()
    )
