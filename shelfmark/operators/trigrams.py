"""Substring search by an index of trigrams.

The index is a table of (gram, value), sorted, one row for every three
characters in a row of every distinct value. A search reads the rows of a few
grams of its pattern, keeps the values that have all of them, and tests these
exactly. The table that holds the values is not read for it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.predicates import contains_ignore_case
from shelfmark.operators.joins import lookup_join
from shelfmark.sources.storage import stored

SIZE = 3
# Stands behind a value's end, so that its last characters begin a gram too.
END = "\uffff"
SLOTS = 64
GRAMS_USED = 4

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("gram", "value")] + [T.StructField("slot", T.IntegerType())])
COUNTS = "gram string, n long"


def grams(text: Column) -> Column:
    """The distinct grams of a text in lower case: one begins at each of its characters."""
    lower = F.lower(text)
    padded = F.concat(lower, F.lit(END * (SIZE - 1)))
    places = F.sequence(F.lit(1), F.length(lower))
    found = F.transform(places, lambda i: F.substring(padded, i, F.lit(SIZE)))
    return F.when(F.length(lower) > 0, F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def slot_of(gram: Column) -> Column:
    """Grams that begin alike lie in one folder, so that a search for a single letter reads one folder as well."""
    return F.pmod(F.xxhash64(F.substring(gram, 1, 1)), F.lit(SLOTS)).cast("int")


@dataclass(frozen=True)
class TrigramIndex:
    path: str

    def build(self, table: DataFrame, column: str) -> None:
        """Indexes the distinct values of a column; nulls and empty texts are not found by any search.

        Ranges are cut by gram and value, so a gram that a third of all values have
        is spread over many files.
        """
        values = stored(table.select(F.col(column).alias("value")).where(F.col(column) != "").distinct(), "index-values")
        pairs = values.select(F.explode(grams(F.col("value"))).alias("gram"), "value")
        by = ["slot", "gram", "value"]
        placed = pairs.withColumn("slot", slot_of(F.col("gram"))).repartitionByRange(*by).sortWithinPartitions(*by)
        placed.write.mode("overwrite").partitionBy("slot").parquet(f"{self.path}/grams")
        counts = self.pairs(table.sparkSession).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        counts.repartitionByRange("gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{self.path}/counts")

    def pairs(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(SCHEMA).parquet(f"{self.path}/grams")

    def _rarest(self, spark: SparkSession, wanted: list[str]) -> list[str] | None:
        """The rarest of a pattern's grams; None if one of them occurs nowhere."""
        counts = spark.read.schema(COUNTS).parquet(f"{self.path}/counts").where(F.col("gram").isin(wanted))
        known = {r.gram: r.n for r in counts.collect()}
        if len(known) < len(wanted):
            return None
        return sorted(wanted, key=lambda g: (known[g], g))[:GRAMS_USED]

    def search(self, spark: SparkSession, query: str) -> DataFrame:
        """(value): the distinct values that contain ``query`` whatever its case.

        ``%``, ``_`` and quotes are plain text; an empty query finds nothing, as in
        ``contains_ignore_case``. A pattern of one or two characters is looked up as
        the beginning of a gram.
        """
        lower = spark.sql("select lower(:query) as q", args={"query": query}).first().q
        if not lower:
            return spark.createDataFrame([], "value string")
        pairs = self.pairs(spark)
        if len(lower) < SIZE:
            slot = slot_of(F.lit(lower))
            found = pairs.where((F.col("slot") == slot) & F.col("gram").startswith(lower)).select("value").distinct()
            return found.where(contains_ignore_case(F.col("value"), query))
        wanted = sorted({lower[i : i + SIZE] for i in range(len(lower) - SIZE + 1)})
        chosen = self._rarest(spark, wanted)
        if chosen is None:
            return spark.createDataFrame([], "value string")
        slots = [r.slot for r in spark.createDataFrame([(g,) for g in chosen], "gram string").select(slot_of(F.col("gram")).alias("slot")).distinct().collect()]
        rows = pairs.where(F.col("slot").isin(slots) & F.col("gram").isin(chosen))
        # each pair stands once in the index, so the number of rows is the number of grams
        candidates = rows.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(chosen))
        return candidates.select("value").where(contains_ignore_case(F.col("value"), query))

    def rows_with(self, table: DataFrame, column: str, query: str) -> DataFrame:
        """The rows of ``table`` whose ``column`` contains ``query``, by a join with the values found."""
        found = self.search(table.sparkSession, query).withColumnRenamed("value", column)
        return lookup_join(table, found, [column], "left_semi").select(*table.columns)
