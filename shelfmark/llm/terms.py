"""Sums over the terms of texts, with a table of one number per distinct term.

The most frequent terms are held in a dictionary of bounded size, so that no
term that is left for the shuffle can be hot. The other terms are joined with
the table, and only their sums return to the rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import small_batches

MOST_FREQUENT = 200_000
LONGEST = 64
FLUSH_AT = 200_000
RARE_TYPE = pa.list_(pa.struct([("term", pa.binary()), ("n", pa.int32())]))


def count_terms(texts: DataFrame, terms_of: Callable[[], Callable[[str], Iterable[bytes]]]) -> DataFrame:
    """(term binary, n long): how often each term occurs in the column ``text`` of all rows.

    ``terms_of()`` makes a worker's splitter. A task adds up its terms before the
    shuffle and hands them on whenever 200,000 distinct ones have gathered.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = terms_of(), Counter()
        for batch in batches:
            for text in batch.column(0):
                if text.is_valid:
                    seen.update(split(text.as_py()))
                    if len(seen) > FLUSH_AT:
                        yield from _flush(seen)
                        seen.clear()
        yield from _flush(seen)

    partial = small_batches(texts).select("text").mapInArrow(count, "term binary, n long")
    return partial.groupBy("term").agg(F.sum("n").alias("n"))


def _flush(seen: Counter[bytes]) -> Iterator[pa.RecordBatch]:
    if seen:
        columns = [pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["term", "n"])


def frequent_floor(counts: DataFrame, most: int = MOST_FREQUENT) -> int:
    """The least count such that at most ``most`` terms reach it.

    From a histogram with four steps per doubling, so at most 256 rows are collected.
    """
    step = F.floor(F.log2(F.col("n")) * 4).cast("int").alias("step")
    rows = counts.groupBy(step).agg(F.count(F.lit(1)).alias("terms"), F.min("n").alias("least")).collect()
    floor, held = None, 0
    for row in sorted(rows, key=lambda r: -r.step):
        held += row.terms
        if held > most:
            break
        floor = row.least
    return (1 << 62) if floor is None else floor


def frequent_terms(table: DataFrame, floor: int, value: str) -> dict[bytes, object]:
    """The values of the frequent terms of up to 64 bytes; bounded by ``frequent_floor``."""
    rows = table.where((F.col("n") >= floor) & (F.octet_length("term") <= LONGEST)).select("term", value).toArrow()
    return dict(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()))


def sum_rare(rows: DataFrame, table: DataFrame, value: str) -> DataFrame:
    """(row, total, found): per row the sum of n times ``value`` over its rare terms, and of n alone.

    ``rows`` has row and rare (array of term, n). A term that ``table`` lacks adds nothing.
    """
    rare = rows.select("row", F.explode("rare").alias("_t")).select("row", "_t.term", "_t.n")
    joined = rare.join(table.select("term", F.col(value).alias("_value")), "term")
    return joined.groupBy("row").agg(F.sum(F.col("n") * F.col("_value")).alias("total"), F.sum("n").alias("found"))
