"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.sources.storage import fresh_path

MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
SLICE_BYTES = 400_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back.

    The rows, and any numbers drawn for them, are then fixed: a lost executor
    makes Spark read them again, not work them out anew.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_SETTING, SPARK_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"


def small_batches(df: DataFrame) -> DataFrame:
    """Lets Spark hand at most 8 MB of texts to Python at a time, where the session has not chosen a size itself.

    Spark's own bound of 64 MB, held several times on its way, is much beside a small executor's heap.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, SPARK_DEFAULT) == SPARK_DEFAULT:
        conf.set(BATCH_SETTING, BATCH_BYTES)
    return df


def crc_remainder(column: str, divisor: int) -> Column:
    """crc32 of the value's text, modulo ``divisor``; a null counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column of about ``most`` bytes each; one long text is a range of its own."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0)).astype(np.int64)
    if not len(sizes):
        return
    group = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(sizes)]
    yield from zip(cuts, cuts[1:])


def utf8_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each text begins (one place more at the end)."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    column = pa.concat_arrays([column])
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets else np.zeros(1, np.int64)
    values = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return values[places[0] : places[-1]], places - places[0]
