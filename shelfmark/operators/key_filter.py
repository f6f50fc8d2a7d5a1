"""A Bloom filter over keys, built and asked by Spark's own functions.

It tells, row by row and without a shuffle, which rows of a large table cannot
have a key of a small one. What it lets through is compared exactly.

A block's bits are asked as an array of 32-bit words: a row points to its block's
array, where it would copy a binary value.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.joins import sliced_join
from shelfmark.operators.sizing import fits_broadcast, have_keys
from shelfmark.sources.storage import stored

# Spark's bitmaps hold 32,768 bits.
BLOCK_BITS, BLOCK_BYTES = 32_768, 4_096
BITS_PER_KEY, PROBES = 12, 4
FILTER_BYTES = 32 * 1024 * 1024


@dataclass(frozen=True)
class KeyFilter:
    """A table of one bitmap per block; a key's bits all lie in one block."""

    blocks: DataFrame
    count: int
    keys: list[str]

    def may_hold(self, rows: DataFrame) -> DataFrame:
        """The rows whose key may be in the filter: all that are and, of the others, about one in a hundred."""
        asked = self._asked(rows.where(have_keys(self.keys)), "inner")
        return asked.where(_all_set(self.keys)).select(*rows.columns)

    def mark(self, rows: DataFrame, name: str) -> DataFrame:
        """All rows, with whether their key may be in the filter as ``name``; false for a row without a key."""
        may = have_keys(self.keys) & F.coalesce(_all_set(self.keys), F.lit(False))
        return self._asked(rows, "left").select(*rows.columns, may.alias(name))

    def _asked(self, rows: DataFrame, how: str) -> DataFrame:
        return rows.withColumn("_block", _block(self.keys, self.count)).join(F.broadcast(self.blocks), "_block", how)


def _block(keys: list[str], count: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")


def _place(keys: list[str], probe: int) -> Column:
    """The place of one of a key's bits, by a further hash of the key."""
    return F.pmod(F.xxhash64(F.lit(probe + 1), *keys), F.lit(BLOCK_BITS))


def _words(bits: Column) -> Column:
    """A block's bytes, four to a signed word, the first byte highest."""
    def word(i: Column) -> Column:
        value = F.conv(F.hex(F.substring(bits, (i * 4 + 1).cast("int"), F.lit(4))), 16, 10).cast("long")
        return F.when(value < 2**31, value).otherwise(value - 2**32).cast("int")

    return F.transform(F.sequence(F.lit(0), F.lit(BLOCK_BYTES // 4 - 1)), word)


def _all_set(keys: list[str]) -> Column:
    return reduce(and_, (_is_set(F.col("_words"), _place(keys, i)) for i in range(PROBES)))


def _is_set(words: Column, place: Column) -> Column:
    bit = 24 - F.floor(place % 32 / 8) * 8 + place % 8
    return F.getbit(F.get(words, F.floor(place / 32).cast("int")), bit.cast("int")) == 1


def key_filter(keys: DataFrame, max_bytes: int = FILTER_BYTES) -> KeyFilter | None:
    """A filter over the rows of ``keys``, all its columns being the key; None if it were larger than ``max_bytes``.

    The keys are counted first; a table that is read from files is best.
    """
    names = keys.columns
    count = max(1, -(-keys.count() * BITS_PER_KEY // BLOCK_BITS))
    if count * BLOCK_BYTES > max_bytes:
        return None
    places = F.array(*(_place(names, i) for i in range(PROBES)))
    bits = keys.where(have_keys(names)).select(_block(names, count).alias("_block"), F.explode(places).alias("_place"))
    blocks = bits.groupBy("_block").agg(F.bitmap_construct_agg("_place").alias("_bits"))
    return KeyFilter(stored(blocks.select("_block", _words(F.col("_bits")).alias("_words")), "key-filter"), count, names)


def found_keys(keys: DataFrame, table: DataFrame, max_bytes: int = FILTER_BYTES) -> DataFrame:
    """The distinct ``keys`` that occur in ``table``, whose columns of these names are compared.

    The table is not shuffled as long as a filter over the keys is small enough:
    only rows that pass it meet the keys. Beyond that it is joined by shuffle, its
    keys made distinct before.
    """
    wanted = stored(keys.where(have_keys(keys.columns)).distinct(), "wanted-keys")
    return found_among(wanted, table, max_bytes)


def found_among(wanted: DataFrame, table: DataFrame, max_bytes: int = FILTER_BYTES) -> DataFrame:
    """The same for a table in storage that holds each key once and none without a value."""
    names = wanted.columns
    keep = key_filter(wanted, max_bytes)
    narrow = table.select(*names)
    passed = (narrow.where(have_keys(names)) if keep is None else keep.may_hold(narrow)).distinct()
    if keep is not None:
        passed = stored(passed, "passed-keys")
        if fits_broadcast(passed):
            return wanted.join(F.broadcast(passed), names, "left_semi")
    # both sides hold each key once, so no key is hot
    return wanted.join(passed, names, "left_semi")


def mark_members(rows: DataFrame, members: DataFrame, others: DataFrame, name: str, max_bytes: int = FILTER_BYTES) -> DataFrame:
    """``rows`` with whether their key is one of ``members`` as ``name``; false for a row without a key.

    ``members`` and ``others`` are tables in storage that hold each key of the rows
    once, in one of the two. Few members are broadcast. Of more, the rows ask a
    filter and the few ``others`` that it lets through, which makes the answer
    exact; only beyond ``max_bytes``, or where these are many, are rows shuffled.
    """
    keys, columns = members.columns, rows.columns
    marks, is_member = members.withColumn(name, F.lit(True)), F.coalesce(name, F.lit(False)).alias(name)
    if fits_broadcast(members):
        return rows.join(F.broadcast(marks), keys, "left").select(*columns, is_member)
    keep = key_filter(members, max_bytes)
    if keep is not None:
        passed = stored(keep.may_hold(others), "passed-others")
        if fits_broadcast(passed):
            asked = keep.mark(rows, "_may").join(F.broadcast(passed.withColumn("_other", F.lit(True))), keys, "left")
            return asked.select(*columns, (F.col("_may") & F.col("_other").isNull()).alias(name))
    return stored(sliced_join(rows, marks, keys, "left").select(*columns, is_member), "marked-rows")
