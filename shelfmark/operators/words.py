"""Adjectives of reviews and the word tables behind the word clouds."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.text import WordTable, bare_words, collect_words, small_batches, split_lower
from shelfmark.operators.joins import join_null_safe, sliced_join
from shelfmark.operators.sizing import fits_broadcast
from shelfmark.sources.storage import stored

ADJECTIVE = "JJ"
ROWS_PER_PART = 10_000
FLUSH_AT = 200_000

Tagger = Callable[[DataFrame], DataFrame]


def adjective_tagger(
    tags: DataFrame, text: str = "review_text", name: str = "adjective_list", max_words: int | None = None
) -> Tagger:
    """A DataFrame function that adds the adjectives of ``text``, in reading order.

    ``tags`` has one ``(word, tag)`` row per word; only tag JJ counts, so
    comparatives and superlatives do not. NULL text has no adjectives. Measures
    and collects the dictionary here, once; one of more than ``max_words``
    adjectives is joined instead.
    """
    adjectives = tags.where(F.col("tag") == ADJECTIVE).select("word", "tag")
    known = collect_words(adjectives, "tag", max_words)
    none = F.array().cast("array<string>")

    if known is None:
        return lambda df: _tag_by_join(df, text, name, adjectives)

    table = WordTable.build(tags.sparkSession, known, "string")
    found = F.filter(bare_words(F.col(text)), lambda w: table.get(F.lower(w)).isNotNull())
    return lambda df: df.withColumn(name, F.coalesce(found, none))


def tagger_from(
    function: Callable[[Column], Column], text: str = "review_text", name: str = "adjective_list"
) -> Tagger:
    """A tagger from any column function that gives an array of words."""
    return lambda df: df.withColumn(name, F.coalesce(function(F.col(text)), F.array().cast("array<string>")))


def _tag_by_join(df: DataFrame, text: str, name: str, adjectives: DataFrame) -> DataFrame:
    """The same for a dictionary of any size; each distinct text is tagged once."""
    keyed = df.withColumn("_digest", F.sha2(F.col(text), 256))
    texts = keyed.where(F.col("_digest").isNotNull()).groupBy("_digest").agg(F.any_value(text).alias("_text"))
    words = texts.select("_digest", F.posexplode(bare_words(F.col("_text"))).alias("_at", "_word"))
    hits = sliced_join(
        words.withColumn("_lower", F.lower("_word")),
        adjectives.select(F.col("word").alias("_lower")).distinct(),
        ["_lower"],
        "left_semi",
    )
    lists = hits.groupBy("_digest").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_at", "_word"))), lambda h: h["_word"]).alias("_found")
    )
    joined = sliced_join(keyed, lists, ["_digest"], "left")
    return joined.withColumn(name, F.coalesce("_found", F.array().cast("array<string>"))).drop("_digest", "_found")


def adjective_counts(tagged: DataFrame, keys: list[str]) -> DataFrame:
    """Occurrences of each adjective per key, ignoring case.

    The scalable form of the word-cloud table: it is never longer than the
    dictionary per key, however many reviews a key has.
    """
    words = tagged.select(*keys, F.explode(F.transform("adjective_list", F.lower)).alias("word"))
    return words.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("word_count"))


def adjective_strings(
    tagged: DataFrame, keys: list[str], order: str = "review_id", rows_per_part: int = ROWS_PER_PART
) -> DataFrame:
    """All adjectives of a key as text, in ``order``, reviews without any skipped.

    A key's reviews are ranked by ``order`` and every ``rows_per_part`` of them
    make a row, numbered by ``part`` from 0, so that no row grows with the key
    and the parts read one after the other give the whole text. The reviews are
    sorted in ranges, where a review's place tells its rank, and the counts of the
    ranges before are added, so a hot key is ranked by many tasks. The ranges, and
    a row per key and range, are written to the shared folder.
    """
    words = F.array_join("adjective_list", " ").alias("_words")
    narrow = tagged.select(*keys, F.col(order).alias("_at"), words)
    by = [*keys, "_at", "_words"]
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    sorted_ranges = narrow.repartitionByRange(*by).sortWithinPartitions(*by)
    ranged = stored(sorted_ranges.withColumns({"_range": F.spark_partition_id(), "_position": position}), "ranges")
    # a key has one row here for each range it lies in
    sizes = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_size"), F.min("_position").alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        sizes.select(*keys, "_range", "_first", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before")), "offsets"
    )
    small = F.broadcast(offsets) if fits_broadcast(offsets) else offsets
    placed = join_null_safe(ranged, small, [*keys, "_range"])
    ranked = placed.withColumn("_rank", F.col("_position") - F.col("_first") + 1)
    part = F.floor((F.col("_before") + F.col("_rank") - 1) / rows_per_part).cast("int")
    in_order = F.array_sort(F.collect_list(F.struct("_range", "_rank", "_words")))
    texts = F.filter(F.transform(in_order, lambda e: e["_words"]), lambda w: w != "")
    return (
        ranked.groupBy(*keys, part.alias("part"))
        .agg(texts.alias("_texts"))
        .select(*keys, "part", F.array_join("_texts", " ").alias("adjectives"))
    )


def roll_up(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Adjective counts for fewer keys, from a stored table of counts."""
    return counts.groupBy(*keys, "word").agg(F.sum("word_count").alias("word_count"))


def word_weights(counts: DataFrame, top: int | None = None) -> DataFrame:
    """Words with their count and weight ``count / largest count``.

    ``counts`` may hold a word several times. With ``top``, only the most
    frequent words are returned, ties in word order.
    """
    words = counts.groupBy("word").agg(F.sum("word_count").alias("word_count"))
    largest = words.agg(F.max("word_count")).scalar()
    if top is not None:
        words = words.orderBy(F.desc("word_count"), "word").limit(top)
    return words.select("word", "word_count", (F.col("word_count") / largest).alias("weight"))


def bag_of_words(df: DataFrame, words: Column) -> DataFrame:
    """``word``, ``term_count`` and ``document_count`` over the word arrays of ``df``.

    Each text sends all its words and, marked as such, each of its distinct words
    once. A text's words need no grouping of their own then: the words of all
    texts are counted within a partition before anything is shuffled.
    """
    split = df.select(words.alias("_words"))
    every = F.transform("_words", lambda w: F.struct(w.alias("word"), F.lit(0).alias("first")))
    distinct = F.transform(F.array_distinct("_words"), lambda w: F.struct(w.alias("word"), F.lit(1).alias("first")))
    return (
        split.select(F.inline(F.concat(every, distinct)))
        .groupBy("word")
        .agg(F.count_if(F.col("first") == 0).alias("term_count"), F.count_if(F.col("first") == 1).alias("document_count"))
    )


def bag_of_lower_words(df: DataFrame, text: str, flush_at: int = FLUSH_AT) -> DataFrame:
    """The same for the ``lower_words`` of a text column.

    The texts are split and counted in Arrow batches. A task adds up its words
    before the shuffle and hands them on whenever ``flush_at`` distinct ones have
    gathered.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, documents = Counter(), Counter()

        def gathered() -> pa.RecordBatch:
            columns = [pa.array(terms.keys(), pa.binary()).cast(pa.string()), pa.array(terms.values(), pa.int64())]
            return pa.RecordBatch.from_arrays([*columns, pa.array([documents[w] for w in terms], pa.int64())], ["word", "terms", "documents"])

        for batch in batches:
            for found in batch.column(0):
                if not found.is_valid:
                    continue
                words = split_lower(found.as_py())
                terms.update(words)
                documents.update(set(words))
                if len(terms) > flush_at:
                    yield gathered()
                    terms.clear()
                    documents.clear()
        yield gathered()

    lower = small_batches(df).select(F.lower(text).cast("binary").alias("text"))
    counted = lower.mapInArrow(count, "word string, terms long, documents long")
    return counted.groupBy("word").agg(F.sum("terms").alias("term_count"), F.sum("documents").alias("document_count"))


def vocabulary(bag: DataFrame, size: int = 10_000, min_documents: int = 5) -> DataFrame:
    """The ``size`` most frequent words found in at least ``min_documents`` texts."""
    kept = bag.where(F.col("document_count") >= min_documents)
    return kept.orderBy(F.desc("term_count"), "word").limit(size)
