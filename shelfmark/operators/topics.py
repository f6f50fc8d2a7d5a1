"""Topic model of review texts, on Spark ML."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import LDA, LDAModel, LocalLDAModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.text import WordTable, english_stop_words, small_batches, split_lower
from shelfmark.operators.joins import lookup_join
from shelfmark.operators.words import bag_of_lower_words, vocabulary
from shelfmark.sources.storage import fresh_path

TEXTS_AT_ONCE = 100


@dataclass(frozen=True)
class TopicModel:
    """The vocabulary, the topics and, where the model was just fitted, the count vectors it was fitted on."""

    counter: CountVectorizerModel
    lda: LDAModel
    features: DataFrame | None = None


def count_vectors(
    df: DataFrame, text: str, size: int = 10_000, min_documents: int = 5
) -> tuple[CountVectorizerModel, DataFrame]:
    """Adds ``features``, the counts of the vocabulary's words in each text.

    The vocabulary is grouped and ranked by Spark, ties in word order, so that
    the same texts always give the same vectors. Its at most ``size`` words are
    collected.
    """
    known = [row.word for row in topic_vocabulary(df, text, size, min_documents).collect()]
    counter = CountVectorizerModel.from_vocabulary(known, inputCol="_words", outputCol="features")
    return counter, _counted(counter, df, text)


def topic_vocabulary(df: DataFrame, text: str, size: int = 10_000, min_documents: int = 5) -> DataFrame:
    """The most frequent words of the texts but for stop words, which go once they are counted."""
    return vocabulary(bag_of_lower_words(df, text).where(~F.col("word").isin(english_stop_words())), size, min_documents)


def _counted(counter: CountVectorizerModel, df: DataFrame, text: str) -> DataFrame:
    """What ``counter`` makes of the words, its vocabulary looked up for a batch of texts at once."""
    vocabulary, size = counter.vocabulary, len(counter.vocabulary)

    @F.arrow_udf(VectorUDT())
    def counts(lower: pa.Array) -> pa.Array:
        text, term, n = _count_known(lower, _numbered(vocabulary))
        begins = pa.array(np.searchsorted(text, np.arange(len(lower) + 1)), pa.int32())
        lists = (pa.ListArray.from_arrays(begins, v) for v in (pa.array(term, pa.int32()), pa.array(n, pa.float64())))
        whole = (pa.array(np.full(len(lower), v), kind) for v, kind in ((0, pa.int8()), (size, pa.int32())))
        return pa.StructArray.from_arrays([*whole, *lists], ["type", "size", "indices", "values"])

    return small_batches(df).withColumn("features", counts(F.lower(text).cast("binary")))


def _numbered(vocabulary: list[str]) -> dict[bytes, int]:
    return {word.encode(): i for i, word in enumerate(vocabulary)}


def _count_known(lower: pa.Array, known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of the known words in each of some texts in lower case, by text and then by term."""
    terms = [np.zeros(0, np.int64)]
    for i, text in enumerate(lower):
        words = split_lower(text.as_py()) if text.is_valid else []
        found = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
        terms.append(found[found >= 0] + i * len(known))
    place, n = np.unique(np.concatenate(terms), return_counts=True)
    return place // max(len(known), 1), place % max(len(known), 1), n


def fit_topics(
    df: DataFrame,
    text: str = "review_text",
    topics: int = 10,
    iterations: int = 10,
    vocabulary_size: int = 10_000,
    min_documents: int = 5,
    seed: int = 1,
) -> TopicModel:
    """Fits the model; its iterations are jobs and run here.

    The iterations read only the count vectors, which are kept in the executors'
    memory and on their disks while they run, and worked out anew where one is
    lost.
    """
    counter, features = count_vectors(df, text, vocabulary_size, min_documents)
    vectors = features.select("features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = LDA(k=topics, maxIter=iterations, seed=seed).fit(vectors)
    finally:
        vectors.unpersist()
    return TopicModel(counter, model, features)


def topic_terms(model: TopicModel, terms: int = 10) -> DataFrame:
    """``topic``, ``rank``, ``term_index``, ``weight``: the strongest terms first."""
    pairs = F.arrays_zip("termIndices", "termWeights")
    described = model.lda.describeTopics(terms).select("topic", F.posexplode(pairs).alias("rank", "_t"))
    return described.select(
        "topic",
        (F.col("rank") + 1).alias("rank"),
        F.col("_t.termIndices").alias("term_index"),
        F.col("_t.termWeights").alias("weight"),
    )


def topic_words(model: TopicModel, terms: int = 20) -> DataFrame:
    """One row per topic with its strongest words in order.

    The vocabulary is bounded by the counter's ``vocabSize``.
    """
    words = SparkSession.active().createDataFrame(list(enumerate(model.counter.vocabulary)), "term_index int, word string")
    named = lookup_join(topic_terms(model, terms), words, ["term_index"])
    ordered = F.array_sort(F.collect_list(F.struct("rank", "word")))
    return named.groupBy("topic").agg(F.transform(ordered, lambda r: r.word).alias("words"))


def topic_mix(model: TopicModel, df: DataFrame | None = None, text: str = "review_text") -> DataFrame:
    """The input rows with the share of each topic, as an array.

    With ``df``, its texts are counted and given shares by the model as it is, fitted
    or loaded, without a new fit; words the vocabulary does not have are passed over.
    """
    mixed = model.lda.transform(model.features if df is None else _counted(model.counter, df, text))
    return mixed.withColumn("topic_distribution", vector_to_array("topicDistribution")).drop(
        "features", "topicDistribution"
    )


def save_topics(model: TopicModel, path: str) -> None:
    """Stores vocabulary and topics under ``path``; what stands there is replaced."""
    model.counter.write().overwrite().save(f"{path}/vocabulary")
    model.lda.write().overwrite().save(f"{path}/topics")


def load_topics(path: str) -> TopicModel:
    """The model that was stored; it gives the same shares as the one that was fitted."""
    return TopicModel(CountVectorizerModel.load(f"{path}/vocabulary"), LocalLDAModel.load(f"{path}/topics"))


def _digamma(x: np.ndarray) -> np.ndarray:
    """The derivative of the logarithm of the gamma function, to about 1e-12, for positive numbers."""
    far = x + 10
    inverse = 1 / (far * far)
    # fixed values: the first terms of its asymptotic series
    series = inverse * (1 / 12 - inverse * (1 / 120 - inverse * (1 / 252 - inverse / 240)))
    return np.log(far) - 1 / (2 * far) - series - reduce(add, (1 / (x + i) for i in range(10)))


def word_statistics(model: TopicModel, df: DataFrame, text: str = "review_text") -> DataFrame:
    """(word, s0, s1, ...): how often each word of the vocabulary is expected under each topic in ``df``.

    This is what a step of online variational Bayes (Hoffman, Blei, Bach 2010) sums
    over the texts. The words of a batch of texts are counted as arrays, and a
    task adds up one number per word and topic before the shuffle. The vocabulary
    may have 50,000 words.
    """
    known = model.counter.vocabulary
    if len(known) > WordTable.MAX_WORDS:
        raise ValueError(f"a vocabulary of more than {WordTable.MAX_WORDS} words cannot be updated")
    weights = model.lda.topicsMatrix().toArray()
    expected = np.exp(_digamma(weights) - _digamma(weights.sum(axis=0)))
    prior = float(model.lda.estimatedDocConcentration().toArray().sum())
    names = [f"s{k}" for k in range(weights.shape[1])]

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, found, numbers = np.zeros_like(expected), np.zeros(len(expected), bool), _numbered(known)
        for batch in batches:
            for a in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch.slice(a, TEXTS_AT_ONCE)
                at, term, n = _count_known(part.column(0), numbers)
                if not len(at):
                    continue
                # a text without a known word has no shares, and is not looked at
                shares = np.maximum(part.column(1).flatten().to_numpy().reshape(len(part), -1), np.finfo(float).tiny)
                size = np.bincount(at, n, len(part))[:, None] + prior
                own = np.exp(_digamma(shares * size) - _digamma(size))
                p = own[at] * expected[term]
                p *= (n / p.sum(axis=1))[:, None]
                for k in range(len(names)):
                    sums[:, k] += np.bincount(term, p[:, k], len(sums))
                found[term] = True
        words = pa.array(known, pa.string()).filter(pa.array(found))
        yield pa.RecordBatch.from_arrays([words, *(pa.array(sums[found, k]) for k in range(len(names)))], ["word", *names])

    mixed = topic_mix(model, df, text).select(F.lower(text).cast("binary").alias("lower"), "topic_distribution")
    parts = mixed.mapInArrow(expect, ", ".join(["word string", *(f"{name} double" for name in names)]))
    return parts.groupBy("word").agg(*(F.sum(name).alias(name) for name in names))


def update_topics(
    model: TopicModel, df: DataFrame, texts_so_far: int, step: int, text: str = "review_text", offset: float = 1024.0, decay: float = 0.51
) -> TopicModel:
    """The model moved towards a new batch of texts; the vocabulary stays.

    ``texts_so_far`` counts all texts, the batch included, and ``step`` the updates,
    from 1; later steps weigh less. The weights of the topics, as many as the
    vocabulary has words, pass through the driver. A batch without a word of the
    vocabulary leaves the model as it is.
    """
    spark = df.sparkSession
    found = {r.word: r[1:] for r in word_statistics(model, df, text).collect()}
    texts = df.where(F.col(text) != "").count()
    if not found:
        return model
    old, new = fresh_path(spark, "topics"), fresh_path(spark, "topics")
    model.lda.write().save(old)
    data = spark.read.parquet(f"{old}/data")
    stored_model = data.first()
    weights = stored_model.topicsMatrix.toArray()
    sums = np.array([found.get(word, [0.0] * weights.shape[1]) for word in model.counter.vocabulary])
    rate = (offset + step) ** -decay
    moved = (1 - rate) * weights + rate * (stored_model.topicConcentration + texts_so_far / max(texts, 1) * sums)
    matrix = DenseMatrix(*moved.shape, moved.ravel(order="F").tolist())
    row = tuple(matrix if name == "topicsMatrix" else stored_model[name] for name in data.columns)
    spark.createDataFrame([row], data.schema).write.parquet(f"{new}/data")
    spark.read.text(f"{old}/metadata").coalesce(1).write.text(f"{new}/metadata")
    return TopicModel(model.counter, LocalLDAModel.load(new))
