"""A quality classifier: regularised quadratic discriminant over text statistics.

Each class has a mean and a covariance of its documents' transformed statistics.
The covariance is shrunk towards its own diagonal and the pooled one; a score is
the difference of the two log-densities, with the Cholesky factors worked out once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import crc_remainder, small_batches, stored, text_slices, utf8_bytes
from shelfmark.llm.words64 import hash_words

SHRINK_TO_DIAGONAL = 0.1
SHRINK_TO_POOLED = 0.1
RIDGE = 1e-3
FEW_BYTES, FEW_WORDS = 100, 20
CLASSES = (0, 1)
FEATURES = (
    "word_length", "upper", "digit", "other_letter", "space", "newline", "comma_stop",
    "shout", "bar", "sign", "any_sign", "repeated_lines", "capital_words", "mixed_words", "same_word",
)


def _classes_of_bytes() -> np.ndarray:
    """The class of each byte value: the columns of the count table below."""
    table = np.full(256, 9, np.uint8)
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    table[128:] = 3
    table[[ord(" "), 9, 11, 12, 13]] = 4
    table[10] = 5
    table[[ord(","), ord(".")]] = 6
    table[[ord("!"), ord("?")]] = 7
    table[[ord("|"), ord("<"), ord(">"), ord("{"), ord("}"), ord("\\")]] = 8
    return table


BYTE_CLASS = _classes_of_bytes()


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of transformed statistics per text, finite for any text and also for a null.

    All are shares and a mean, so that a text's length does not enter. Square roots
    even out the shares' spread. A short text is drawn towards usual prose, with
    the weight of 100 bytes or 20 words, so that it is not taken for an outlier.
    """
    data, places = utf8_bytes(texts)
    n = len(texts)
    size = np.diff(places)
    kind = BYTE_CLASS[data]
    full = np.flatnonzero(size)
    starts = places[:-1][full]

    def per_text(marks: np.ndarray) -> np.ndarray:
        out = np.zeros(n)
        if len(full):
            out[full] = np.add.reduceat(marks.astype(np.int64), starts)
        return out

    counts = [per_text(kind == k) for k in range(10)]
    gap = (kind == 4) | (kind == 5)
    word_start = ~gap
    word_start[1:] &= gap[:-1]
    first = np.zeros(len(data), bool)
    first[starts] = True
    word_start |= first & ~gap
    words = per_text(word_start)
    capital = per_text(word_start & (kind == 1))
    # a sign other than a comma or stop right after a letter and before another character
    inner = np.zeros(len(data), bool)
    if len(data) > 2:
        inner[1:-1] = ((kind[1:-1] == 9) | (kind[1:-1] == 7)) & (kind[:-2] <= 3) & ~gap[2:]
        # what stands before a text's first character or after its last one is another text's
        inner[starts] = inner[places[1:][full] - 1] = False
    mixed = per_text(inner)
    word, owner = hash_words(data, places)
    same = np.bincount(owner[1:][(word[1:] == word[:-1]) & (owner[1:] == owner[:-1])], minlength=n).astype(float)
    letters = counts[0] + counts[1] + counts[3]
    columns = [
        np.log((size - counts[4] - counts[5] + 6 * FEW_WORDS) / (words + FEW_WORDS)),
        _share(counts[1], letters, 0.04, FEW_BYTES),
        _share(counts[2], size, 0.01, FEW_BYTES),
        _share(counts[3], size, 0.05, FEW_BYTES),
        _share(counts[4], size, 0.15, FEW_BYTES),
        _share(counts[5], size, 0.01, FEW_BYTES),
        _share(counts[6], words, 0.15, FEW_WORDS),
        _share(counts[7], words, 0, FEW_WORDS),
        _share(counts[8], words, 0, FEW_WORDS),
        _share(counts[9], words, 0, FEW_WORDS),
        _share(counts[9] + counts[7], size, 0, FEW_BYTES),
        _share(_repeated_line_bytes(data, places), size, 0, FEW_BYTES),
        _share(capital, words, 0.15, FEW_WORDS),
        _share(mixed, words, 0, FEW_WORDS),
        _share(same, words, 0.01, FEW_WORDS),
    ]
    return np.stack(columns, axis=1)


def _share(part: np.ndarray, whole: np.ndarray, usual: float, few: int) -> np.ndarray:
    """The square root of a share, drawn to what is usual in prose where the whole is small."""
    return np.sqrt(np.minimum(1, (part + usual * few) / (whole + few)))


def _repeated_line_bytes(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Per text the bytes in lines that an earlier line of the text repeats."""
    out = np.zeros(len(places) - 1)
    raw = data.tobytes()
    for i, (a, b) in enumerate(zip(places[:-1].tolist(), places[1:].tolist())):
        lines = raw[a:b].split(b"\n")
        if len(lines) > 1:
            out[i] = sum(map(len, lines)) - sum(map(len, set(lines)))
    return out


@dataclass(frozen=True)
class Discriminant:
    """Log prior, mean, inverse Cholesky factor and log-determinant per class."""

    prior: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """log p(class 1 | x) - log p(class 0 | x)."""
        density = []
        for c in CLASSES:
            z = (x - self.means[c]) @ self.factors[c].T
            density.append(self.prior[c] - 0.5 * (np.einsum("ij,ij->i", z, z) + self.log_dets[c]))
        return density[1] - density[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1."""
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -700, 700)))


def with_statistics(documents: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every row's text as an array."""

    def work_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                x = statistics(batch.column(1)[a:b])
                offsets = np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32)
                rows = pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], rows], ["doc_id", "x"])

    texts = small_batches(documents).selectExpr("cast(doc_id as long) as doc_id", "text")
    return texts.mapInArrow(work_out, "doc_id long, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def _moments(labelled: DataFrame) -> DataFrame:
    """Per class the count, sums and sums of products, from (x, label)."""
    wide = 1 + len(FEATURES)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, wide, wide))
        for batch in batches:
            x = _matrix(batch.column(0))
            x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
            label = np.asarray(batch.column(1))
            for c in CLASSES:
                sums[c] += x[label == c].T @ x[label == c]
        label, place = np.divmod(np.arange(sums.size), wide * wide)
        arrays = [pa.array(label, pa.int32()), pa.array(place, pa.int32()), pa.array(sums.ravel())]
        yield pa.RecordBatch.from_arrays(arrays, ["label", "place", "value"])

    partial = labelled.select("x", "label").mapInArrow(add_up, "label int, place int, value double")
    return partial.groupBy("label", "place").agg(F.sum("value").alias("value"))


def train(labelled: DataFrame) -> Discriminant:
    """Fits the discriminant to all rows of ``labelled`` (x, label 0 or 1).

    The moments are sums, added up in the tasks; the driver receives 2 x 16 x 16
    numbers. A class without rows takes the pooled moments, so that its score is
    the prior; without any rows every score is one half.
    """
    wide = 1 + len(FEATURES)
    sums = np.zeros((2, wide, wide))
    for row in _moments(labelled).collect():
        sums[row.label].ravel()[row.place] = row.value
    n = sums[:, 0, 0]
    pooled = sums.sum(axis=0)
    means, covariances = np.zeros((2, wide - 1)), np.zeros((2, wide - 1, wide - 1))
    for c, moments in enumerate([*sums, pooled]):
        if moments[0, 0] == 0:
            moments = pooled if pooled[0, 0] else np.eye(wide)
        mean = moments[0, 1:] / moments[0, 0]
        covariance = moments[1:, 1:] / moments[0, 0] - np.outer(mean, mean)
        if c < 2:
            means[c], covariances[c] = mean, covariance
    within = (n[:, None, None] * covariances).sum(axis=0) / max(1, n.sum()) + 0.0
    factors, log_dets = [], []
    for c in CLASSES:
        own = covariances[c]
        own = (1 - SHRINK_TO_DIAGONAL) * own + SHRINK_TO_DIAGONAL * np.diag(np.diag(own))
        own = (1 - SHRINK_TO_POOLED) * own + SHRINK_TO_POOLED * within + RIDGE * np.eye(wide - 1)
        lower = np.linalg.cholesky(own)
        factors.append(np.linalg.inv(lower))
        log_dets.append(2 * np.log(np.diag(lower)).sum())
    prior = np.log((n + 1) / (n.sum() + 2))
    return Discriminant(prior, means, np.array(factors), np.array(log_dets))


def held_out(doc_id: str = "doc_id") -> Column:
    """The third of the documents whose labels are never learned from."""
    return crc_remainder(doc_id, 3) == 1


def train_on_labels(known: DataFrame, labels: DataFrame) -> Discriminant:
    """Fits to the rows of ``known`` (doc_id, x) with a quality label, without the held-out ones.

    Each pair of a document and a label of its id counts once; nulls count not
    at all. The statistics meet the labels, not the texts.
    """
    marks = labels.where(F.col("quality").isin(*CLASSES) & F.col("doc_id").isNotNull())
    marks = marks.select("doc_id", F.col("quality").cast("int").alias("label"))
    return train(known.where(~held_out()).join(marks, "doc_id"))


def score_column(documents: DataFrame, model: Discriminant, column: str) -> DataFrame:
    """``documents`` with _score (0 to 1, of class 1), from the texts or the statistics in ``column``.

    Any text has a score, also an empty or null one. Nothing else is looked at.
    """
    known = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index(column)
    of_texts = documents.schema[column].dataType.typeName() == "string"

    def add_score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = text_slices(batch.column(at)) if of_texts else [(0, len(batch))]
            for a, b in cuts:
                part = batch.slice(a, b - a)
                x = statistics(part.column(at)) if of_texts else _matrix(part.column(at))
                score = pa.array(known.value.score(x))
                yield pa.RecordBatch.from_arrays([*part.columns, score], [*batch.schema.names, "_score"])

    columns = (f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in documents.schema)
    return small_batches(documents).mapInArrow(add_score, ", ".join([*columns, "_score double"]))


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``documents``.

    The texts are read once and whole, however long; their statistics are written to
    the shared folder. A null text is as an empty one, and a score of one half or more,
    a tie included, predicts 1. Repeated rows and null ids keep their rows; an empty
    table gives none; columns other than doc_id and text are ignored.
    """
    known = stored(with_statistics(documents), "quality-statistics")
    scored = score_column(known, train_on_labels(known, labels), "x")
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents`` without those that the classifier rejects, as ``quality_scores`` predicts.

    All columns and repeated rows stay. A null or empty text is judged as
    ``quality_scores`` does, an empty table gives an empty one.
    """
    model = train_on_labels(with_statistics(documents), labels)
    return score_column(documents, model, "text").where("_score >= 0.5").select(*documents.columns)
