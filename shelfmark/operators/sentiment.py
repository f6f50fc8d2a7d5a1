"""Lexicon sentiment of a review, in [-1, 1].

The score follows the five published heuristics of Hutto & Gilbert (ICWSM 2014):
degree words, negation, capitals, a contrasting "but", and punctuation. The
valences come from a lexicon table ``(word, valence)`` and the words that change
them from ``ContextWords``; both are the caller's, and none come with the code.

A score depends on its own review alone: no exploding, no grouping, no shuffle. The
words of a batch of reviews are worked on together, as arrays in Arrow batches, and
each distinct text of a batch once. Only a lexicon too large to hold in the plan is
reached by a join. Python's lower and upper case stand in for Spark's; the two differ
in a few letters that Unicode 16 added.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import PUNCTUATION, collect_words, small_batches
from shelfmark.operators.joins import sliced_join

# Constants of the published method.
DEGREE_STEP = 0.293
CAPITALS_STEP = 0.733
NEGATION_FACTOR = -0.74
DEGREE_DAMPING = (1.0, 0.95, 0.9)
BEFORE_CONTRAST, AFTER_CONTRAST = 0.5, 1.5
EXCLAMATION_STEP, EXCLAMATION_MAX = 0.292, 4
QUESTION_STEP, QUESTION_MAX = 0.18, 0.96
NORMALISING_ALPHA = 15.0

TEXT_AT_ONCE = 1_000_000
WORDS_KEPT = 200_000
BLOCK_BYTES, PART_TEXT = 4_000_000, 32_000_000


@dataclass(frozen=True)
class ContextWords:
    """Words that change the valence of the words around them."""

    stronger: tuple[str, ...] = ()
    weaker: tuple[str, ...] = ()
    negators: tuple[str, ...] = ()
    contrasts: tuple[str, ...] = ()

    def marks(self) -> dict[str, dict]:
        """The effect of each word, by word."""
        found: dict[str, dict] = {}
        for words, mark in (
            (self.stronger, {"degree": DEGREE_STEP}),
            (self.weaker, {"degree": -DEGREE_STEP}),
            (self.negators, {"negates": True}),
            (self.contrasts, {"contrasts": True}),
        ):
            for word in words:
                found.setdefault(word, {}).update(mark)
        return found


class _Marks:
    """The effects of words by place: arrays over all words of some texts, one after the other."""

    def __init__(self, effects: dict[str, dict]):
        self.effects = effects
        self.seen: dict[str, tuple] = {}

    def of(self, raw: str) -> tuple:
        """What a word between blanks is: whether it stays, is marked, in capitals, its valence and its effects."""
        bare = raw.strip(PUNCTUATION)
        word = raw if len(raw) <= 2 or len(bare) <= 2 else bare
        lower = word.lower()
        mark = self.effects.get(lower)
        capitals = word != lower and word == word.upper()
        if mark is None:
            return word != "", False, capitals, False, 0.0, False, 0.0, False, False
        valence, degree = mark.get("valence"), mark.get("degree")
        return (
            word != "", True, capitals, valence is not None, valence or 0.0, degree is not None, degree or 0.0,
            bool(mark.get("negates")), bool(mark.get("contrasts")),
        )

    def emphasised(self, texts: list[str]) -> np.ndarray:
        """The totals, made larger by punctuation."""
        totals = self.totals(texts)
        return totals + np.sign(totals) * np.array([_punctuation_emphasis(t) for t in texts])

    def totals(self, texts: list[str]) -> np.ndarray:
        """The summed valences of each text; its words are those of ``bare_words(text, keep_short=True)``."""
        words: list[str] = []
        sizes = np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            # str.split knows the same white space as WHITE_SPACE
            found = text.split()
            sizes[i] = len(found)
            words += found
        coded = pa.array(words, pa.string()).dictionary_encode()
        if len(self.seen) > WORDS_KEPT:
            self.seen.clear()
        rows = []
        for raw in coded.dictionary.to_pylist():
            row = self.seen.get(raw)
            if row is None:
                row = self.seen[raw] = self.of(raw)
            rows.append(row)
        owner, code = np.repeat(np.arange(len(texts)), sizes), np.asarray(coded.indices)
        # the empty word stands behind the others, so that there always is one
        features = [np.array(c) for c in zip(*rows, self.of(""))]
        stays = features[0][code]
        owner, code = owner[stays], code[stays]
        return _totals(len(texts), owner, *(f[code] for f in features[1:]))


def _totals(
    texts: int, owner: np.ndarray, marked: np.ndarray, capitals: np.ndarray, valued: np.ndarray, valence: np.ndarray,
    graded: np.ndarray, degree: np.ndarray, negates: np.ndarray, contrasts: np.ndarray,
) -> np.ndarray:
    """Per text the valences of its words in their context, added up in reading order."""
    # capitals stand out only where some marked word has them and not all words do
    sizes = np.bincount(owner, minlength=texts)
    emphatic = (np.bincount(owner[marked & capitals], minlength=texts) > 0) & (np.bincount(owner[capitals], minlength=texts) < sizes)
    loudness = np.where(capitals & emphatic[owner], CAPITALS_STEP, 0.0)
    first = np.full(texts, len(owner))
    np.minimum.at(first, owner[contrasts], np.flatnonzero(contrasts))

    at = np.flatnonzero(valued)
    value = valence[at] + np.sign(valence[at]) * loudness[at]
    for distance in (1, 2, 3):
        # a word with a valence of its own has no other effect
        before = np.maximum(at - distance, 0)
        acts = (at >= distance) & (owner[before] == owner[at])
        acts &= marked[before] & ~valued[before]
        # as in SQL, what is not a number is above all numbers
        direction, side = np.where(value < 0, -1.0, 1.0), np.where((value > 0) | np.isnan(value), 1.0, -1.0)
        push = degree[before] * direction + side * loudness[before]
        pushed = np.where(graded[before], push * DEGREE_DAMPING[distance - 1], 0.0)
        value = np.where(acts, (value + pushed) * np.where(negates[before], NEGATION_FACTOR, 1.0), value)
    place = first[owner[at]]
    none = place == len(owner)
    weight = np.where(none | (at == place), 1.0, np.where(at < place, BEFORE_CONTRAST, AFTER_CONTRAST))
    return np.bincount(owner[at], value * weight, texts)


def _text_totals(marks: _Marks, column: pa.Array) -> pa.Array:
    """The sums of a batch of texts; each distinct text is worked on once, a null text has none."""
    coded = column.dictionary_encode()
    texts = coded.dictionary.to_pylist()
    sums, held, size = [np.zeros(0)], [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size > TEXT_AT_ONCE:
            sums.append(marks.emphasised(held))
            held, size = [], 0
    if held:
        sums.append(marks.emphasised(held))
    return pa.array(np.concatenate(sums)).take(coded.indices)


def _add_score(df: DataFrame, name: str) -> DataFrame:
    """Adds the score from ``_total``, the sum over the words with the emphasis of the punctuation."""
    total = F.col("_total")
    score = F.round(total / F.sqrt(total * total + F.lit(NORMALISING_ALPHA)), 4)
    return df.withColumn(name, F.coalesce(score, F.lit(0.0))).drop("_total")


def _punctuation_emphasis(text: str) -> float:
    questions = text.count("?")
    questioned = 0.0 if questions <= 1 else questions * QUESTION_STEP if questions <= 3 else QUESTION_MAX
    return min(text.count("!"), EXCLAMATION_MAX) * EXCLAMATION_STEP + questioned


Scorer = Callable[[DataFrame], DataFrame]


def sentiment_scorer(
    lexicon: DataFrame,
    text: str = "review_text",
    name: str = "review_sentiment_score",
    context: ContextWords = ContextWords(),
    max_words: int | None = None,
) -> Scorer:
    """A DataFrame function that adds the score of ``text`` as column ``name``.

    Measures and collects the lexicon here, once, so that the returned function
    can be used on every micro-batch of a stream. NULL or empty text scores 0.0.
    A lexicon of more than ``max_words`` words is joined instead of collected.
    """
    lexicon = lexicon.select("word", F.col("valence").cast("double").alias("valence"))
    valences = collect_words(lexicon, "valence", max_words)
    marks = context.marks()

    if valences is None:
        return lambda df: _add_score(_sum_by_join(df, text, lexicon, marks), name)

    for word, valence in valences.items():
        marks.setdefault(word, {})["valence"] = valence
    effects = _Marks(marks)

    @F.arrow_udf("double")
    def totals(texts: pa.Array) -> pa.Array:
        return _text_totals(effects, texts)

    return lambda df: _add_score(small_batches(df).withColumn("_total", totals(text)), name)


def scorer_from(
    function: Callable[[Column], Column], text: str = "review_text", name: str = "review_sentiment_score"
) -> Scorer:
    """A scorer from any column function, such as a ``pandas_udf`` of an analyser."""
    return lambda df: df.withColumn(name, F.coalesce(function(F.col(text)).cast("double"), F.lit(0.0)))


def _sum_by_join(df: DataFrame, text: str, lexicon: DataFrame, marks: dict[str, dict]) -> DataFrame:
    """``_total`` for a lexicon of any size, by joining words to it.

    Works on each distinct text once, keyed by its digest. The texts are put in
    blocks of a few megabytes by their digests. A block's distinct words meet the
    lexicon, and those found return to their block, so no word is moved for every
    time it occurs. The texts are measured here.
    """
    rows = small_batches(df)
    size = rows.agg(F.sum(F.octet_length(text).cast("bigint"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    keyed = rows.withColumn("_digest", F.unhex(F.sha2(F.col(text), 256)))
    block = F.pmod(F.xxhash64("_digest"), F.lit(blocks)).alias("_block")
    texts = keyed.where(F.col("_digest").isNotNull()).groupBy("_digest").agg(F.any_value(text).alias("_text"))
    texts = texts.select(block, "_digest", "_text")
    unique = lexicon.groupBy("word").agg(F.min("valence").alias("valence"))
    # at most one row per word and block or batch, so no word is hot
    words = texts.select("_block", "_text").mapInArrow(_block_words, "_block long, word string")
    hits = words.join(unique, "word")

    def total(key: tuple[pa.Scalar, ...], texts: pa.Table, found: pa.Table) -> pa.Table:
        effects = {word: dict(mark) for word, mark in marks.items()}
        for word, valence in zip(found.column("word").to_pylist(), found.column("valence").to_pylist()):
            effects.setdefault(word, {})["valence"] = valence
        sums = _text_totals(_Marks(effects), texts.column("_text").combine_chunks())
        return pa.table({"_digest": texts.column("_digest"), "_total": sums})

    scored = texts.groupBy("_block").cogroup(hits.groupBy("_block")).applyInArrow(total, "_digest binary, _total double")
    return sliced_join(keyed, scored, ["_digest"], "left").drop("_digest")


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, word) of every word, each once in a part of 32 million characters of a task's texts; as the lexicon has them."""
    held: defaultdict[int, set[str]] = defaultdict(set)
    size = 0

    def part() -> pa.RecordBatch:
        numbers = np.repeat(np.fromiter(held, np.int64, len(held)), [len(w) for w in held.values()])
        words = [word for found in held.values() for word in found]
        return pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(words, pa.string())], ["_block", "word"])

    for batch in batches:
        for block, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            whole = text.as_py()
            raw = set(whole.split())
            bare = {(w, w.strip(PUNCTUATION)) for w in raw}
            held[block].update((w if len(w) <= 2 or len(b) <= 2 else b).lower() for w, b in bare)
            size += len(whole)
            if size > PART_TEXT:
                yield part()
                held.clear()
                size = 0
    if held:
        yield part()
