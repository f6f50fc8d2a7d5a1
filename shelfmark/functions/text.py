"""Tokens and word look-ups inside one row.

A review's words never leave its row: splitting, looking up and scoring are
expressions on array columns, so none of them shuffles.
"""

from __future__ import annotations

import json
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: every character counted as white space between words.
WHITE_SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"
PUNCTUATION = string.punctuation
# Spark's own bound on what Python is handed at a time, and the one set in its place.
BATCH_SETTING, SPARK_BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"


def small_batches(df: DataFrame) -> DataFrame:
    """Lets Spark hand at most 8 MB of texts to Python at a time, where the session has not chosen a size itself."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, SPARK_BATCH) == SPARK_BATCH:
        conf.set(BATCH_SETTING, BATCH_BYTES)
    return df


def lower_words(text: Column) -> Column:
    """Lower-case words, split at each single white-space character.

    Empty words between two separators stay and trailing ones go, which is what
    ``pyspark.ml.feature.Tokenizer`` returns.
    """
    trimmed = F.regexp_replace(F.lower(text), r"\s+$", "")
    only_blanks = (trimmed == "") & (text != "")
    return F.when(only_blanks, F.array().cast("array<string>")).otherwise(F.split(trimmed, r"\s"))


ONE_BLANK = bytes.maketrans(b"\t\n\x0b\f\r", b"     ")


def split_lower(lower: bytes) -> list[bytes]:
    """The ``lower_words`` of a text that is in lower case already, as UTF-8."""
    trimmed = lower.translate(ONE_BLANK).rstrip(b" ")
    return trimmed.split(b" ") if trimmed or not lower else []


def without_stop_words(words: Column, stop_words: list[str]) -> Column:
    """Drops stop words, ignoring case (a hash-set test per word)."""
    stops = [w.lower() for w in stop_words]
    return F.filter(words, lambda w: ~F.lower(w).isin(stops))


def bare_words(text: Column, keep_short: bool = False) -> Column:
    """Words without the punctuation around them, in their own case.

    With ``keep_short``, a word of which two or fewer letters would remain keeps
    its punctuation, so that emoticons survive. Words that vanish are dropped.
    """
    raw = F.split(F.btrim(F.regexp_replace(text, WHITE_SPACE, " ")), " ")

    def strip(word: Column) -> Column:
        bare = F.btrim(word, F.lit(PUNCTUATION))
        return F.when((F.length(word) <= 2) | (F.length(bare) <= 2), word).otherwise(bare) if keep_short else bare

    return F.filter(F.transform(raw, strip), lambda w: w != "")


class WordTable:
    """A small word → value table held inside the plan as one constant.

    The words are spread over hash buckets, so a look-up hashes the word and
    searches a map of a few entries. Only a table within ``MAX_WORDS`` words of
    ``MAX_WORD_BYTES`` may be held this way; ``collect_words`` checks that.
    """

    MAX_WORDS = 50_000
    MAX_WORD_BYTES = 100

    def __init__(self, bucketed: list[dict], value_type: str):
        self._size = len(bucketed)
        self._table = _constant(bucketed, f"array<map<string,{value_type}>>")

    @classmethod
    def build(cls, spark, values: dict, value_type: str) -> "WordTable":
        """Buckets ``values`` with Spark's own hash of each word."""
        words, size = list(values), max(16, 2 * len(values))
        homes = F.transform(_constant(words, "array<string>"), lambda w: cls._home(w, size))
        bucketed: list[dict] = [{} for _ in range(size)]
        for word, home in zip(words, spark.range(1).select(homes).first()[0]):
            bucketed[home][word] = values[word]
        return cls(bucketed, value_type)

    @staticmethod
    def _home(word: Column, size: int) -> Column:
        return F.pmod(F.xxhash64(word), F.lit(size)).cast("int")

    def get(self, word: Column) -> Column:
        """Value of ``word``, NULL when the table does not hold it."""
        return F.get(self._table, self._home(word, self._size))[word]


def _constant(value, kind: str) -> Column:
    """A nested constant, which Spark works out once per query."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), kind)


def collect_words(table: DataFrame, value: str, max_words: int | None = None) -> dict | None:
    """``word`` → ``value`` of a small table, or None when it is too large.

    Runs one job that brings back no more than the bounds of ``WordTable`` and
    one row; ``max_words`` lowers them. A word listed twice takes its smallest
    value.
    """
    bound = WordTable.MAX_WORDS if max_words is None else min(max_words, WordTable.MAX_WORDS)
    unique = table.where(F.col("word").isNotNull()).groupBy("word").agg(F.min(value).alias(value))
    fits = F.octet_length("word") <= WordTable.MAX_WORD_BYTES
    found = unique.select(F.when(fits, F.col("word")).alias("word"), value).limit(bound + 1).collect()
    if len(found) > bound or any(row["word"] is None for row in found):
        return None
    return {row["word"]: row[value] for row in found}


def english_stop_words() -> list[str]:
    """The English list that ships with Spark ML."""
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords("english")
