"""Tags of words by their sentence: a hidden Markov model counted in Spark.

How often a tag follows another, and how often a word has a tag, are counted
over a tagged corpus. The best tags of a sentence are found by Viterbi's
recursion, as expressions on the review's own words: nothing is shuffled and no
Python runs. Scores are logarithms in whole millionths, so that sums are exact
and a tie is a tie.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import WHITE_SPACE, WordTable, bare_words, collect_words
from shelfmark.operators.joins import sliced_join
from shelfmark.operators.words import ADJECTIVE, Tagger

UNIT = 1_000_000
ADDED = 0.1
MOST_TAGS = 60
# More than the tags and the edge of a sentence together.
WAYS = 64
SENTENCE_WORDS = 200
TAGGED = "array<struct<word:string,tag:string>>"
# Stands between sentences; worse than any sum of real scores.
BREAK = "\u0001"
IMPOSSIBLE = -(10**15)


@dataclass(frozen=True)
class TagModel:
    """``steps[i][j]`` scores tag j after tag i; 0 stands for the edge of a sentence, then come ``tags`` in order.

    ``emissions`` has the scores of a word under each of ``tags``, ``unseen`` those of any other word.
    """

    tags: list[str]
    steps: list[list[int]]
    emissions: DataFrame
    unseen: list[int]


def sentences(text: Column, most: int = SENTENCE_WORDS) -> Column:
    """The bare words of each sentence; one ends at white space after ``.``, ``!`` or ``?``.

    Only what is longer than ``most`` words is cut, into pieces of ``most``. A null
    text has no sentences.
    """
    parts = F.split(F.regexp_replace(text, "([.!?])" + WHITE_SPACE, "$1" + BREAK), BREAK)
    words = F.filter(F.transform(parts, lambda part: bare_words(part)), lambda w: F.size(w) > 0)

    def pieces(found: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / most).cast("int"))
        return F.transform(starts, lambda i: F.slice(found, i * most + 1, F.lit(most)))

    return F.flatten(F.transform(words, pieces))


def _score(part: float, whole: float) -> int:
    return round(math.log(part / whole) * UNIT)


def learn_tags(corpus: DataFrame, tagged: str = "tagged") -> TagModel:
    """Counts a corpus of sentences, each an array of (word, tag) in order; case is ignored.

    A score is the logarithm of a share, 0.1 being added to every count. Words that
    the corpus does not have are given the tags that words seen once have. The
    counts of tags reach the driver, those of words stay a table. Sentences that
    are null or empty and words without a tag are left out; more than 60 tags are
    an error.
    """
    spark = corpus.sparkSession
    whole = F.filter(F.coalesce(F.col(tagged), F.array().cast(TAGGED)), lambda w: w.word.isNotNull() & w.tag.isNotNull())
    kept = corpus.select(whole.alias("words")).where(F.size("words") > 0)
    tags = F.transform("words", lambda w: w.tag)
    edge = F.array(F.lit(None).cast("string"))
    pairs = F.arrays_zip(F.concat(edge, tags).alias("before"), F.concat(tags, edge).alias("after"))
    counts = kept.select(F.inline(pairs)).groupBy("before", "after").agg(F.count(F.lit(1)).alias("n")).limit(MOST_TAGS**2 + 1)
    found = {(r.before, r.after): r.n for r in counts.collect()}
    names = sorted({after for _, after in found if after is not None})
    if len(names) > MOST_TAGS:
        raise ValueError(f"a corpus may have {MOST_TAGS} tags")
    edges = [None, *names]
    steps = []
    for before in edges:
        total = sum(found.get((before, a), 0) for a in edges) + ADDED * len(edges)
        steps.append([_score(found.get((before, after), 0) + ADDED, total) for after in edges])
    steps[0][0] = IMPOSSIBLE
    if not names:
        return TagModel([], steps, spark.createDataFrame([], "word string, scores array<bigint>"), [])
    words = kept.select(F.inline(F.transform("words", lambda w: F.struct(F.lower(w.word).alias("word"), w.tag.alias("tag")))))
    per_tag = [F.count_if(F.col("tag") == name).alias(f"n{i}") for i, name in enumerate(names)]
    table = words.groupBy("word").agg(*per_tag)
    of_tag = table.agg(F.count(F.lit(1)).alias("words"), *(F.sum(f"n{i}").alias(f"n{i}") for i in range(len(names))), *(
        F.count_if((F.col(f"n{i}") == 1) & (sum((F.col(f"n{j}") for j in range(len(names))), F.lit(0)) == 1)).alias(f"once{i}") for i in range(len(names))
    )).first()
    totals = [of_tag[f"n{i}"] + ADDED * (of_tag.words + 1) for i in range(len(names))]
    unseen = [_score(of_tag[f"once{i}"] + ADDED, totals[i]) for i in range(len(names))]
    scores = [F.round(F.ln((F.col(f"n{i}") + ADDED) / totals[i]) * UNIT).cast("bigint") for i in range(len(names))]
    return TagModel(names, steps, table.select("word", F.array(*scores).alias("scores")), unseen)


def best_tags(scores: Column, model: TagModel) -> Column:
    """The tags of one sentence, from the emission scores of its words: the path of the largest sum.

    Of paths with the same sum the one whose last tag, then the tag before it, and
    so on, comes first in ``model.tags`` is taken. A way is one whole number, its sum
    times 64 and, in the last six bits, 63 less the tag it comes from: the largest
    number is the largest sum, and of equal sums that of the first tag.
    """
    size = len(model.tags) + 1
    # per tag, what each tag before it adds to a way
    into = [
        F.lit([model.steps[i][j] * WAYS + WAYS - 1 - i for i in range(size)]).cast("array<bigint>") for j in range(size)
    ]
    edge = F.lit(IMPOSSIBLE * WAYS).cast("bigint")
    # a sum per place of ``steps``: a sentence begins at its edge, and no word is there
    at_edge = F.lit([0] + [IMPOSSIBLE * WAYS] * (size - 1)).cast("array<bigint>")
    start = F.struct(at_edge.alias("sums"), F.array().cast("array<array<bigint>>").alias("back"))

    def to(sums: Column, after: int) -> Column:
        """The best way to a tag."""
        return F.array_max(F.zip_with(sums, into[after], lambda s, more: s + more))

    def origin(way: Column) -> Column:
        return (WAYS - 1 - way.bitwiseAND(F.lit(WAYS - 1))).cast("int")

    def step(state: Column, word: Column) -> Column:
        def settle(ways: Column) -> Column:
            sums = F.zip_with(ways, word, lambda way, score: way.bitwiseAND(F.lit(-WAYS)) + score * WAYS)
            return F.struct(F.concat(F.array(edge), sums).alias("sums"), F.concat(state.back, F.array(ways)).alias("back"))

        # an array of one, so that the ways are worked out once
        return F.transform(F.array(F.array(*(to(state.sums, j) for j in range(1, size)))), settle)[0]

    def finish(state: Column) -> Column:
        first = F.struct(origin(to(state.sums, 0)).alias("tag"), F.array().cast("array<int>").alias("path"))
        walked = F.aggregate(
            F.reverse(state.back), first,
            lambda at, back: F.struct(origin(F.get(back, at.tag - 1)).alias("tag"), F.concat(at.path, F.array(at.tag)).alias("path")),
        )
        return F.transform(F.reverse(walked.path), lambda t: F.get(F.lit(model.tags), t - 1))

    def whole(found: Column) -> Column:
        return F.when(F.size(found) > 0, F.aggregate(found, start, step, finish)).otherwise(F.array().cast("array<string>"))

    # an array of one, so that the scores are looked up once
    return F.transform(F.array(scores), whole)[0]


def sentence_tagger(model: TagModel, text: str = "review_text", name: str = "tagged_words", max_words: int | None = None) -> Tagger:
    """A DataFrame function that adds the (word, tag) pairs of ``text``, in reading order.

    A vocabulary that ``WordTable`` may hold is a constant in the plan. A larger
    one is joined to the words of each distinct text, with the same result.
    """
    unseen = F.lit(model.unseen).cast("array<bigint>")
    none = F.array().cast(TAGGED)
    if not model.tags:
        return lambda df: df.withColumn(name, none)

    def tag(sentence_words: Column, scores_of: Callable[[Column], Column]) -> Column:
        def one(words: Column) -> Column:
            found = best_tags(F.transform(words, scores_of), model)
            return F.zip_with(words, found, lambda w, t: F.struct(w.alias("word"), t.alias("tag")))

        return F.coalesce(F.flatten(F.transform(sentence_words, one)), none)

    known = collect_words(model.emissions, "scores", max_words)
    if known is None:
        return lambda df: _tag_by_join(df, text, name, model, unseen, none)
    table = WordTable.build(model.emissions.sparkSession, known, "array<bigint>")
    return lambda df: df.withColumn(name, tag(sentences(F.col(text)), lambda w: F.coalesce(table.get(F.lower(w)), unseen)))


def _tag_by_join(df: DataFrame, text: str, name: str, model: TagModel, unseen: Column, none: Column) -> DataFrame:
    """The same for a vocabulary of any size; each distinct text is tagged once."""
    keyed = df.withColumn("_digest", F.sha2(F.col(text), 256))
    texts = keyed.where(F.col("_digest").isNotNull()).groupBy("_digest").agg(F.any_value(text).alias("_text"))
    parts = texts.select("_digest", F.posexplode(sentences(F.col("_text"))).alias("_sentence", "_words"))
    words = parts.select("_digest", "_sentence", F.posexplode("_words").alias("_at", "_word")).withColumn("_lower", F.lower("_word"))
    scored = sliced_join(words, model.emissions.select(F.col("word").alias("_lower"), "scores"), ["_lower"], "left")
    found = F.struct("_at", "_word", F.coalesce("scores", unseen).alias("_scores"))
    whole = scored.groupBy("_digest", "_sentence").agg(F.array_sort(F.collect_list(found)).alias("_words"))
    tags = best_tags(F.transform("_words", lambda w: w["_scores"]), model)
    tagged = whole.select("_digest", "_sentence", F.zip_with("_words", tags, lambda w, t: F.struct(w["_word"].alias("word"), t.alias("tag"))).alias("_pairs"))
    lists = tagged.groupBy("_digest").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_sentence", "_pairs"))), lambda s: s["_pairs"])).alias("_tagged")
    )
    return sliced_join(keyed, lists, ["_digest"], "left").withColumn(name, F.coalesce("_tagged", none)).drop("_digest", "_tagged")


def adjectives_by_sentence(model: TagModel, text: str = "review_text", name: str = "adjective_list", max_words: int | None = None) -> Tagger:
    """A tagger like ``adjective_tagger``, by the model: the words whose tag in their sentence is JJ."""
    tag = sentence_tagger(model, text, "_tagged_words", max_words)
    words = F.transform(F.filter("_tagged_words", lambda w: w.tag == ADJECTIVE), lambda w: w.word)
    return lambda df: tag(df).withColumn(name, words).drop("_tagged_words")
