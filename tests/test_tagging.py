"""The sentence tagger against a brute force over all tag sequences."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from checks.compare import plan
from shelfmark.bindings import Tables
from shelfmark.operators import tagging

CORPUS = [
    [("The", "DT"), ("light", "JJ"), ("bag", "NN")],
    [("the", "DT"), ("light", "NN"), ("glows", "VB")],
    [("A", "DT"), ("kind", "JJ"), ("man", "NN"), ("glows", "VB")],
    [("a", "DT"), ("kind", "NN"), ("of", "IN"), ("bag", "NN")],
    [("one", "DT"), ("light", "JJ"), ("light", "NN"), ("glows", "VB"), (None, "NN"), ("x", None)],
    [],
    None,
]


@pytest.fixture(scope="module")
def model(spark):
    corpus = spark.createDataFrame([(c, 1) for c in CORPUS], f"tagged {tagging.TAGGED}, word int")
    return tagging.learn_tags(corpus)


def brute_force(words, model, emissions):
    """The best sequence of all, ties by the last tag, then the one before it."""
    size = len(model.tags)

    def total(path):
        steps = [0, *(t + 1 for t in path), 0]
        score = sum(model.steps[a][b] for a, b in zip(steps, steps[1:]))
        return score + sum(emissions.get(w.lower(), model.unseen)[t] for w, t in zip(words, path))

    best = max(itertools.product(range(size), repeat=len(words)), key=lambda p: (total(p), [-t for t in reversed(p)]))
    return [model.tags[t] for t in best]


def test_counts_become_scores(spark, model):
    assert model.tags == ["DT", "IN", "JJ", "NN", "VB"] and len(model.steps) == 6
    after_determiner = dict(zip(["", *model.tags], model.steps[1]))
    assert after_determiner["JJ"] > after_determiner["NN"] > after_determiner["VB"] == after_determiner[""]
    words = {r.word: r.scores for r in model.emissions.collect()}
    assert set(words) == {"the", "light", "bag", "glows", "a", "kind", "man", "of", "one"}
    assert words["light"][2] > words["light"][1] and max(model.unseen) > max(min(w) for w in words.values())


@pytest.mark.parametrize("max_words", [None, 0])
def test_tags_equal_a_brute_force_over_all_sequences(spark, model, max_words):
    rng = random.Random(3)
    vocabulary = ["the", "Light", "bag", "glows", "a", "kind", "man", "of", "one", "new", "Unseen"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 6))) + "." for _ in range(60)]
    texts += ["The light glows. A kind man! of the kind? the", "", None, " . ! ", "x" * 3_000, "the light light light"]
    table = spark.createDataFrame(list(enumerate(texts)) * 2, "n int, review_text string")
    emissions = {r.word: r.scores for r in model.emissions.collect()}
    split = {r.n: r.s for r in table.select("n", tagging.sentences(F.col("review_text")).alias("s")).collect()}
    for r in tagging.sentence_tagger(model, max_words=max_words)(table).collect():
        expected = [pair for words in split[r.n] or [] for pair in zip(words, brute_force(words, model, emissions))]
        assert [tuple(p) for p in r.tagged_words] == expected, r.review_text


def test_one_word_is_tagged_by_its_sentence(spark, model):
    table = spark.createDataFrame([("The light bag. The light glows.",)], "review_text string")
    (row,) = tagging.adjectives_by_sentence(model)(table).collect()
    assert row.adjective_list == ["light"]
    tagged = [tuple(p) for p in tagging.sentence_tagger(model)(table).first().tagged_words]
    assert [t for w, t in tagged if w == "light"] == ["JJ", "NN"]


def test_sentences_are_cut_after_their_marks_and_when_too_long(spark):
    texts = ["One two.Three four. Five! ", "a " * 5, "?!  x", "", None, "dots... more\n\nlines"]
    table = spark.createDataFrame([(t,) for t in texts], "t string").select(tagging.sentences(F.col("t"), 2).alias("s"))
    assert [r.s for r in table.collect()] == [
        [["One", "two.Three"], ["four"], ["Five"]], [["a", "a"], ["a", "a"], ["a"]], [["x"]], [], None, [["dots"], ["more", "lines"]]
    ]


def test_tagging_does_not_shuffle_or_run_python(spark, model):
    table = spark.createDataFrame([("a",)], "review_text string")
    text = plan(tagging.adjectives_by_sentence(model)(table))
    assert "Exchange" not in text and "Python" not in text and "Generate" not in text


def test_an_empty_corpus_tags_nothing(spark):
    model = tagging.learn_tags(spark.createDataFrame([], f"tagged {tagging.TAGGED}"))
    table = spark.createDataFrame([("some words",)], "review_text string")
    assert model.tags == [] and tagging.sentence_tagger(model)(table).first().tagged_words == []


def test_a_single_tag(spark):
    corpus = spark.createDataFrame([([("a", "JJ"), ("b", "JJ")],)], f"tagged {tagging.TAGGED}")
    table = spark.createDataFrame([("b c a. d",)], "review_text string")
    found = tagging.adjectives_by_sentence(tagging.learn_tags(corpus))(table).first()
    assert found.adjective_list == ["b", "c", "a", "d"]


def test_the_model_learns_the_rule_of_its_corpus(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    corpus = t.tagged_sentences()
    model = tagging.learn_tags(corpus)
    assert model.tags == ["DT", "JJ", "NN", "VB"]
    words = F.transform("tagged", lambda w: w.word)
    texts = corpus.select(F.array_join(words, " ").alias("review_text"), "tagged")
    tagged = tagging.sentence_tagger(model)(texts)
    same = F.zip_with("tagged", "tagged_words", lambda given, found: given.tag == found.tag)
    shares = tagged.select(F.explode(same).alias("same")).agg(F.avg(F.col("same").cast("int")))
    assert shares.first()[0] > 0.85


def test_the_words_of_a_sentence_are_scored_once(spark, model):
    """Emission scores are looked up in the plan once, and a way of a tag is a number, not a struct per pair of tags."""
    text = plan(spark.range(1).select(tagging.best_tags(F.expr("transform(sequence(1, 3), x -> array(id, 0L, 0L, 0L, 0L))"), model).alias("t")))
    assert text.count("sequence(1, 3") <= 1 and "named_struct(sum" not in text


def test_equal_sums_and_many_tags(spark):
    """All scores alike: the first tag everywhere; 60 tags still fit the bits of a way."""
    for size in (1, 3, 60):
        names = [f"t{i:02}" for i in range(size)]
        steps = [[tagging.IMPOSSIBLE if i == j == 0 else -5 for j in range(size + 1)] for i in range(size + 1)]
        flat = tagging.TagModel(names, steps, None, [])
        scores = F.array(*(F.lit([-7] * size).cast("array<bigint>") for _ in range(4)))
        last = F.array(*(F.lit([-7] * (size - 1) + [-6]).cast("array<bigint>") for _ in range(4)))
        row = spark.range(1).select(tagging.best_tags(scores, flat).alias("a"), tagging.best_tags(last, flat).alias("b")).first()
        assert row.a == names[:1] * 4 and row.b == names[-1:] * 4
