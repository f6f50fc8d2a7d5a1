import math

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.functions import pandas_udf

from shelfmark.operators.sentiment import ContextWords, scorer_from, sentiment_scorer
from tests.wordlists import CONTEXT, lexicon


def scores(spark, scorer, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, review_text string")
    return [r.review_sentiment_score for r in scorer(df).orderBy("n").collect()]


def compound(total):
    return round(total / math.sqrt(total * total + 15), 4)


@pytest.fixture(scope="module")
def scorer(spark):
    return sentiment_scorer(lexicon(spark), context=CONTEXT)


# good 2, great 3, bad -2.5
CASES = [
    ("plain", "A good book", 2.0),
    ("case is ignored", "Good book", 2.0),
    ("two words add up", "good, great.", 2.0 + 3.0),
    ("stronger", "A very good book", 2.0 + 0.293),
    ("weaker", "A slightly good book", 2.0 - 0.293),
    ("stronger and negative", "very bad", -2.5 - 0.293),
    ("two places before", "very much good", 2.0 + 0.293 * 0.95),
    ("three places before", "very very much good", 2.0 + 0.293 * 0.95 + 0.293 * 0.9),
    ("too far", "very a b c good", 2.0),
    ("negated", "not good", 2.0 * -0.74),
    ("negated two before", "not a good book", 2.0 * -0.74),
    ("negated three before", "never saw a good book", 2.0 * -0.74),
    ("negation too far", "not a b c good", 2.0),
    ("negated and stronger", "not very good", (2.0 + 0.293) * -0.74),
    ("capitals", "a GOOD book", 2.0 + 0.733),
    ("all capitals say nothing", "A GOOD BOOK", 2.0),
    ("negative capitals", "a BAD book", -2.5 - 0.733),
    ("capital degree word", "a VERY good book", 2.0 + 0.293 + 0.733),
    ("contrast", "good but bad", 2.0 * 0.5 - 2.5 * 1.5),
    ("exclamation", "good!", 2.0 + 0.292),
    ("four exclamations at most", "good !!!!!!", 2.0 + 4 * 0.292),
    ("negative exclamation", "bad!!", -2.5 - 2 * 0.292),
    ("one question mark", "good?", 2.0),
    ("three question marks", "good???", 2.0 + 0.54),
    ("many question marks", "good ?????", 2.0 + 0.96),
    ("emoticon", "book :)", 2.0),
    ("no hit", "plain words here!!!", 0.0),
    ("no words", "   ", 0.0),
]


def test_rules(spark, scorer):
    found = scores(spark, scorer, [text for _, text, _ in CASES])
    wrong = [(name, f, compound(t)) for (name, _, t), f in zip(CASES, found) if abs(f - compound(t)) > 1e-9]
    assert wrong == []


def test_null_and_empty_score_zero(spark, scorer):
    assert scores(spark, scorer, [None, ""]) == [0.0, 0.0]


def test_large_lexicon_is_joined_with_the_same_result(spark, scorer):
    joined = sentiment_scorer(lexicon(spark), context=CONTEXT, max_words=5)
    texts = [text for _, text, _ in CASES] + [None, "", "good", "good"]
    assert scores(spark, joined, texts) == scores(spark, scorer, texts)


def test_context_words_can_be_replaced(spark):
    context = ContextWords(stronger=("uber",), weaker=(), negators=("kein",), contrasts=("aber",))
    scorer = sentiment_scorer(lexicon(spark), context=context)
    found = scores(spark, scorer, ["uber good", "kein good", "good aber bad", "not good"])
    assert found == [compound(2.0 + 0.293), compound(2.0 * -0.74), compound(1.0 - 3.75), compound(2.0)]


@pytest.mark.parametrize("max_words", [None, 1])
def test_decimal_valences_score_like_doubles(spark, scorer, max_words):
    decimals = lexicon(spark).selectExpr("word", "cast(valence as decimal(4,2)) as valence")
    texts = ["good", "not good", "bad!"]
    found = scores(spark, sentiment_scorer(decimals, context=CONTEXT, max_words=max_words), texts)
    assert found == scores(spark, scorer, texts)


def test_an_analyser_of_the_caller_can_score(spark):
    @pandas_udf("double")
    def length_score(texts: pd.Series) -> pd.Series:
        return texts.str.len() / 100

    assert scores(spark, scorer_from(length_score), ["abcd", None]) == [0.04, 0.0]


words = st.sampled_from(["good", "BAD", "not", "very", "but", "book", "!", "??", "great,", ":("])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(words, max_size=40).map(" ".join), min_size=1, max_size=50))
def test_scores_stay_within_bounds(spark, scorer, texts):
    assert all(-1.0 <= s <= 1.0 for s in scores(spark, scorer, texts))


def test_words_are_worked_on_as_arrays_and_not_moved_one_by_one(spark, scorer):
    from checks.compare import plan

    joined = sentiment_scorer(lexicon(spark), context=CONTEXT, max_words=5)
    texts = spark.createDataFrame([("good",)], "review_text string")
    assert "lambdafunction" not in plan(scorer(texts))
    assert "posexplode" not in plan(joined(texts)) and "collect_list" not in plan(joined(texts))


def test_a_text_scores_alike_alone_and_among_others(spark, scorer):
    texts = ["!!", "BAD", " good book\x1cBAD ", "not", "good GOOD book", "good but", " ?! ", "(good) :( x", "but but bad"] * 3
    joined = sentiment_scorer(lexicon(spark), context=CONTEXT, max_words=5)
    alone = [scores(spark, scorer, [text])[0] for text in texts[:9]] * 3
    assert scores(spark, scorer, texts) == alone and scores(spark, joined, texts) == alone
