from collections import Counter

from pyspark.sql import functions as F

from shelfmark.functions.text import lower_words
from shelfmark.operators import words

TAGS = [("good", "JJ"), ("old", "JJ"), ("better", "JJR"), ("book", "NN")]
REVIEWS = [
    (1, "a", "t", 2014, "A Good, old book!"),
    (2, "a", "t", 2014, "better"),
    (3, "a", "t", 2014, "OLD good good"),
    (4, "a", "u", None, None),
    (5, None, "u", None, "good"),
]
SCHEMA = "review_id long, author string, title string, year int, review_text string"


def tagged(spark, max_words=None):
    tag = words.adjective_tagger(spark.createDataFrame(TAGS, "word string, tag string"), max_words=max_words)
    return tag(spark.createDataFrame(REVIEWS, SCHEMA))


def test_only_plain_adjectives_in_reading_order(spark):
    found = {r.review_id: r.adjective_list for r in tagged(spark).collect()}
    assert found == {1: ["Good", "old"], 2: [], 3: ["OLD", "good", "good"], 4: [], 5: ["good"]}


def test_large_dictionary_is_joined_with_the_same_result(spark):
    here = {r.review_id: r.adjective_list for r in tagged(spark).collect()}
    assert {r.review_id: r.adjective_list for r in tagged(spark, max_words=1).collect()} == here


def test_a_tagger_of_the_caller_can_be_used(spark):
    tag = words.tagger_from(lambda text: F.filter(F.split(text, " "), lambda w: w.startswith("g")))
    found = tag(spark.createDataFrame(REVIEWS, SCHEMA)).orderBy("review_id").collect()
    assert [r.adjective_list for r in found] == [[], [], ["good", "good"], [], ["good"]]


def test_adjective_text_skips_reviews_without_any(spark, rows):
    found = words.adjective_strings(tagged(spark), ["author", "title", "year"])
    assert rows(found) == sorted(
        [("a", "t", 2014, 0, "Good old OLD good good"), ("a", "u", None, 0, ""), (None, "u", None, 0, "good")],
        key=repr,
    )


def test_parts_are_numbered_in_reading_order(spark):
    many = spark.range(2000).repartition(7).select(
        F.col("id").alias("review_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 400)).alias("author"),
        F.array(F.concat(F.lit("w"), F.col("id").cast("string"))).alias("adjective_list"),
    )
    found = words.adjective_strings(many, ["author"], rows_per_part=10).collect()
    for author in {r.author for r in found}:
        ids = [i for i in range(2000) if author == ("hot" if i % 3 == 0 else f"k{i % 400}")]
        parts = sorted((r.part, r.adjectives) for r in found if r.author == author)
        assert parts == [(p, " ".join(f"w{i}" for i in ids[10 * p : 10 * p + 10])) for p in range(-(-len(ids) // 10))]


def test_counts_roll_up(spark, rows):
    counts = words.adjective_counts(tagged(spark), ["author", "title", "year"])
    assert rows(words.roll_up(counts, ["author"])) == rows(words.adjective_counts(tagged(spark), ["author"]))


def test_counts_agree_with_the_text(spark):
    keys = ["author", "title", "year"]
    counted = Counter()
    for r in words.adjective_counts(tagged(spark), keys).collect():
        counted[(r.author, r.title, r.year, r.word)] += r.word_count
    written = Counter(
        (r.author, r.title, r.year, w.lower())
        for r in words.adjective_strings(tagged(spark), keys).collect()
        for w in r.adjectives.split()
    )
    assert counted == written


def test_word_weights(spark):
    counts = spark.createDataFrame([("x", 2), ("y", 3), ("x", 4), ("z", 3)], "word string, word_count long")
    assert [tuple(r) for r in words.word_weights(counts, 2).collect()] == [("x", 6, 1.0), ("y", 3, 0.5)]
    assert words.word_weights(counts).count() == 3


def test_bag_of_words(spark, rows):
    df = spark.createDataFrame([("b a b",), ("A",), ("",), (None,), ("  ",)], "text string")
    found = words.bag_of_words(df, lower_words(F.col("text")))
    # an empty text has one empty word and a blank one has none, as in the ML tokenizer
    assert rows(found) == [("", 1, 1), ("a", 2, 2), ("b", 2, 1)]
    assert rows(words.vocabulary(found, 10, 2)) == [("a", 2, 2)]
    assert [r.word for r in words.vocabulary(found, 2, 1).collect()] == ["a", "b"]


def test_words_are_split_and_counted_as_the_columns_do(spark, rows):
    texts = ["a  b a", " a", "", "   ", "b \t\n", "c\u00a0d \u0130x", None, "a\x0bb\fc\rd\x1ce"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    expected = rows(words.bag_of_words(df, lower_words(F.col("text"))))
    assert rows(words.bag_of_lower_words(df, "text")) == expected
    assert rows(words.bag_of_lower_words(df, "text", flush_at=1)) == expected
