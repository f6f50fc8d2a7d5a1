import datetime as dt
import math

from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from checks.oracle import STOP_WORDS
from shelfmark.functions import predicates, scalars, text


def one(spark, value, kind, function):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(function(F.col("v"))).first()[0]


def test_author_from_brand(spark):
    author = lambda v: one(spark, v, "string", scalars.author_from_brand)
    assert author("Visit Amazon's Jo Page") == " Jo"
    assert author("Visit Amazon's Page") == ""
    assert author("Visit Amazon's  Page") == " "
    assert author("Acme") == ""
    assert author(None) is None
    assert one(spark, "Visit Amazon's Jo Page", "string", lambda c: scalars.author_from_brand(c, trim=True)) == "Jo"


def test_price_to_float(spark):
    price = lambda v: one(spark, v, "string", scalars.price_to_float)
    assert price("$12.50") == 12.5 and price("12") == 12.0
    assert [price(v) for v in ("$1,234.00", "1 - $2", "", "$$3", None)] == [None] * 5


def test_parse_review_date(spark):
    read = lambda v: one(spark, v, "string", scalars.parse_review_date)
    assert read("2014-05-27T10:20:30") == dt.datetime(2014, 5, 27, 10, 20, 30)
    for other in ("2014-05-27", "2014-05-27T10:20:30.5", "2014-13-01T00:00:00", "n/a", "", None):
        assert read(other) is None


def test_dates_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2014-03-09T02:30:00", 1394332200)], "t string, s long")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = df.select(scalars.parse_review_date(F.col("t")), scalars.epoch_to_timestamp(F.col("s"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row[0] == row[1] == dt.datetime(2014, 3, 9, 2, 30)


def test_strip_nul(spark):
    assert one(spark, "a\x00b\x00", "string", scalars.strip_nul) == "ab"
    assert one(spark, "", "string", scalars.strip_nul) == ""
    assert one(spark, None, "string", scalars.strip_nul) is None


def test_ratings(spark):
    def whole(v):
        return one(spark, v, "double", lambda c: scalars.rating_to_int(scalars.nan_to_null(c)))

    assert [whole(v) for v in (4.7, -4.7, 5.0)] == [4, -4, 5]
    assert whole(math.nan) is None and whole(None) is None


def test_array_mean_int(spark):
    mean = lambda v: one(spark, v, "array<double>", scalars.array_mean_int)
    assert mean([1.0, 2.0, 4.0]) == 2 and mean([-1.0, -2.0]) == -1
    assert mean([]) is None and mean(None) is None


def test_has_zero_or_nan(spark):
    found = lambda v: one(spark, v, "array<double>", scalars.has_zero_or_nan)
    assert found([1.0, 0.0]) and found([math.nan]) and not found([1.0]) and not found([])
    assert found(None) is None


def test_percent_of_nothing_is_null(spark):
    assert one(spark, 0, "long", lambda c: scalars.percent_of(F.lit(1), c)) is None


def test_thousands(spark):
    assert one(spark, 1234567, "long", scalars.thousands) == "1,234,567"


def test_search_takes_wildcards_and_quotes_literally(spark):
    names = ["100%", "O'Brien", "a_b", "axb", "Émile", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")

    def found(query):
        return [r.n for r in df.where(predicates.contains_ignore_case(F.col("n"), query)).collect()]

    assert found("%") == ["100%"] and found("_") == ["a_b"] and found("o'b") == ["O'Brien"]
    assert found("éMILE") == ["Émile"] and found("zz") == [] and found("") == []


def test_pattern_dots_are_wildcards(spark):
    df = spark.createDataFrame([(" George R.R. Martin",), (" George RxRx",), (" george r.r.",)], "n string")
    assert df.where(predicates.matches_pattern(F.col("n"), "George R.R.")).count() == 2


def test_lower_words_equal_the_ml_tokenizer(spark):
    texts = ["A b  C", " lead", "trail \n\n", "", "   ", "one\ttwo\x0bthree", "ÀÉ ß", "x"]
    df = spark.createDataFrame([(v,) for v in texts], "text string")
    both = Tokenizer(inputCol="text", outputCol="theirs").transform(df)
    for row in both.withColumn("ours", text.lower_words(F.col("text"))).collect():
        assert row.ours == row.theirs, row.text
    assert one(spark, None, "string", text.lower_words) is None


def test_stop_words_equal_the_ml_remover(spark):
    df = spark.createDataFrame([(["I", "love", "The", "book", "won't", ""],), ([],)], "words array<string>")
    both = StopWordsRemover(inputCol="words", outputCol="theirs").transform(df)
    ours = text.without_stop_words(F.col("words"), text.english_stop_words())
    assert all(r.ours == r.theirs for r in both.withColumn("ours", ours).collect())


def test_listed_stop_words_are_those_of_spark(spark):
    assert sorted(STOP_WORDS) == sorted(text.english_stop_words())


def test_bare_words(spark):
    bare = lambda v, **k: one(spark, v, "string", lambda c: text.bare_words(c, **k))
    assert bare("  «Well», (it's) -- good! Really?? ") == ["«Well»", "it's", "good", "Really"]
    assert bare("so, :) fine.", keep_short=True) == ["so,", ":)", "fine"]
    assert bare("   ") == [] and bare("") == [] and bare(None) is None


def test_word_table(spark):
    values = {f"w{i}": i for i in range(500)} | {"é\"'\\": -1}
    table = text.WordTable.build(spark, values, "bigint")
    df = spark.createDataFrame([(w,) for w in [*values, "absent", None]], "word string")
    found = {r.word: r.v for r in df.select("word", table.get(F.col("word")).alias("v")).collect()}
    assert found == values | {"absent": None, None: None}


def test_collect_words_refuses_a_large_table(spark, monkeypatch):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 2), (None, 3)], "word string, v long")
    assert text.collect_words(df, "v") == {"a": 0, "b": 2}
    with monkeypatch.context() as patch:
        patch.setattr(text.WordTable, "MAX_WORDS", 1)
        assert text.collect_words(df, "v") is None
    assert text.collect_words(df.union(spark.createDataFrame([("é" * 60, 1)], df.schema)), "v") is None
