import datetime as dt

import pytest
from pyspark.ml.feature import CountVectorizer, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.operators import sizing
from shelfmark.operators.sentiment import sentiment_scorer
from shelfmark.operators.topics import count_vectors, fit_topics, topic_mix, topic_terms, topic_words
from shelfmark.operators.words import adjective_tagger
from tests.wordlists import CONTEXT, lexicon, tags
from shelfmark.plans import catalog, dashboard, marts, reviews

PAGE = "Visit Amazon's {} Page"
RAW_CATALOG = [
    ("1", PAGE.format("Jo"), "$12.50", "Old"),
    ("1", PAGE.format("Jo"), "12", "New"),
    ("2", "Acme", "$1", "No author"),
    ("3", None, "$1", "No brand"),
    ("4", PAGE.format(""), "$1", "Blank author"),
    ("5", PAGE.format("Al"), "$1,234.00", "Thousands"),
    ("6", PAGE.format("Al"), "$1 - $2", "Range"),
    ("7", PAGE.format("Al"), "", "Empty price"),
    ("8", PAGE.format("Al"), None, "No price"),
    ("9", PAGE.format("Al"), "3", None),
    (None, PAGE.format("Al"), "3", "No item"),
    ("10", PAGE.format("Al"), "7.25", "Fine"),
]


@pytest.fixture
def clean(spark):
    return catalog.clean_catalog(spark.createDataFrame(RAW_CATALOG, schemas.RAW_CATALOG))


def test_clean_catalog(clean, rows):
    assert rows(clean) == [("1", " Jo", 12.0, "New"), ("10", " Al", 7.25, "Fine"), ("4", " ", 1.0, "Blank author")]
    assert clean.schema == schemas.CATALOG


def test_normalised_reviews(spark, rows):
    raw = [("1", 4.9, "text", 1401148800), ("2", float("nan"), None, None), (None, None, "", 0)]
    found = reviews.normalise_reviews(spark.createDataFrame(raw, schemas.RAW_REVIEW))
    assert found.schema == schemas.REVIEW_BATCH
    assert rows(found) == sorted(
        [
            ("1", "2014-05-27T00:00:00", 4, "text"),
            ("2", None, None, None),
            (None, "1970-01-01T00:00:00", None, ""),
        ],
        key=repr,
    )
    assert reviews.normalise_reviews(spark.createDataFrame([], schemas.RAW_REVIEW)).count() == 0


BATCH = [
    ("1", "2014-05-27T00:00:00", 5, "good\x00 book"),
    ("1", "2014-05-27", 4, "bad"),
    ("10", "2015-01-01T00:00:00.5", 3, "plain"),
    ("404", "2014-05-27T00:00:00", 5, "not in the catalog"),
    ("1", "2014-05-27T00:00:00", 5, ""),
    ("1", "2014-05-27T00:00:00", 5, None),
    ("1", None, 5, "no date"),
    ("1", "2014-05-27T00:00:00", None, "no rating"),
    (None, "2014-05-27T00:00:00", 5, "no item"),
]


@pytest.fixture
def enriched(spark, clean):
    batch = spark.createDataFrame(BATCH, schemas.REVIEW_BATCH)
    return reviews.enrich_reviews(batch, clean, sentiment_scorer(lexicon(spark), context=CONTEXT))


def test_enriched_reviews(enriched):
    assert [(f.name, f.dataType) for f in enriched.schema] == [(f.name, f.dataType) for f in schemas.ENRICHED][1:]
    rows = enriched.collect()
    found = [(r.asin, r.author, r.title, r.review_date, r.rating, r.review_text) for r in rows if r.review_date]
    assert found == [("1", " Jo", "New", dt.datetime(2014, 5, 27), 5, "good book")]
    unread = sorted((r.asin, r.rating, r.review_text) for r in rows if not r.review_date)
    assert unread == [("1", 4, "bad"), ("10", 3, "plain")]
    # the score is taken from the text as it came, in which the NUL belongs to the word
    assert {r.rating: round(r.review_sentiment_score, 4) for r in enriched.collect()} == {5: 0.0, 4: -0.5423, 3: 0.0}


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_a_catalog_that_grows_is_read_for_each_batch(spark, clean, tmp_path, monkeypatch, broadcast_rows):
    """Both join paths; the items that arrive between two batches are found."""
    monkeypatch.setattr(sizing.fits_broadcast, "__defaults__", (broadcast_rows, sizing.BROADCAST_BYTES))
    path, batch = str(tmp_path / "items"), spark.createDataFrame(BATCH, schemas.REVIEW_BATCH)
    clean.where("asin = '1'").write.parquet(path)
    enrich = reviews.review_enricher(lambda: spark.read.parquet(path), sentiment_scorer(lexicon(spark), context=CONTEXT))
    assert {r.asin for r in enrich(batch).collect()} == {"1"}
    clean.where("asin = '10'").write.mode("append").parquet(path)
    assert {r.asin for r in enrich(batch).collect()} == {"1", "10"}


def test_columns_besides_the_batch_stay(spark, clean):
    batch = spark.createDataFrame(BATCH, schemas.REVIEW_BATCH).withColumn("review_id", F.lit(7))
    found = reviews.enrich_reviews(batch, clean, sentiment_scorer(lexicon(spark), context=CONTEXT))
    assert found.columns == schemas.ENRICHED.names


def test_search_by_row_and_by_table_agree(enriched, rows):
    by_row = dashboard.search_yearly(enriched, "author", "jO")
    tables = marts.rating_per_year(enriched, "author"), marts.sentiment_per_year(enriched, "author")
    by_table = dashboard.search_yearly_tables(*tables, "author", "jO")
    assert rows(by_row) == rows(by_table.select(by_row.columns)) and by_row.count() == 2
    assert dashboard.search_yearly(enriched, "author", "").count() == 0


def test_top_lists(enriched):
    assert [r.author for r in dashboard.authors_with_most_ratings(enriched).collect()] == [" Jo", " Al"]
    assert [r.title for r in dashboard.books_with_most_ratings(enriched, 1).collect()] == ["New"]
    for rows in (0, 501):
        with pytest.raises(ValueError):
            dashboard.authors_with_most_ratings(enriched, rows)


def test_word_cloud(spark, enriched):
    counts = marts.word_counts(enriched, adjective_tagger(tags(spark)), ["author", "title", "year"])
    cloud = dashboard.word_cloud(counts, "title", "NEW")
    assert sorted((r.word, r.word_count, r.weight) for r in cloud.collect()) == [("bad", 1, 1.0), ("good", 1, 1.0)]


def test_vocabulary_equals_that_of_the_ml_counter(spark):
    texts = ["the red apple", "green apple tree", "red apple apple", "tree", ""]
    df = spark.createDataFrame([(v,) for v in texts], "review_text string")
    ours, vectors = count_vectors(df, "review_text", 100, 2)
    tokens = Tokenizer(inputCol="review_text", outputCol="words").transform(df)
    kept = StopWordsRemover(inputCol="words", outputCol="kept").transform(tokens)
    theirs = CountVectorizer(inputCol="kept", outputCol="features", minDF=2.0).fit(kept)
    assert sorted(ours.vocabulary) == sorted(theirs.vocabulary) == ["apple", "red", "tree"]
    assert ours.vocabulary == ["apple", "red", "tree"]
    counted = [r.features.toArray().tolist() for r in vectors.collect()]
    assert counted == [[1, 1, 0], [1, 0, 1], [2, 1, 0], [0, 0, 1], [0, 0, 0]]


def test_topics(spark):
    texts = ["red apple green apple pear", "goal ball team goal score", "apple pear plum", "team ball match"] * 10
    df = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "review_id long, review_text string")
    model = fit_topics(df, topics=2, iterations=5)
    terms = topic_terms(model, 3).orderBy("topic", "rank").collect()
    assert [(r.topic, r["rank"]) for r in terms] == [(t, n) for t in (0, 1) for n in (1, 2, 3)]
    for topic in (0, 1):
        weights = [r.weight for r in terms if r.topic == topic]
        assert weights == sorted(weights, reverse=True)
    names = model.counter.vocabulary
    by_topic = {r.topic: r.words for r in topic_words(model, 3).collect()}
    assert by_topic == {t: [names[r.term_index] for r in terms if r.topic == t] for t in (0, 1)}
    mixes = topic_mix(model).collect()
    assert len(mixes) == 40 and all(abs(sum(r.topic_distribution) - 1) < 1e-6 for r in mixes)
    again = topic_terms(fit_topics(df, topics=2, iterations=5), 3).orderBy("topic", "rank").collect()
    assert [r.term_index for r in again] == [r.term_index for r in terms]
