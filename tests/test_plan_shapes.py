"""What the physical plans must and must not hold, whatever the results."""

import pytest
from pyspark.sql import functions as F

from checks.compare import plan
from shelfmark.bindings import Tables
from shelfmark.operators import aggregates, joins, ranking, words
from shelfmark.plans import dashboard, marts, reviews
from shelfmark.sources import tables


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Enriched reviews in a table of as many files as there are cores."""
    path = str(tmp_path_factory.mktemp("reviews") / "enriched")
    t = Tables(spark, "/root/testdata/sf0.001")
    enriched = reviews.enrich_reviews(t.review_batch(), t.catalog(), t.scorer())
    enriched.repartition(8).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def bound(spark):
    return Tables(spark, "/root/testdata/sf0.001")


def test_scoring_and_tagging_do_not_shuffle(stored, bound):
    scored = bound.scorer()(stored.drop("review_sentiment_score"))
    assert "Exchange" not in plan(scored) and "Generate" not in plan(scored)
    assert "Exchange" not in plan(bound.tagger()(stored))


def test_enriching_shuffles_no_review(stored, bound):
    enrich = reviews.review_enricher(bound.catalog().limit(0).unionByName(bound.catalog()), bound.scorer())
    text = plan(enrich(stored.select("asin", F.lit("d").alias("review_date"), "rating", "review_text")))
    above_join, large_side = text.split("BroadcastHashJoin")[:2]
    assert "Exchange" not in above_join and large_side.index("FileScan") < large_side.index("Exchange")


def test_yearly_averages_read_three_columns_and_combine_first(stored):
    text = plan(marts.rating_per_year(stored, "author"))
    assert "ReadSchema: struct<author:string,review_date:timestamp_ntz,rating:int>" in text
    assert text.count("Exchange") == 1 and "partial_avg" in text.split("Exchange")[1]


def test_both_averages_need_one_pass(stored):
    text = plan(marts.rating_and_sentiment_per_year(stored, "title"))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_searches_filter_before_anything_else(stored, bound):
    text = plan(dashboard.search_yearly(stored, "author", "brand"))
    assert text.index("HashAggregate") < text.index("Exchange") < text.index("Filter") < text.index("FileScan")
    assert "review_text" not in text


def test_exact_match_is_pushed_to_the_scan(stored):
    assert "EqualTo(title,small ring)" in plan(stored.where(F.col("title") == "small ring"))


def test_a_page_after_a_key_is_pushed_to_the_scan(stored):
    text = plan(tables.page_after(stored.select("review_id", "title"), "review_id", 50, 10))
    assert "GreaterThan(review_id,50)" in text and "TakeOrderedAndProject" in text and "Exchange" not in text


@pytest.mark.parametrize("page", [dashboard.authors_with_most_ratings, dashboard.books_with_most_ratings])
def test_top_lists_do_not_sort_everything(stored, page):
    text = plan(page(stored))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_shares_do_not_sort_everything(stored):
    counts = aggregates.rows_per_group(stored, "author")
    text = plan(ranking.shares_with_others(counts, "author", "row_count"))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_word_counts_combine_before_the_shuffle(stored, bound):
    text = plan(words.word_weights(marts.word_counts(stored, bound.tagger(), []), 10))
    assert text.count("Generate explode") == 2  # the counts and their largest one, which share a shuffle
    assert "partial_count" in text and "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_distinct_pairs_are_counted_in_two_steps(stored):
    text = plan(aggregates.distinct_per_group(stored, "author", "asin", "n"))
    assert text.count("hashpartitioning") == 2 and "partial_count" in text


def test_a_sliced_join_shuffles_by_key_and_slice(stored):
    few = stored.select("author", F.upper("author").alias("shown")).distinct()
    hot = joins.sliced_join(stored, few, ["author"], rows_per_slice=1)
    assert "_slice" in plan(hot)
    plain = joins.sliced_join(stored, few, ["author"])
    assert "_slice" not in plan(plain)


def test_word_clouds_read_no_text(spark, stored, bound, tmp_path):
    marts.word_counts(stored, bound.tagger(), ["author", "title", "year"]).write.parquet(str(tmp_path / "mart"))
    text = plan(dashboard.word_cloud(spark.read.parquet(str(tmp_path / "mart")), "author", "brand", top=10))
    assert "review_text" not in text and "ReadSchema: struct<author:string,word:string,word_count:bigint>" in text
