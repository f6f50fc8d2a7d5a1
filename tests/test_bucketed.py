"""Tables laid out for their join."""

import pytest
from pyspark.sql import functions as F

from checks.compare import plan
from shelfmark.sources import bucketed


@pytest.fixture
def reviews(spark):
    """A third of all rows has one item; some rows have none."""
    i = F.col("id")
    item = F.when(i % 3 == 0, "hot").when(i % 11 != 0, F.concat(F.lit("i"), (i % 50).cast("string")))
    return spark.range(3_000).repartition(6).select(item.alias("asin"), i.alias("review_id"))


@pytest.fixture
def items(spark):
    i = F.concat(F.lit("i"), F.col("id").cast("string"))
    made = spark.range(40).select(i.alias("asin"), F.lit("title").alias("title"))
    return made.unionByName(spark.createDataFrame([("hot", "best"), (None, "none")], "asin string, title string"))


@pytest.mark.parametrize("rows_per_slice", [100, 1_000_000])
def test_the_join_is_whole_and_moves_no_row(spark, reviews, items, rows, rows_per_slice):
    large = bucketed.lay_out(reviews, "asin", 4, rows_per_slice)
    small = bucketed.lay_out(items, "asin", 4)
    joined = bucketed.bucketed_join(large, small, spark)
    assert rows(joined) == rows(reviews.join(items, "asin"))
    text = plan(joined)
    assert "hashpartitioning" not in text and "Exchange SinglePartition" not in text
    assert text.count("Bucketed: true") >= 2 and "SortMergeJoin" in text


def test_a_hot_item_is_written_by_several_tasks(spark, reviews):
    def files_per_bucket(table):
        names = [f.rsplit("_", 1)[1] for f in table.rows(spark).inputFiles()]
        return sorted(names.count(n) for n in set(names))

    assert files_per_bucket(bucketed.lay_out(reviews, "asin", 4)) == [1, 1, 1, 1]
    split = bucketed.lay_out(reviews, "asin", 4, rows_per_slice=100)
    assert files_per_bucket(split)[-1] > 3 and [r.asin for r in split.hot.collect()] == ["hot"]


def test_tables_must_agree(spark, reviews, items):
    with pytest.raises(ValueError, match="same key"):
        bucketed.bucketed_join(bucketed.lay_out(reviews, "asin", 4), bucketed.lay_out(items, "asin", 8), spark)


def test_empty_sides(spark, reviews, items):
    none = bucketed.lay_out(reviews.limit(0), "asin", 4)
    assert bucketed.bucketed_join(none, bucketed.lay_out(items, "asin", 4), spark).collect() == []
