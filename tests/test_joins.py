import pytest
from pyspark.sql import functions as F

from checks.compare import plan
from shelfmark.operators import joins, sizing


@pytest.fixture
def skewed(spark):
    """A third of the rows on one item, all alike; some without an item."""
    n = F.col("id")
    item = F.when(n % 3 == 0, "hot").when(n % 50 == 1, None).otherwise(F.concat(F.lit("i"), n % 200))
    return spark.range(0, 6000, 1, 6).select(item.alias("asin"), (n % 3 == 0).alias("alike"))


@pytest.fixture
def catalog(spark):
    names = [("hot", "H")] + [(f"i{k}", f"T{k}") for k in range(150)] + [("unused", "U"), (None, "N")]
    return spark.createDataFrame(names, "asin string, title string")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_sliced_join_equals_a_plain_join(skewed, catalog, rows, how):
    sliced = joins.sliced_join(skewed, catalog, ["asin"], how, rows_per_slice=100)
    assert rows(sliced) == rows(skewed.join(catalog, "asin", how))


def test_keys_may_be_sized_from_another_table(skewed, catalog, rows):
    few = skewed.where("not alike")
    sliced = joins.sliced_join(few, catalog, ["asin"], rows_per_slice=100, sizes_from=skewed)
    assert rows(sliced) == rows(few.join(catalog, "asin"))
    assert rows(joins.lookup_join(few, catalog, ["asin"], sizes_from=skewed)) == rows(sliced)


def test_copies_of_one_row_are_spread(skewed):
    hot = sizing.hot_keys(skewed, ["asin"], rows_per_slice=100)
    spread = sizing.add_slices(skewed, ["asin"], hot).withColumn("slice", sizing.slice_of("asin", "alike"))
    used = spread.where("asin = 'hot'").select("slice").distinct().count()
    assert used > 1


def test_every_key_above_the_bound_is_hot(spark, rows):
    """However many they are, and with a bound that does not grow with the table."""
    df = spark.range(36_000).select((F.col("id") % 12_000).alias("k"))
    hot = sizing.hot_keys(df, ["k"], rows_per_slice=2)
    assert hot.count() == 12_000 and hot.agg(F.max("_slices")).first()[0] == 2
    assert sizing.hot_keys(df, ["k"], rows_per_slice=3) is None
    assert sizing.hot_keys(df.limit(0), ["k"]) is None
    few = df.distinct().withColumn("name", F.col("k") * 2)
    assert joins.sliced_join(df, few, ["k"], rows_per_slice=2).count() == 36_000


def test_hot_keys_from_a_sample(spark, monkeypatch):
    df = spark.range(100_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    monkeypatch.setattr(sizing, "SAMPLED_PER_HOT_KEY", 100)
    found = [tuple(r) for r in sizing.hot_keys(df, ["k"], rows_per_slice=1000).collect()]
    assert len(found) == 1 and found[0][0] == -1 and 30 <= found[0][1] <= 38


def test_rows_without_a_key_are_not_moved_or_spread(skewed, catalog):
    assert "isnotnull(asin" in plan(joins.sliced_join(skewed, catalog, ["asin"], "inner"))
    kept = joins.sliced_join(skewed, catalog, ["asin"], "left_anti")
    assert kept.where("asin is null").count() == skewed.where("asin is null").count()


@pytest.mark.parametrize("kind", ["array<string>", "struct<a:string>", "map<string,string>", "binary"])
def test_nested_values_are_measured(spark, kind):
    text = F.repeat(F.lit("x"), 1000)
    value = {"a": F.array(text, text), "s": F.struct(text.alias("a")), "m": F.create_map(F.lit("k"), text), "b": text.cast("binary")}
    df = spark.range(100).select("id", value[kind[0]].alias("v"))
    assert sizing.fits_broadcast(df) and not sizing.fits_broadcast(df, max_bytes=50_000)


def test_fits_broadcast_measures_rows_and_bytes(catalog):
    assert sizing.fits_broadcast(catalog)
    assert not sizing.fits_broadcast(catalog, max_rows=100)
    assert not sizing.fits_broadcast(catalog, max_bytes=100)
    assert sizing.fits_broadcast(catalog.limit(0))


def test_lookup_join_beyond_the_bound(skewed, catalog, rows, monkeypatch):
    broadcast = rows(joins.lookup_join(skewed, catalog, ["asin"]))
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    assert rows(joins.lookup_join(skewed, catalog, ["asin"])) == broadcast


def test_joined_and_unmatched_rows_make_the_input(skewed, catalog):
    kept = joins.lookup_join(skewed, catalog, ["asin"]).count()
    lost = joins.lookup_join(skewed, catalog, ["asin"], "left_anti").count()
    assert kept + lost == skewed.count()


def test_restrict_to_keys(skewed, catalog):
    kept = joins.restrict_to_keys(catalog, skewed, "asin")
    assert kept.count() == len({r.asin for r in catalog.collect()} & {r.asin for r in skewed.collect()} - {None})


def test_missing_keys_match_in_the_null_safe_join(spark, rows):
    left = spark.createDataFrame([("a", None, 1), (None, 2, 2), ("b", 1, 3)], "g string, y int, l int")
    right = spark.createDataFrame([("a", None, 7), (None, 2, 8), ("c", 1, 9)], "g string, y int, r int")
    assert rows(joins.join_null_safe(left, right, ["g", "y"])) == [("a", None, 1, 7), (None, 2, 2, 8)]
