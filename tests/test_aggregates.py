import math

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import aggregates, keys, profile, ranking
from shelfmark.plans import workouts


def test_distinct_count_counts_null_once(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "v string")
    assert df.agg(aggregates.distinct_count("v")).first()[0] == 2
    assert df.where("v = 'a'").agg(aggregates.distinct_count("v")).first()[0] == 1
    assert df.limit(0).agg(aggregates.distinct_count("v")).first()[0] == 0


def test_approximate_distinct_count(spark):
    found = spark.range(10_000).agg(aggregates.approx_distinct("id")).first()[0]
    assert abs(found - 10_000) < 1500


def test_first_per_key_is_repeatable(spark, rows):
    df = spark.createDataFrame(
        [("k", "b", 1.0), ("k", "a", 9.0), ("k", "a", 2.0), ("j", None, None)], "asin string, title string, price float"
    )
    expected = [("j", None, None), ("k", "a", 2.0)]
    for partitions in (1, 3):
        assert rows(aggregates.first_per_key(df.repartition(partitions), "asin", ["title", "price"])) == expected


def test_unread_dates_form_their_own_year(spark, rows):
    rated = [("x", "2014-01-01", 1), ("x", None, 4), ("x", None, 5)]
    df = spark.createDataFrame(rated, "author string, d string, rating int")
    dated = df.withColumn("review_date", F.col("d").cast("timestamp_ntz"))
    assert rows(aggregates.yearly_averages(dated, "author", {"rating": "avg_rating"})) == [
        ("x", 2014, 1.0),
        ("x", None, 4.5),
    ]


def test_sum_numeric_leaves_text_out(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("b", 2, None)], "s string, i int, d double")
    found = aggregates.sum_numeric(df)
    assert found.columns == ["i", "d"] and tuple(found.first()) == (3, 0.5)


@pytest.mark.parametrize("groups", [0, 1, 4, 9])
def test_shares_sum_to_a_hundred(spark, groups):
    counts = spark.createDataFrame([(f"g{i}", i + 1) for i in range(groups)], "g string, n long")
    found = ranking.shares_with_others(counts, "g", "n").collect()
    assert len(found) == min(groups, 5) + 1 and found[-1].g == "others"
    assert math.isclose(sum(r.percentage for r in found), 100.0)
    assert sum(r.n for r in found) == groups * (groups + 1) // 2


def test_ties_are_in_key_order(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "k string, n long")
    assert [r.k for r in ranking.top_k(df, "n", "k", 2).collect()] == ["c", "a"]
    assert [r.k for r in ranking.order_by_count(df, "n", "k").collect()] == ["c", "a", "b"]


WORKOUTS = [
    (1, 10, "run", "male", [1.0, 2.0], [0.0, 3.0], list(range(49))),
    (2, 10, "run", "male", [3.0], [math.nan], list(range(50))),
    (3, 11, "bike", "female", [], [1.0], []),
    (4, 12, "bike", None, None, None, None),
    (5, None, "row", None, [5.0, 6.0], [2.0], [1]),
]
SCHEMA = (
    "id long, userId long, sport string, gender string, heart_rate array<double>, altitude array<double>,"
    " timestamp array<long>"
)


@pytest.fixture
def logs(spark):
    return workouts.with_record_count(spark.createDataFrame(WORKOUTS, SCHEMA))


def test_size_summary_leaves_null_arrays_out(logs):
    found = profile.size_summary(logs, "per_workout_record_count", 50).first()
    assert found.asDict() == {
        "count": 3, "mean": 16, "std": 28, "min": 0, "25%": 0, "50%": 1, "75%": 25, "max": 49,
    }


def test_missing_counts_follow_the_kind(logs):
    found = profile.missing_counts(logs, ["gender"], ["id", "userId"], ["altitude"]).first()
    assert found.asDict() == {"gender": 2, "id": 0, "userId": 1, "altitude_zero_or_nan": 2, "altitude_null_array": 1}


def test_totals_and_genders(logs, rows):
    assert tuple(profile.workout_totals(logs).first()) == (4, 3, 5, 100)
    expected = [("female", 1, 1), ("male", 1, 2), (None, 2, 2)]
    assert rows(profile.users_and_workouts_by_gender(logs)) == expected
    assert rows(profile.users_joined_to_workouts(logs)) == expected


def test_mean_heart_rates_per_sport(logs):
    found = [tuple(r) for r in workouts.sports_by_mean_heart_rates(logs).collect()]
    assert found == [("run", 2, 2.0), ("bike", 1, None), ("row", 1, 5.0)]


def test_top_sports_count_a_user_once_per_sport(logs):
    found = [(r.sport, r.users_count, r.percentage) for r in workouts.top_sports_with_others(logs, 1).collect()]
    assert found == [("bike", 2, 50.0), ("others", 2, 50.0)]
    assert [r.sport for r in workouts.sports_by_users(logs).collect()] == ["bike", "row", "run"]


def test_primary_key_violations(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "asin string")
    assert rows(keys.primary_key_violations(df, "asin")) == [("a", 2), (None, 1)]


def test_foreign_key_violations(spark, rows):
    child = spark.createDataFrame([("a", 1), ("x", 2), (None, 3)], "asin string, n int")
    parent = spark.createDataFrame([("a",), ("a",)], "asin string")
    assert rows(keys.foreign_key_violations(child, parent, "asin")) == [("x", 2)]


def test_length_violations(spark, rows):
    df = spark.createDataFrame([("abc", "xy"), ("abcd", None), ("ab", "xyz")], "asin string, title string")
    assert rows(keys.length_violations(df, {"asin": 3, "title": 2})) == [("asin", 4, "abcd"), ("title", 3, "xyz")]


@pytest.mark.parametrize("partitions", [1, 5])
def test_surrogate_keys_are_dense(spark, partitions):
    df = spark.range(0, 1000).select((F.col("id") % 7).alias("v")).repartition(partitions)
    assert sorted(r.review_id for r in keys.add_surrogate_key(df).collect()) == list(range(1, 1001))
    ranked = keys.add_surrogate_key(df, "n", ["v"]).collect()
    assert [r.v for r in sorted(ranked, key=lambda r: r.n)] == sorted(r.v for r in ranked)


def test_surrogate_keys_of_copies(spark):
    df = spark.range(0, 900, 1, 6).select(F.lit("copy").alias("v"))
    found = keys.add_surrogate_key(df, "n", ["v"])
    assert sorted(r.n for r in found.collect()) == list(range(1, 901))
