"""Substring search by an index equals the test of every value."""

import random

import pytest
from pyspark.sql import functions as F

from checks.compare import plan
from shelfmark.functions.predicates import contains_ignore_case
from shelfmark.operators import trigrams
from shelfmark.operators.trigrams import TrigramIndex

VALUES = [
    "", None, "a", "ab", "abc", "ABCDE", "xabc", "100% wool", "under_score", "it's", "aaa", "aaaa", "Ünïcödé ÀB", "\U0001f600 smile",
    "the end", "end the", "a b", "tab\tbed", "İstanbul", "straße", "the the the", "x" * 900 + "needle", "￿", "lone￿￿end",
]
QUERIES = [
    "", "a", "B", "ab", "AB", "abc", "bcd", "abcde", "%", "_", "% w", "r_s", "'", "t's", "aaa", "aaaaa", "ü", "ÀB", "\U0001f600", "\U0001f600 s",
    "e e", "the", "the the", "zzz", "q", "zq", "d t", "needle", "\tb", "SS", "i̇s", "￿", "e￿￿",
]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(7)
    made = ["".join(rng.choices("abcde _%", k=rng.randint(1, 12))) for _ in range(400)]
    return spark.createDataFrame([(i, v) for i, v in enumerate([*VALUES, *made, *VALUES])], "n int, text string")


@pytest.fixture(scope="module")
def index(table, tmp_path_factory):
    made = TrigramIndex(str(tmp_path_factory.mktemp("index")))
    made.build(table, "text")
    return made


def test_searches_equal_a_test_of_every_row(spark, table, index, rows):
    stored = {r.text for r in table.collect()}
    for query in [*QUERIES, *"abcde", "ab", "a_", "_%", "cde", "a%b", "dead", "bee ", "% _"]:
        expected = {r.text for r in table.where(contains_ignore_case(F.col("text"), query)).collect()}
        got = [r.value for r in index.search(spark, query).collect()]
        assert set(got) == expected <= stored and len(got) == len(expected), query
    assert rows(index.rows_with(table, "text", "abc")) == rows(table.where(contains_ignore_case(F.col("text"), "abc")))


def test_a_search_reads_the_folders_of_its_grams(spark, index):
    for query, most in (("a", 1), ("ab", 1), ("abc", 1), ("needle", 4)):
        found = index.search(spark, query)
        text = plan(found)
        assert "PartitionFilters: [isnotnull(slot" in text or "PartitionFilters: [slot" in text, text
        assert "text" not in text.split("FileScan")[1].split("ReadSchema")[1]
    assert "StringStartsWith(gram,ab)" in plan(index.search(spark, "ab"))
    assert "In(gram" in plan(index.search(spark, "needle")) or "EqualTo(gram" in plan(index.search(spark, "needle"))


def test_only_the_rarest_grams_are_read(spark, index):
    wanted = sorted({"needle"[i : i + 3] for i in range(4)})
    assert sorted(index._rarest(spark, wanted)) == wanted
    assert index._rarest(spark, [*wanted, "zqz"]) is None
    many = sorted({("x" * 20 + "needle")[i : i + 3] for i in range(24)})
    assert len(index._rarest(spark, many)) == trigrams.GRAMS_USED and "xxx" in many


def test_an_empty_table_is_searched(spark, tmp_path):
    empty = TrigramIndex(str(tmp_path))
    empty.build(spark.createDataFrame([], "text string"), "text")
    assert empty.search(spark, "a").collect() == [] and empty.search(spark, "abc").collect() == []
