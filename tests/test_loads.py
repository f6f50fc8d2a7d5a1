"""Tables that are loaded step by step: commit logs, feeds, marts, keyed and validated tables."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.compare import plan
from shelfmark import schemas
from shelfmark.operators import key_filter as filters
from shelfmark.operators.key_filter import PROBES, found_keys, key_filter, mark_members
from shelfmark.plans.live_marts import LiveMart
from shelfmark.sources import folders, validated
from shelfmark.sources.commits import CommitLog
from shelfmark.sources.counted import write_counted
from shelfmark.sources.keyed import KeyedTable
from shelfmark.streaming import feed

REVIEWS = T.StructType([f for f in schemas.ENRICHED if f.name in ("asin", "author", "review_date", "rating")])


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


@pytest.fixture
def reviews(spark):
    def make(n, start=0):
        i = F.col("id")
        return spark.range(start, start + n).select(
            i.cast("string").alias("asin"),
            F.concat(F.lit("author "), (i % 5).cast("string")).alias("author"),
            F.when(i % 7 != 0, F.make_timestamp_ntz((2010 + i % 3).cast("int"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0.0))).alias("review_date"),
            F.when(i % 4 != 0, (i % 5 + 1).cast("int")).alias("rating"),
        )

    return make


# --- commit log and counts -----------------------------------------------------


def test_a_log_goes_on_after_its_last_note(spark, folder):
    log = CommitLog(spark, folder("log"))
    assert log.latest() is None and log.notes("x long") is None
    last = None
    for x in (5, 6, 7):
        last = log.append(last, {"x": x})
    assert log.latest() == last == {"x": 7, "commit": 3} and log.note(2) == {"x": 6, "commit": 2} and log.note(9) is None
    assert sorted(tuple(r) for r in log.notes("x long").collect()) == [(1, 5), (2, 6), (3, 7)]


def test_a_log_with_an_old_or_lost_hint_finds_its_last_note(spark, folder):
    log = CommitLog(spark, folder("log"))
    last = log.append(log.append(None, {"x": 1}), {"x": 2})
    folders.write_note(spark, f"{log.path}/latest", "1")
    assert log.latest() == last
    folders.remove(spark, f"{log.path}/latest")
    assert log.latest() == last


def test_a_second_writer_is_refused(spark, folder):
    log = CommitLog(spark, folder("log"))
    first = log.append(None, {})
    log.append(first, {})
    with pytest.raises(RuntimeError, match="another writer"):
        log.append(first, {})


@pytest.mark.parametrize("n", [0, 1, 1_000])
def test_rows_are_counted_as_they_are_written(spark, folder, n):
    rows = spark.range(n).repartition(7).where(F.col("id") % 2 == 0)
    assert write_counted(rows, folder("t")) == (n + 1) // 2 == spark.read.schema("id long").parquet(folder("t")).count()
    assert write_counted(spark.createDataFrame([], "a int"), folder("t")) == 0


# --- the feed and what follows it ----------------------------------------------


def load(spark, folder, rows, name, **options):
    """Loads some rows as one batch."""
    rows.coalesce(2).write.json(folder(f"feed/{name}"))
    stream = feed.read_feed(spark, folder("feed") + "/*", REVIEWS, files_per_batch=100)
    feed.load_to_end(stream, folder("loaded"), folder("state"), **options)


def test_progress_is_read_from_notes_and_numbers_go_on(spark, folder, reviews):
    for i, n in enumerate((30, 0, 12)):
        load(spark, folder, reviews(n, 100 * i), i, number="review_id")
    numbered = T.StructType([*REVIEWS.fields, schemas.ENRICHED["review_id"]])
    loaded = feed.loaded_table(spark, folder("loaded"), numbered)
    assert sorted(r.review_id for r in loaded.collect()) == list(range(1, 43))
    progress = feed.committed_progress(spark, folder("loaded"))
    counts = [tuple(r)[1:] for r in progress.orderBy("batch_id").collect()]
    assert [(n, so_far) for _, n, so_far in counts if n] == [(30, 30), (12, 42)]
    assert "parquet" not in plan(progress)
    assert feed.commit_log(spark, folder("loaded")).latest()["last_number"] == 42


def test_a_batch_whose_checkpoint_was_lost_is_passed_over(spark, folder, reviews):
    """The note stands, then the query fails before Spark has noted the batch as done."""
    reviews(20).coalesce(1).write.json(folder("feed/0"))
    seen = []

    def fail_once(session):
        seen.append(1)
        if len(seen) == 1:
            raise RuntimeError("lost")

    def run():
        stream = feed.read_feed(spark, folder("feed") + "/*", REVIEWS, files_per_batch=1)
        transformed = []
        feed.load_to_end(stream, folder("loaded"), folder("state"), lambda b: transformed.append(1) or b, "review_id", fail_once)
        return transformed

    with pytest.raises(Exception, match="lost"):
        run()
    # the batch is not worked out again, but what follows it is called again
    assert run() == [] and len(seen) == 2
    assert feed.loaded_table(spark, folder("loaded"), REVIEWS).count() == 20


def test_rows_that_are_not_committed_are_not_read(spark, folder, reviews):
    load(spark, folder, reviews(10), 0)
    reviews(5).write.parquet(folder("loaded") + "/run=x/batch_id=7")
    assert feed.loaded_table(spark, folder("loaded"), REVIEWS).count() == 10


def part_files(spark, folder):
    found = [p for depth in ("run=*/*", "_compacted/*") for p, _ in folders.matching(spark, folder("loaded") + f"/{depth}/part-*")]
    return len(found)


def test_merging_files_changes_no_rows_before_during_or_after(spark, folder, reviews, rows):
    for i in range(4):
        load(spark, folder, reviews(20, 20 * i), i)
    opened = feed.loaded_table(spark, folder("loaded"), REVIEWS)
    before = rows(opened)
    many = part_files(spark, folder)
    assert len(before) == 80 and feed.compact(spark, folder("loaded"), REVIEWS)
    merged = feed.loaded_table(spark, folder("loaded"), REVIEWS)
    assert rows(opened) == before == rows(merged) and len(merged.inputFiles()) == 1
    load(spark, folder, reviews(5, 900), 4)
    assert len(rows(feed.loaded_table(spark, folder("loaded"), REVIEWS))) == 85 and rows(opened) == before
    assert feed.remove_replaced(spark, folder("loaded")) == 4 and part_files(spark, folder) < many
    assert rows(merged) == before
    # a second merge takes in the first one and the batch after it, in files of a set number of rows
    assert feed.compact(spark, folder("loaded"), REVIEWS, rows_per_file=30)
    assert not feed.compact(spark, folder("loaded"), REVIEWS)
    again = feed.loaded_table(spark, folder("loaded"), REVIEWS)
    assert again.count() == 85 and len(again.inputFiles()) == 3
    assert feed.remove_replaced(spark, folder("loaded")) == 2 and again.count() == 85
    assert [r.rows_so_far for r in feed.committed_progress(spark, folder("loaded")).orderBy("batch_id").collect()] == [20, 40, 60, 80, 85]


def expected_mart(table):
    return table.groupBy("author", F.year("review_date").alias("year")).agg(F.avg("rating").alias("avg_rating"))


def mart_of(folder, **options):
    return LiveMart(folder("mart"), folder("loaded"), REVIEWS, "author", {"rating": "avg_rating"}, **options)


@pytest.mark.parametrize("folded_after", [1, 2, 100])
def test_a_mart_follows_the_feed(spark, folder, reviews, rows, folded_after):
    mart = mart_of(folder, folded_after=folded_after)
    assert mart.read(spark).collect() == [] and mart.follow(spark) == 0
    so_far = reviews(0)
    for i in range(4):
        batch = reviews(25, 25 * i)
        so_far = so_far.unionByName(batch)
        load(spark, folder, batch, i, after_batch=mart.follow)
        assert rows(mart.read(spark)) == rows(expected_mart(so_far))
    assert mart.follow(spark) == 4 and rows(mart.read(spark)) == rows(expected_mart(so_far))
    opened = mart.read(spark)
    assert mart.remove_replaced(spark) >= (3 if folded_after < 4 else 0)
    assert rows(opened) == rows(expected_mart(so_far))


def test_a_step_reads_the_new_batch_alone(spark, folder, reviews):
    for i in range(3):
        load(spark, folder, reviews(10, 10 * i), i)
    batch, through = feed.new_batches(spark, folder("loaded"), REVIEWS, 2)
    assert through == 3 and batch.count() == 10 and all("batch_id=2" in f for f in batch.inputFiles())
    assert feed.new_batches(spark, folder("loaded"), REVIEWS, 3) is None
    text = plan(mart_of(folder).partial(batch))
    assert "partial_sum" in text and text.count("Exchange") == 1


def test_a_mart_that_lags_takes_in_several_batches_once(spark, folder, reviews, rows):
    mart = mart_of(folder)
    for i in range(3):
        load(spark, folder, reviews(10, 10 * i), i)
    assert mart.follow(spark) == 3 == mart.follow(spark)
    feed.compact(spark, folder("loaded"), REVIEWS)
    load(spark, folder, reviews(10, 30), 3)
    assert mart.follow(spark) == 5 and rows(mart.read(spark)) == rows(expected_mart(reviews(40)))
    feed.remove_replaced(spark, folder("loaded"))
    mart.rebuild(spark)
    assert rows(mart.read(spark)) == rows(expected_mart(reviews(40)))


# --- a table loaded by key -----------------------------------------------------

ITEMS = T.StructType([T.StructField("asin", T.StringType()), T.StructField("title", T.StringType()), T.StructField("price", T.FloatType())])


def keyed(spark, folder, buckets=8):
    return KeyedTable(spark, folder("items"), ITEMS, "asin", buckets)


def test_loads_that_overlap_equal_a_dictionary(spark, folder):
    rng, table, expected = random.Random(4), keyed(spark, folder), {}
    for load_no in range(4):
        new = [(str(rng.randrange(60)), f"t{load_no}-{rng.randrange(3)}", float(load_no)) for _ in range(40)]
        new.append(("third", f"t{load_no}", 1.0))
        smallest = {}
        for asin, title, price in new:
            smallest[asin] = min(smallest.get(asin, (title, price)), (title, price))
        expected |= smallest
        assert table.merge(spark.createDataFrame(new, ITEMS), ["title", "price"]) == load_no + 1
        assert {r.asin: (r.title, r.price) for r in table.read().collect()} == expected
        assert table.read().count() == len(expected)
    found = table.read_keys(spark.createDataFrame([("third",), ("none",), ("third",)], "asin string"))
    assert [r.asin for r in found.collect()] == ["third"]


def test_files_that_a_load_does_not_touch_keep_their_names(spark, folder, rows):
    table = keyed(spark, folder)
    table.merge(spark.range(200).select(F.col("id").cast("string").alias("asin"), F.lit("old").alias("title"), F.lit(1.0).cast("float").alias("price")), ["title"])
    first = table.read()
    files, before = set(first.inputFiles()), rows(first)
    table.merge(spark.createDataFrame([("5", "new", 2.0)], ITEMS), ["title"])
    now = set(table.read().inputFiles())
    assert len(files) == 8 and len(files - now) == 1 and len(now - files) == 1
    # a reader of the old version is not disturbed, until its files are removed
    assert rows(first) == before == rows(table.read(version=1)) and table.version() == 2
    assert table.remove_replaced() == 1 and table.read().where("title = 'new'").count() == 1 and table.read().count() == 200


def test_a_load_that_breaks_off_leaves_the_table_as_it_was(spark, folder, rows):
    table = keyed(spark, folder)
    table.merge(spark.createDataFrame([("1", "a", 1.0)], ITEMS), ["title"])
    spark.createDataFrame([("1", "broken", 1.0, 0)], "asin string, title string, price float, _bucket int").write.partitionBy("_bucket").parquet(folder("items") + "/load=2")
    assert rows(table.read()) == [("1", "a", 1.0)]
    table.merge(spark.createDataFrame([("2", "b", 1.0)], ITEMS), ["title"])
    assert rows(table.read()) == [("1", "a", 1.0), ("2", "b", 1.0)]


def test_rows_without_a_key_and_empty_loads(spark, folder):
    table = keyed(spark, folder)
    assert table.read().collect() == [] and table.merge(spark.createDataFrame([], ITEMS), ["title"]) == 0
    with pytest.raises(ValueError, match="without asin"):
        table.merge(spark.createDataFrame([(None, "a", 1.0)], ITEMS), ["title"])
    assert KeyedTable(spark, folder("items"), ITEMS, "asin", 16).buckets == 16


# --- key filters and rules -----------------------------------------------------


def test_a_filter_passes_all_keys_and_few_others(spark):
    keys = spark.range(0, 30_000, 3).select((F.col("id") * 7).alias("k"), F.col("id").cast("string").alias("s"))
    keep = key_filter(keys)
    assert keep.blocks.count() == keep.count > 1
    passed = keep.may_hold(spark.range(60_000).select((F.col("id") * 7).alias("k"), F.col("id").cast("string").alias("s"), F.lit("x").alias("rest")))
    assert passed.columns == ["k", "s", "rest"] and passed.join(keys, ["k", "s"], "left_semi").count() == 10_000
    assert passed.count() < 10_000 + 0.02 * 50_000
    text = plan(passed)
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
    assert key_filter(keys, max_bytes=100) is None and PROBES == 4


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_found_keys_equal_a_semi_join(spark, rows, max_bytes):
    keys = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c"), (4, None), (5, "e")], "x int, y string")
    table = spark.createDataFrame([(2, "b", 0), (5, "e", 0), (5, "e", 1), (1, "z", 0), (None, "c", 0), (4, None, 0)], "x int, y string, z int")
    assert rows(found_keys(keys, table, max_bytes)) == [(2, "b"), (5, "e")]
    assert found_keys(keys.limit(0), table, max_bytes).collect() == []
    assert found_keys(keys, table.limit(0), max_bytes).collect() == []


SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()), T.StructField("p", T.StringType())])


def rules(spark):
    return validated.Rules(("a",), ("b",), {"b": 3}, {"p": lambda: spark.createDataFrame([("x",), ("y",), (None,)], "p string")})


def test_each_rule_names_its_reason(spark):
    rows = [(1, "ok", "x"), (None, "ok", "x"), (2, None, "x"), (3, "long", "x"), (4, "ok", "q"), (None, "long", "q"), (5, "ok", None), (1, "z", "x"), (1, "ok", "x"), (9, "ok", "y")]
    known = spark.createDataFrame([(9,), (9,), (None,)], "a int")
    got = validated.check_rows(spark.createDataFrame(rows, SCHEMA), rules(spark), known)
    reasons = sorted(repr((*r[:3], r.reasons)) for r in got.collect())
    assert reasons == sorted(map(repr, [
        (1, "ok", "x", []), (1, "ok", "x", ["repeated key"]), (1, "z", "x", ["repeated key"]), (2, None, "x", ["missing b"]),
        (3, "long", "x", ["too long b"]), (4, "ok", "q", ["no parent p"]), (5, "ok", None, []), (9, "ok", "y", ["key exists"]),
        (None, "ok", "x", ["missing a"]), (None, "long", "q", ["missing a", "too long b", "no parent p"]),
    ]))


def test_a_hot_key_and_a_hot_parent_are_checked_by_number(spark):
    many = spark.range(3_000).select(F.lit(1).alias("a"), F.lit("ok").alias("b"), F.lit("q").alias("p"))
    good = spark.range(3_000).select(F.lit(1).alias("a"), F.lit("ok").alias("b"), F.lit("x").alias("p"))
    got = validated.check_rows(many.unionByName(good), rules(spark)).groupBy("p", "reasons").count().collect()
    assert sorted((r.p, r.reasons, r["count"]) for r in got) == [("q", ["no parent p"], 3_000), ("x", [], 1), ("x", ["repeated key"], 2_999)]


@pytest.mark.parametrize(("few", "max_bytes"), [(10**6, 1 << 20), (200, 1 << 20), (200, 0), (0, 1 << 20)])
def test_members_are_marked_by_broadcast_filter_or_shuffle(spark, monkeypatch, few, max_bytes):
    monkeypatch.setattr(filters, "fits_broadcast", lambda df: df.count() <= few)
    keys = spark.range(12_000).select(F.col("id").cast("string").alias("k"))
    members, others = keys.where("k % 3 = 0"), keys.where("k % 3 <> 0")
    rows = keys.unionByName(spark.createDataFrame([("3",), ("4",), (None,), (None,)], "k string")).withColumn("x", F.lit(1))
    got = mark_members(rows, members, others, "m", max_bytes)
    assert got.columns == ["k", "x", "m"] and got.count() == 12_004
    assert got.where("m <> coalesce(k % 3 = 0, false) or m is null").isEmpty() and got.where("m").count() == 4_001
    assert few != 200 or not max_bytes or "hashpartitioning" not in plan(got)


def test_rows_meet_once_by_key_and_those_with_a_fault_never(spark):
    some = spark.range(1_000).select(F.col("id").cast("int").alias("a"), F.lit("ok").alias("b"), F.lit("x").alias("p"))
    text = plan(validated.check_rows(some, rules(spark), some.select("a")))
    assert "_row" not in text and text.count("hashpartitioning(a#") == 2 and text.count("hashpartitioning(") == 2


@pytest.mark.parametrize("rows_per_slice", [50, 10**6])
@pytest.mark.parametrize("known_rows", [0, 3, 60_000])
@pytest.mark.parametrize("order", [None, ["b"]])
def test_a_key_in_slices_has_one_first_row(spark, rows, rows_per_slice, known_rows, order):
    i = F.col("id")
    many = spark.range(2_000).select(
        F.when(i % 3 == 0, 1).when(i % 3 == 1, 2).otherwise(i + 10).cast("int").alias("a"),
        F.when(i % 5 != 0, F.concat(F.lit("b"), (i % 7).cast("string"))).alias("b"), F.lit("x").alias("p"),
    ).unionByName(spark.createDataFrame([(None, "b0", "x"), (3, "b0", "x"), (3, "b0", "x")], SCHEMA))
    known = spark.range(known_rows).select((i * 2).cast("int").alias("a")) if known_rows else None
    got = validated.check_rows(many, rules(spark), known, order, rows_per_slice=rows_per_slice).collect()
    sound = [r for r in got if r.a is not None and r.b is not None]
    assert len(got) == 2_003 and all(("missing b" in r.reasons) == (r.b is None) and ("missing a" in r.reasons) == (r.a is None) for r in got)
    exists = {r.a for r in sound if r.reasons == ["key exists"]}
    firsts = [r for r in sound if r.reasons != ["repeated key"]]
    assert sorted(r.a for r in firsts) == sorted({r.a for r in sound})
    assert exists == {r.a for r in firsts if r.a % 2 == 0 and r.a < 2 * known_rows}
    assert all(r.reasons == [] for r in firsts if r.a not in exists)
    least = {a: min(r.b for r in sound if r.a == a) for a in {r.a for r in sound}}
    assert all(r.b == least[r.a] for r in firsts)


def test_good_rows_in_and_the_others_with_their_reasons(spark, folder, rows):
    table = validated.ValidatedTable(spark, folder("t"), SCHEMA, rules(spark))
    assert table.read().collect() == [] and table.quarantine().collect() == []
    first = table.load(spark.createDataFrame([(1, "ok", "x"), (2, None, "x")], SCHEMA), "monday")
    assert (first["rows"], first["rejected"]) == (1, 1)
    assert table.load(spark.createDataFrame([(7, "ok", "x")], SCHEMA), "monday") == first
    second = table.load(spark.createDataFrame([(1, "no", "x"), (3, "ok", "y")], SCHEMA), "tuesday")
    assert (second["rows"], second["rejected"]) == (1, 1)
    assert rows(table.read()) == [(1, "ok", "x", 1), (3, "ok", "y", 2)]
    assert rows(table.quarantine()) == [(1, "no", "x", ["key exists"], 2), (2, None, "x", ["missing b"], 1)]
    nothing = table.load(spark.createDataFrame([], SCHEMA))
    assert (nothing["rows"], nothing["rejected"]) == (0, 0) and table.read().count() == 2


def test_a_load_stores_the_values_of_a_parent_once_and_no_lists(spark, folder, rows, monkeypatch):
    written, real = {}, validated.stored

    def seen(df, name):
        written.setdefault(name, []).append(df.schema)
        return real(df, name)

    monkeypatch.setattr(validated, "stored", seen)
    monkeypatch.setattr(filters, "stored", seen)
    table = validated.ValidatedTable(spark, folder("t"), SCHEMA, rules(spark))
    table.load(spark.createDataFrame([(1, "ok", "x"), (1, "zz", "x"), (2, "ok", "q"), (3, "ok", None)], SCHEMA))
    assert "wanted-keys" not in written and len(written["child-keys"]) == 1
    assert [f.dataType for f in written["judged-rows"][0]] == [f.dataType for f in SCHEMA] + [T.StringType()]
    assert rows(table.read()) == [(1, "ok", "x", 1), (3, "ok", None, 1)]
    assert rows(table.quarantine()) == [(1, "zz", "x", ["repeated key"], 1), (2, "ok", "q", ["no parent p"], 1)]


def test_folders_are_moved_and_replaced(spark, folder):
    folders.write_note(spark, folder("a/one"), "1")
    folders.write_note(spark, folder("b/one"), "2")
    folders.move(spark, folder("a"), folder("b"))
    assert folders.read_note(spark, folder("b/one")) == "1" and not folders.exists(spark, folder("a"))
    assert folders.read_note(spark, folder("none")) is None and folders.matching(spark, folder("none/*")) == []
