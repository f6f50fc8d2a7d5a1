import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import schemas
from shelfmark.plans.reviews import normalise_reviews
from shelfmark.plans.workouts import with_record_count
from shelfmark.sources import database, files, tables
from shelfmark.sources.storage import fresh_path, shared_folder
from shelfmark.streaming import feed

REVIEWS = [(str(i % 7), "2014-05-27T00:00:00", i % 5, f"text {i}") for i in range(100)]


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


@pytest.fixture
def reviews(spark):
    return spark.createDataFrame(REVIEWS, schemas.REVIEW_BATCH)


def test_malformed_lines_are_dropped(spark, folder, rows):
    good = {"asin": "1", "brand": "b", "price": "$1", "title": "t", "other": [1]}
    with open(folder("lines.json"), "w") as f:
        f.write("\n".join([json.dumps(good), '{"asin": "2", "bra', "", json.dumps({"asin": "3"})]) + "\n")
    df = files.read_json_lines(spark, folder("lines.json"), schemas.RAW_CATALOG)
    assert rows(df) == [("1", "b", "$1", "t"), ("3", None, None, None)]


def test_array_and_envelope_batches(spark, folder, rows):
    records = [dict(zip(schemas.REVIEW_BATCH.names, r)) for r in REVIEWS[:3]]
    with open(folder("array.json"), "w") as f:
        json.dump(records, f)
    with open(folder("envelope.json"), "w") as f:
        json.dump({"book_reviews": records, "is_json_completed": True}, f)
    expected = sorted(REVIEWS[:3], key=repr)
    assert rows(files.read_json_arrays(spark, folder("array.json"), schemas.REVIEW_BATCH)) == expected
    envelope = files.read_envelopes(spark, folder("envelope.json"), schemas.BATCH_ENVELOPE, "book_reviews")
    assert rows(envelope) == expected


def test_raw_reviews_from_file_to_batch(spark, folder, rows):
    lines = [
        {"asin": "1", "overall": 4.0, "reviewText": "a", "unixReviewTime": 1401148800, "vote": "2", "image": ["x"]},
        {"asin": "2", "overall": 5.0, "unixReviewTime": 0, "verified": True},
    ]
    with open(folder("raw.json"), "w") as f:
        f.write("\n".join(map(json.dumps, lines)))
    raw = files.read_json_lines(spark, folder("raw.json"), schemas.RAW_REVIEW)
    assert rows(normalise_reviews(raw)) == [
        ("1", "2014-05-27T00:00:00", 4, "a"),
        ("2", "1970-01-01T00:00:00", 5, None),
    ]


def test_workout_logs_are_read_with_their_arrays(spark, folder):
    log = {"id": 1, "userId": 2, "sport": "run", "gender": "male", "url": "u", "heart_rate": [100, 101.5]}
    with open(folder("logs.json"), "w") as f:
        f.write(json.dumps(log | {"timestamp": [1, 2], "altitude": [0.0]}))
    row = with_record_count(files.read_json_lines(spark, folder("logs.json"), schemas.WORKOUTS)).first()
    assert (row.heart_rate, row.altitude, row.speed, row.per_workout_record_count) == ([100.0, 101.5], [0.0], None, 2)


def test_parse_json(spark):
    df = spark.createDataFrame([('{"asin": "1"}',), ("{oops",), (None,)], "v string")
    found = df.select(files.parse_json(F.col("v"), schemas.RAW_CATALOG)["asin"]).collect()
    assert [r[0] for r in found] == ["1", None, None]


def test_sql_parameters_are_bound(spark, reviews):
    text = "select count(*) n from {reviews} where asin = :asin"
    assert tables.run_sql(spark, text, reviews=reviews, asin="3").first().n == 14
    assert tables.run_sql(spark, text, reviews=reviews, asin="' or '1'='1").first().n == 0
    assert tables.run_sql(spark, "select 1 as one").first().one == 1


def test_rebuild_append_and_typed_load(spark, folder, reviews, rows):
    path = folder("table")
    tables.rebuild_table(reviews, path)
    assert tables.rebuild_table(reviews.limit(10), path).count() == 10
    assert tables.append_to_table(reviews.limit(5), path).count() == 15
    columns = "author string, title string, year long, adjectives string, part int"
    found = spark.createDataFrame([("a", "t", 2014, "x", 0)], columns)
    loaded = tables.load_typed(found, folder("typed"), schemas.ADJECTIVES)
    assert loaded.schema == schemas.ADJECTIVES and rows(loaded) == [("a", "t", 2014, 0, "x")]


def test_pages_cover_the_table_once(spark):
    df = spark.range(0, 25, 1, 4)
    pages = [[r.id for r in tables.page(df, "id", start, 10).collect()] for start in (0, 10, 20, 30)]
    assert [len(p) for p in pages] == [10, 10, 5, 0] and sum(pages, []) == list(range(25))
    assert [r.id for r in tables.preview(df, "id", 3).collect()] == [0, 1, 2]
    read, last = [], None
    while found := [r.id for r in tables.page_after(df, "id", last, 10).collect()]:
        read, last = read + found, found[-1]
    assert read == list(range(25))


class Recorder:
    """Stands in for a reader or writer and keeps the options it is given."""

    def __init__(self):
        self.seen = {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def mode(self, name):
        self.seen["mode"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **values):
        self.seen.update(values)
        return self

    def load(self):
        return self.seen

    def save(self):
        return None


def test_database_options():
    class Session:
        read = Recorder()

    split = database.Split("review_id", "1", "1000", 16)
    seen = database.read_query(Session, "jdbc:x", "select 1", {"user": "u"}, split)
    assert seen == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "(select 1) subquery", "user": "u",
        "partitionColumn": "review_id", "lowerBound": "1", "upperBound": "1000", "numPartitions": 16,
    }

    class Frame:
        write = Recorder()

    database.append_rows(Frame, "jdbc:x", "t", connections=4)
    assert Frame.write.seen == {
        "format": "jdbc", "mode": "append", "url": "jdbc:x", "dbtable": "t", "numPartitions": 4,
    }


def test_scratch_paths_are_fresh_and_shared(spark):
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert fresh_path(spark, "x").startswith(shared_folder(spark))


def test_a_cluster_has_to_name_its_folder():
    class Conf:
        def get(self, key, default):
            return self.folder

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    Session.conf.folder = "hdfs:///shared"
    assert shared_folder(Session) == "hdfs:///shared"
    Session.conf.folder = None
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session)


def batches(spark, target):
    loaded = feed.loaded_table(spark, target, schemas.REVIEW_BATCH)
    return [tuple(r) for r in feed.load_progress(loaded).drop("run").orderBy("batch_id").collect()]


def test_feed_in_batches_and_on_after_a_restart(spark, folder, reviews, rows):
    source, target, state = folder("feed"), folder("loaded"), folder("state")

    def run():
        stream = feed.read_feed(spark, source + "/*", schemas.REVIEW_BATCH, files_per_batch=1)
        feed.load_to_end(stream, target, state)

    feed.write_feed(reviews.coalesce(1), source + "/a", fetch_size=30)
    run()
    assert sorted(n for _, n, _ in batches(spark, target)) == [10, 30, 30, 30]
    assert batches(spark, target)[-1][2] == 100
    run()
    assert len(batches(spark, target)) == 4
    feed.write_feed(reviews.coalesce(1).limit(7), source + "/b")
    run()
    assert batches(spark, target)[-1] == (4, 7, 107)
    assert feed.loaded_table(spark, target, schemas.REVIEW_BATCH).drop("run", "batch_id").distinct().count() == 100


def test_a_batch_run_again_replaces_itself(spark, folder, reviews):
    """The first attempt stores its rows and then fails; the restart repeats it."""
    source, target, state = folder("feed"), folder("loaded"), folder("state")
    feed.write_feed(reviews.coalesce(1), source, fetch_size=50)
    attempts = []

    def stored_then_failed(batch):
        attempts.append(batch.count())
        if len(attempts) == 2:
            run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            batch.write.mode("overwrite").parquet(f"{target}/run={run}/batch_id=1")
            raise RuntimeError("lost")
        return batch

    def run():
        stream = feed.read_feed(spark, source, schemas.REVIEW_BATCH, files_per_batch=1)
        feed.load_to_end(stream, target, state, stored_then_failed)

    with pytest.raises(Exception, match="lost"):
        run()
    run()
    assert attempts == [50, 50, 50] and batches(spark, target) == [(0, 50, 50), (1, 50, 100)]


def test_timed_feed_keeps_running(spark, folder, reviews):
    source, target = folder("feed"), folder("loaded")
    feed.write_feed(reviews, source)
    stream = feed.read_feed(spark, source, schemas.REVIEW_BATCH, files_per_batch=8, archive=folder("archive"))
    running = feed.follow_feed(stream, target, folder("state"), interval="1 second")
    try:
        running.processAllAvailable()
        assert running.isActive
        assert feed.loaded_table(spark, target, schemas.REVIEW_BATCH).count() == 100
    finally:
        running.stop()


def test_other_checkpoints_overwrite_nothing(spark, folder, reviews):
    """A second feed with a checkpoint of its own, and a lost checkpoint."""
    source, other, target = folder("feed"), folder("other"), folder("loaded")
    feed.write_feed(reviews, source)
    feed.write_feed(reviews.limit(5), other)
    for path, state in ((source, "one"), (other, "two"), (source, "lost")):
        stream = feed.read_feed(spark, path, schemas.REVIEW_BATCH, files_per_batch=100)
        feed.load_to_end(stream, target, folder(state), number="review_id")
    numbered = T.StructType([*schemas.REVIEW_BATCH.fields, schemas.ENRICHED["review_id"]])
    loaded = feed.loaded_table(spark, target, numbered)
    assert loaded.groupBy("run").count().count() == 3 and loaded.count() == 205
    assert sorted(r.review_id for r in loaded.collect()) == list(range(1, 206))


def test_an_empty_feed_has_loaded_no_rows(spark, folder):
    loaded = feed.loaded_table(spark, folder("nothing"), schemas.REVIEW_BATCH)
    assert loaded.collect() == [] and loaded.columns[-2:] == ["run", "batch_id"]
    assert feed.load_progress(loaded).collect() == []


def test_pages_are_ranked_in_ranges(spark, rows):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), F.lit("x").alias("v"))
    assert [r.k for r in tables.page(df, "k", 990, 20).collect()] == list(range(990, 1000))
    assert [r.k for r in tables.page(df, ["v", "k"], 10, 3).collect()] == [10, 11, 12]
