"""One query per operator of the survey, over the test tables.

Each takes ``Tables`` and returns a DataFrame whose columns are named as in
``checks.oracle``. Averages are rounded and times are text, so that two engines
can be compared value by value.
"""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types

from shelfmark import schemas
from shelfmark.bindings import Tables
from shelfmark.functions import predicates, scalars, text
from shelfmark.operators import aggregates, joins, key_filter, keys, profile, ranking, tagging, topics, words
from shelfmark.operators.trigrams import TrigramIndex
from shelfmark.plans import catalog, dashboard, live_marts, marts, reviews, workouts
from shelfmark.plans.topics import review_topics
from shelfmark.sources import bucketed, files, tables, validated
from shelfmark.sources.keyed import KeyedTable
from shelfmark.sources.storage import fresh_path, stored
from shelfmark.streaming import feed

REGISTRY: dict = {}

SEARCH_AUTHOR = "Brand#1"
SEARCH_TITLE = "RING"
SEARCH_SOURCE = "SRC1"
SEARCH_LANGUAGE = "E"
# So small that the test tables have keys of many parts.
REVIEWS_PER_PART = 4
FEED_FILES = 4
ROWS_PER_FEED_FILE = 25_000


def query(function):
    REGISTRY[function.__name__] = function
    return function


def as_text(column) -> F.Column:
    return F.col(column).cast("string").alias(column)


def rounded(column: str, digits: int = 6) -> F.Column:
    return F.round(F.col(column).cast("double"), digits).alias(column)


def joined_items(t: Tables) -> DataFrame:
    """Reviews without text, joined to the clean catalog."""
    return joins.lookup_join(t.rated_items(), t.catalog(), ["asin"])


def unread_reviews(t: Tables) -> DataFrame:
    """Raw feed records, from the line items: some ratings NaN, some dates missing."""
    quantity, ship = F.col("l_quantity"), F.col("l_shipdate")
    # counted from the date, as a cast to a timestamp would depend on the session zone
    days = F.unix_date(ship.cast("date")).cast("bigint")
    epoch = days * 86_400 + F.hour(ship) * 3_600 + F.minute(ship) * 60 + F.second(ship).cast("bigint")
    return t.table("lineitem").select(
        F.col("l_partkey").cast("string").alias("asin"),
        F.when(quantity % 7 == 0, F.lit(float("nan"))).otherwise(quantity / 10).alias("overall"),
        F.col("l_returnflag").alias("reviewText"),
        F.when(F.col("l_linenumber") != 3, epoch).alias("unixReviewTime"),
    )


# --- sources and sinks -------------------------------------------------------


@query
def s1_json_lines_without_malformed(t: Tables) -> DataFrame:
    raw = t.raw_catalog()
    line = F.to_json(F.struct(*raw.columns))
    broken = F.col("asin").cast("bigint") % 9 == 0
    path = fresh_path(t.spark, "catalog-lines")
    raw.select(F.when(broken, F.substring(line, 1, 12)).otherwise(line).alias("value")).write.text(path)
    return files.read_json_lines(t.spark, path, schemas.RAW_CATALOG)


@query
def s2_json_array_batches(t: Tables) -> DataFrame:
    batch = t.review_batch()
    # review numbers are unique, so a line never holds more than 100 reviews
    lines = batch.groupBy(F.floor(F.col("review_id") / 100)).agg(
        F.to_json(F.collect_list(F.struct(*schemas.REVIEW_BATCH.names))).alias("value")
    )
    path = fresh_path(t.spark, "review-arrays")
    lines.select("value").write.text(path)
    rows = files.read_json_arrays(t.spark, path, schemas.REVIEW_BATCH)
    return rows.select("asin", "review_date", "rating", F.md5("review_text").alias("text_digest"))


@query
def s3_subquery_as_table(t: Tables) -> DataFrame:
    return tables.run_sql(
        t.spark,
        "select bm.asin, bm.author, bm.price, bm.title from {catalog} bm"
        " join (select distinct asin from {batch}) ta on bm.asin = ta.asin",
        catalog=t.catalog(),
        batch=t.rated_items(),
    )


@query
def s4_append_to_table(t: Tables) -> DataFrame:
    items = t.catalog()
    odd = F.col("asin").cast("bigint") % 2 == 1
    path = fresh_path(t.spark, "catalog")
    tables.append_to_table(items.where(~odd), path)
    return tables.append_to_table(items.where(odd), path)


@query
def s5_feed_resumes_after_saved_offset(t: Tables) -> DataFrame:
    """Loads what is there, then what was added: each review once."""
    source, target, state = (fresh_path(t.spark, n) for n in ("feed", "loaded", "state"))
    raw = unread_reviews(t).select("asin", "unixReviewTime")
    late = F.coalesce(F.col("unixReviewTime") % 2_592_000 < 1_296_000, F.lit(True))
    schema = types.StructType([f for f in schemas.RAW_REVIEW if f.name in raw.columns])
    for number, part in enumerate((raw.where(~late), raw.where(late))):
        feed.write_feed(part, f"{source}/arrival={number}")
        stream = feed.read_feed(t.spark, f"{source}/*", schema, files_per_batch=16)
        feed.load_to_end(stream, target, state)
    return aggregates.rows_per_group(feed.loaded_table(t.spark, target, schema), "asin")


@query
def s6_sql_text_with_parameters(t: Tables) -> DataFrame:
    return tables.run_sql(
        t.spark,
        "select author, cast(count(*) as bigint) as title_count from {catalog} where price < :price group by author",
        catalog=t.catalog(),
        price=1000.0,
    )


@query
def s7_rebuild_derived_table(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "rating-per-author-year")
    items = joined_items(t)
    tables.rebuild_table(marts.rating_per_year(items, "title").limit(0), path)
    built = tables.rebuild_table(marts.rating_per_year(items, "author").select("author", "year", "avg_rating"), path)
    return built.select("author", "year", rounded("avg_rating"))


@query
def s8_typed_table_load(t: Tables) -> DataFrame:
    found = _adjective_parts(t, ["author", "title", "year"])
    return tables.load_typed(found, fresh_path(t.spark, "adjectives"), schemas.ADJECTIVES)


@query
def s9_page_of_a_table(t: Tables) -> DataFrame:
    return tables.page(t.review_batch().select("review_id", "asin", "rating"), "review_id", 100, 50)


@query
def s9_page_after_a_key(t: Tables) -> DataFrame:
    return tables.page_after(t.review_batch().select("review_id", "asin", "rating"), "review_id", 99, 50)


@query
def s10_preview_rows(t: Tables) -> DataFrame:
    return tables.preview(t.catalog().select("asin", "author", "title"), "asin", 5)


# --- projections, filters, predicates ----------------------------------------


@query
def p1_required_columns_present(t: Tables) -> DataFrame:
    kept = t.raw_catalog().where(predicates.all_present("asin", "brand", "price", "title"))
    return kept.select("asin", "brand", "price", "title")


@query
def p2_non_empty_text(t: Tables) -> DataFrame:
    return t.raw_catalog().where(predicates.not_empty(F.col("price"))).select("asin", "price")


@query
def p3_select_rename_drop(t: Tables) -> DataFrame:
    return t.raw_catalog().withColumnsRenamed({"brand": "author"}).drop("price")


@query
def p4_derived_column(t: Tables) -> DataFrame:
    return t.workouts().withColumns({"samples": F.size("heart_rate")}).select("id", "samples")


@query
def p5_derived_size_below_bound(t: Tables) -> DataFrame:
    sized = workouts.with_record_count(t.workouts())
    return sized.where(F.col("per_workout_record_count") < 5).select("id", "per_workout_record_count")


@query
def p6_case_insensitive_search(t: Tables) -> DataFrame:
    return t.catalog().where(predicates.contains_ignore_case(F.col("title"), SEARCH_TITLE)).select("asin", "title")


@query
def p6_search_by_trigrams(t: Tables) -> DataFrame:
    """The same by an index of the titles."""
    items = t.catalog()
    index = TrigramIndex(fresh_path(t.spark, "title-index"))
    index.build(items, "title")
    return index.rows_with(items.select("asin", "title"), "title", SEARCH_TITLE)


@query
def p7_exact_match(t: Tables) -> DataFrame:
    return t.catalog().where(F.col("title") == "small ring").select("asin", "author", "title")


@query
def p8_pattern_search(t: Tables) -> DataFrame:
    return aggregates.distinct_values(
        t.catalog().where(predicates.matches_pattern(F.col("author"), "Brand.1.$")), "author"
    )


@query
def p9_null_safe_and_in_tests(t: Tables) -> DataFrame:
    gender, user = F.col("gender"), F.col("userId")
    return t.workouts().agg(
        F.count_if(gender.eqNullSafe(F.lit(None)) | gender.isNull()).alias("gender_missing"),
        F.count_if(user.isin(1, 2, 3)).alias("user_in_list"),
        F.count_if(predicates.is_missing_number(user)).alias("user_missing"),
        F.count_if(gender.eqNullSafe(F.lit("male"))).alias("gender_male"),
    )


# --- joins -------------------------------------------------------------------


@query
def j1_reviews_with_catalog(t: Tables) -> DataFrame:
    joined = joins.lookup_join(t.rated_items(), t.catalog(), ["asin"])
    return joined.select("asin", "author", "title", "price", "rating", as_text("review_date"))


@query
def j1_sliced_for_hot_items(t: Tables) -> DataFrame:
    """The same through the shuffle join that spreads hot keys."""
    joined = joins.sliced_join(t.rated_items(), t.catalog(), ["asin"], rows_per_slice=10)
    return joined.select("asin", "author", "title", "price", "rating", as_text("review_date"))


@query
def j1_bucketed_tables(t: Tables) -> DataFrame:
    """The same with both sides laid out for the join, and items of more than 40 reviews split."""
    items, rated = t.catalog(), t.rated_items()
    large = bucketed.lay_out(rated, "asin", buckets=8, rows_per_slice=40)
    joined = bucketed.bucketed_join(large, bucketed.lay_out(items, "asin", buckets=8), t.spark)
    return joined.select("asin", "author", "title", "price", "rating", as_text("review_date"))


@query
def j2_catalog_for_batch_keys(t: Tables) -> DataFrame:
    return joins.restrict_to_keys(t.catalog(), t.review_batch(), "asin")


@query
def j3_grouped_tables_joined(t: Tables) -> DataFrame:
    return profile.users_joined_to_workouts(t.workouts())


@query
def j4_rating_with_sentiment_per_year(t: Tables) -> DataFrame:
    scored = t.scored_reviews()
    ratings, sentiments = marts.rating_per_year(scored, "author"), marts.sentiment_per_year(scored, "author")
    joined = joins.join_null_safe(ratings, sentiments, ["author", "year"])
    return joined.select("author", "year", rounded("avg_rating"), rounded("avg_sentiment", 4))


# --- aggregations ------------------------------------------------------------


def _adjective_parts(t: Tables, by: list[str]) -> DataFrame:
    return marts.word_texts(t.dated_reviews(), t.tagger(), by, rows_per_part=REVIEWS_PER_PART)


@query
def a1_row_count(t: Tables) -> DataFrame:
    return aggregates.row_count(t.rated_items())


@query
def a2_distinct_values(t: Tables) -> DataFrame:
    return aggregates.distinct_values(t.rated_items(), "asin")


@query
def a3_distinct_count_with_null(t: Tables) -> DataFrame:
    return t.raw_catalog().agg(
        aggregates.distinct_count("brand").alias("brands"), aggregates.distinct_count("title").alias("titles")
    )


@query
def a4_distinct_pairs_per_group(t: Tables) -> DataFrame:
    return aggregates.distinct_per_group(t.workouts(), "sport", "userId", "users_count")


@query
def a5_rows_per_one_key(t: Tables) -> DataFrame:
    return aggregates.rows_per_group(t.workouts(), "gender")


@query
def a5_rows_per_two_keys(t: Tables) -> DataFrame:
    return aggregates.rows_per_group(t.workouts(), "sport", "gender")


@query
def a6_sums_of_numeric_columns(t: Tables) -> DataFrame:
    sized = workouts.with_record_count(t.workouts())
    sums = aggregates.sum_numeric(sized)
    return sums.select(*(F.col(c).cast("bigint").alias(c) for c in ("id", "userId", "per_workout_record_count")))


@query
def a7a_rating_per_author_year(t: Tables) -> DataFrame:
    return marts.rating_per_year(joined_items(t), "author").select("author", "year", rounded("avg_rating"))


@query
def a7b_rating_per_title_year(t: Tables) -> DataFrame:
    return marts.rating_per_year(joined_items(t), "title").select("title", "year", rounded("avg_rating"))


@query
def a7c_sentiment_per_author_year(t: Tables) -> DataFrame:
    found = marts.sentiment_per_year(t.scored_reviews(), "author")
    return found.select("author", "year", rounded("avg_sentiment", 4))


@query
def a7d_sentiment_per_title_year(t: Tables) -> DataFrame:
    found = marts.sentiment_per_year(t.scored_reviews(), "title")
    return found.select("title", "year", rounded("avg_sentiment", 4))


@query
def a8a_ratings_per_author(t: Tables) -> DataFrame:
    return marts.ratings_per_author(joined_items(t)).select("author", rounded("avg_rating"), "rating_count")


@query
def a8b_ratings_per_title(t: Tables) -> DataFrame:
    return marts.ratings_per_title(joined_items(t)).select("title", rounded("avg_rating"), "rating_count")


@query
def a9_one_row_per_key(t: Tables) -> DataFrame:
    """One review per item: the earliest, then the lowest rated."""
    first = aggregates.first_per_key(t.rated_items(), "asin", ["review_date", "rating"])
    return first.select("asin", as_text("review_date"), "rating")


@query
def a9_catalog_loaded_three_times(t: Tables) -> DataFrame:
    """Three loads that overlap in pairs; of an item loaded twice the later row counts."""
    items, quarter = t.catalog(), F.col("asin").cast("bigint") % 4
    table = KeyedTable(t.spark, fresh_path(t.spark, "catalog"), schemas.CATALOG, "asin", buckets=8)
    loads = (
        items.where(quarter < 2),
        items.where((quarter > 0) & (quarter < 3)).withColumn("price", F.col("price") + 1),
        items.where(quarter > 1).withColumn("title", F.upper("title")),
    )
    for rows in loads:
        table.merge(rows, ["title", "author", "price"])
    return table.read()


@query
def a10_adjectives_per_author_title_year(t: Tables) -> DataFrame:
    return _adjective_parts(t, ["author", "title", "year"])


@query
def a11_adjectives_per_author_year(t: Tables) -> DataFrame:
    return _adjective_parts(t, ["author", "year"]).withColumnRenamed("adjectives", "aggregated_adjectives")


@query
def a11_adjectives_per_title_year(t: Tables) -> DataFrame:
    return _adjective_parts(t, ["title", "year"]).withColumnRenamed("adjectives", "aggregated_adjectives")


@lru_cache(maxsize=4)
def _adjective_mart(t: Tables) -> DataFrame:
    """The stored adjective counts that roll-ups and word clouds read."""
    return stored(marts.word_counts(t.dated_reviews(), t.tagger(), ["author", "title", "year"]), "adjective-counts")


@query
def a11_adjective_counts(t: Tables) -> DataFrame:
    return _adjective_mart(t)


@query
def a11_adjective_counts_per_author_year(t: Tables) -> DataFrame:
    return words.roll_up(_adjective_mart(t), ["author", "year"])


@query
def a11_adjective_counts_per_title_year(t: Tables) -> DataFrame:
    return words.roll_up(_adjective_mart(t), ["title", "year"])


@query
def a12_summary_statistics(t: Tables) -> DataFrame:
    described = profile.describe(t.rated_items())
    return described.select("summary", *(F.round(F.col(c).try_cast("double"), 6).alias(c) for c in ("asin", "rating")))


@query
def a13_size_summary(t: Tables) -> DataFrame:
    summary = profile.size_summary(workouts.with_record_count(t.workouts()), "per_workout_record_count", 50)
    return summary.withColumnsRenamed({"25%": "quarter", "50%": "half", "75%": "three_quarters", "count": "workouts"})


@query
def a14_missing_values(t: Tables) -> DataFrame:
    arrays = ["heart_rate", "altitude", "speed"]
    return profile.missing_counts(t.workouts(), ["gender", "sport"], ["id", "userId"], arrays)


@query
def a15_dataset_totals(t: Tables) -> DataFrame:
    return profile.workout_totals(workouts.with_record_count(t.workouts()))


@query
def a16_users_and_workouts_per_gender(t: Tables) -> DataFrame:
    return profile.users_and_workouts_by_gender(t.workouts())


@query
def a17_top_shares_with_others(t: Tables) -> DataFrame:
    counts = marts.ratings_per_author(joined_items(t)).select("author", "rating_count")
    shares = ranking.shares_with_others(counts, "author", "rating_count")
    return shares.select("author", F.col("rating_count").cast("bigint").alias("rating_count"), rounded("percentage"))


# --- sort, limit, union ------------------------------------------------------


@query
def o1_top_k_groups(t: Tables) -> DataFrame:
    top = ranking.top_k(marts.ratings_per_title(joined_items(t)), "rating_count", "title", 10)
    return top.select("title", rounded("avg_rating"), "rating_count")


@query
def o2_groups_by_count(t: Tables) -> DataFrame:
    return ranking.order_by_count(aggregates.rows_per_group(t.rated_items(), "asin"), "row_count", "asin")


@query
def o3_first_rows_of_an_order(t: Tables) -> DataFrame:
    return workouts.sports_by_users(t.workouts()).limit(3)


@query
def u1_summary_row_appended(t: Tables) -> DataFrame:
    counts = aggregates.rows_per_group(t.workouts(), "sport")
    total = aggregates.row_count(t.workouts()).withColumn("sport", F.lit("all"))
    return ranking.append_rows(counts, total)


# --- scalar functions --------------------------------------------------------


@query
def f1_author_from_brand(t: Tables) -> DataFrame:
    return t.raw_catalog().select("asin", scalars.author_from_brand(F.col("brand")).alias("author"))


@query
def f2_f3_price_text_to_float(t: Tables) -> DataFrame:
    return t.raw_catalog().select("asin", scalars.price_to_float(F.col("price")).alias("price"))


@query
def f4_text_to_timestamp(t: Tables) -> DataFrame:
    return t.dated_reviews().select("review_id", as_text("review_date"))


@query
def f5_epoch_to_timestamp(t: Tables) -> DataFrame:
    when = scalars.epoch_to_timestamp(F.col("unixReviewTime")).cast("string").alias("review_date")
    return unread_reviews(t).select("asin", "unixReviewTime", when)


@query
def f6_year_of_a_date(t: Tables) -> DataFrame:
    return t.dated_reviews().select("review_id", F.year("review_date").alias("year"))


@query
def f7_nul_characters_removed(t: Tables) -> DataFrame:
    """NULs are put behind every line and taken out again."""
    with_nul = F.replace(F.col("review_text"), F.lit("\n"), F.lit("\n\x00"))
    clean = scalars.strip_nul(with_nul)
    return t.review_batch().select(
        "review_id",
        F.length(with_nul).alias("length_before"),
        F.length(clean).alias("length_after"),
        F.md5(clean).alias("text_digest"),
    )


@query
def f8_array_length(t: Tables) -> DataFrame:
    return t.workouts().select("id", F.size("speed").alias("speed_samples"))


@query
def f9_array_membership(t: Tables) -> DataFrame:
    return t.workouts().select("id", scalars.has_zero_or_nan(F.col("altitude")).alias("zero_or_nan"))


@query
def f10_array_mean(t: Tables) -> DataFrame:
    return workouts.with_mean_heart_rate(t.workouts()).select("id", "avg_heart_rate")


@query
def f11_f12_ratings_to_int(t: Tables) -> DataFrame:
    known = scalars.nan_to_null(F.col("overall"))
    found = unread_reviews(t).select("overall", known.alias("known"), scalars.rating_to_int(known).alias("rating"))
    return aggregates.rows_per_group(found.drop("overall"), "known", "rating")


@query
def f13_percentage_of_total(t: Tables) -> DataFrame:
    counts = aggregates.rows_per_group(t.workouts(), "sport")
    total = counts.agg(F.sum("row_count")).scalar()
    share = scalars.percent_of(F.col("row_count"), total)
    return counts.select("sport", F.round(share, 6).alias("share"), F.round(100 - share, 6).alias("rest"))


@query
def f14_thousands_separators(t: Tables) -> DataFrame:
    counted = aggregates.rows_per_group(t.rated_items(), "rating")
    return counted.select("rating", scalars.thousands(F.col("row_count") * 1000).alias("shown"))


@query
def f15_strings_joined(t: Tables) -> DataFrame:
    return t.catalog().select("asin", F.concat_ws(" ", "author", "title").alias("label"))


@query
def f16_json_text_parsed(t: Tables) -> DataFrame:
    props = files.parse_json(F.col("props"), types.StructType([types.StructField("k", types.LongType())]))
    return t.table("events").select("event_id", props["k"].alias("k"))


# --- text and topics ---------------------------------------------------------


def _words(t: Tables) -> DataFrame:
    return t.review_batch().select("review_id", text.lower_words(F.col("review_text")).alias("words"))


@query
def t1_lower_case_words(t: Tables) -> DataFrame:
    joined = F.array_join("words", " ")
    return _words(t).select("review_id", F.size("words").alias("word_count"), F.md5(joined).alias("words_digest"))


@query
def t2_without_stop_words(t: Tables) -> DataFrame:
    kept = _words(t).withColumn("kept", text.without_stop_words(F.col("words"), text.english_stop_words()))
    joined = F.array_join("kept", " ")
    return kept.select("review_id", F.size("kept").alias("word_count"), F.md5(joined).alias("words_digest"))


@query
def t3_bag_of_words(t: Tables) -> DataFrame:
    kept = text.without_stop_words(F.col("words"), text.english_stop_words())
    return words.vocabulary(words.bag_of_words(_words(t), kept))


@query
def t3_count_vectors_per_review(t: Tables) -> DataFrame:
    """Distinct words and all words of each review that are in the vocabulary."""
    _, vectors = topics.count_vectors(t.review_batch(), "review_text")
    sparse = F.unwrap_udt("features")
    total = F.aggregate(sparse["values"], F.lit(0.0), lambda acc, n: acc + n)
    return vectors.select(
        "review_id", F.size(sparse["values"]).alias("distinct_words"), total.cast("bigint").alias("word_count")
    )


@lru_cache(maxsize=4)
def _topic_model(t: Tables) -> topics.TopicModel:
    return review_topics(t.review_batch())


@query
def t4_topic_model_sizes(t: Tables) -> DataFrame:
    """How many reviews have a strongest topic, all of them numbered 0 to 9."""
    mix = topics.topic_mix(_topic_model(t))
    strongest = F.array_position("topic_distribution", F.array_max("topic_distribution")) - 1
    sizes = aggregates.rows_per_group(mix.select(strongest.alias("topic")), "topic")
    known = F.bool_and(F.col("topic").between(0, 9))
    return sizes.agg(F.sum("row_count").alias("reviews"), known.alias("known_topics"))


@query
def t5_topic_terms(t: Tables) -> DataFrame:
    """Per topic: its ranks are 1 to 10 and the weights never rise along them."""
    ranked = topics.topic_terms(_topic_model(t), 10)
    order = F.array_sort(F.collect_list(F.struct("rank", "weight")))
    terms = ranked.groupBy("topic").agg(order.alias("terms"), F.count_distinct("term_index").alias("different_terms"))
    weights = F.transform("terms", lambda x: x.weight)
    return terms.select(
        "topic",
        "different_terms",
        F.array_join(F.transform("terms", lambda x: x["rank"]), " ").alias("ranks"),
        (weights == F.reverse(F.array_sort(weights))).alias("weights_fall"),
    )


def _words_in_vocabulary(t: Tables, terms: int) -> DataFrame:
    """Per topic its words, and how many of them are in the vocabulary that T3 counts."""
    known = topics.topic_vocabulary(t.review_batch(), "review_text").select("word")
    listed = topics.topic_words(_topic_model(t), terms).select("topic", F.explode("words").alias("word"))
    found = listed.groupBy("topic").agg(F.count_distinct("word").alias("different_words"))
    inside = listed.join(known, "word", "left_semi").groupBy("topic").agg(F.count(F.lit(1)).alias("in_vocabulary"))
    return found.join(inside, "topic")


@query
def t6_topic_words(t: Tables) -> DataFrame:
    return _words_in_vocabulary(t, 20)


@query
def t7_topic_mix_per_review(t: Tables) -> DataFrame:
    """Per review: ten shares, none negative, that sum to 1, or to 0 without a word of the vocabulary."""
    shares = F.col("topic_distribution")
    total = F.aggregate(shares, F.lit(0.0), lambda acc, x: acc + x)
    return topics.topic_mix(_topic_model(t)).select(
        "review_id",
        F.size(shares).alias("shares"),
        F.forall(shares, lambda x: x >= 0).alias("none_negative"),
        F.round(total, 6).alias("total"),
    )


@query
def t7_topic_mix_of_new_reviews(t: Tables) -> DataFrame:
    """A model of the odd reviews, stored, loaded and updated with the even ones, and what it says of these."""
    reviews_of = t.review_batch().where(F.col("review_text") != "")
    odd, even = (reviews_of.where(F.col("review_id") % 2 == n) for n in (1, 0))
    path = fresh_path(t.spark, "topic-model")
    topics.save_topics(review_topics(odd, iterations=5), path)
    model = topics.update_topics(topics.load_topics(path), even, reviews_of.count(), step=6)
    shares = F.col("topic_distribution")
    return topics.topic_mix(model, even).select(
        "review_id",
        F.size(shares).alias("shares"),
        F.forall(shares, lambda x: x >= 0).alias("none_negative"),
        F.round(F.aggregate(shares, F.lit(0.0), lambda acc, x: acc + x), 6).alias("total"),
    )


@query
def t8_review_sentiment(t: Tables) -> DataFrame:
    return t.scored_reviews().select("review_id", rounded("review_sentiment_score", 4))


@query
def t8_review_sentiment_joined(t: Tables) -> DataFrame:
    """The same with the lexicon joined to the words, as a large one would be."""
    scored = t.scorer(max_words=100)(t.review_batch())
    return scored.select("review_id", rounded("review_sentiment_score", 4))


@query
def t9_review_adjectives(t: Tables) -> DataFrame:
    tagged = t.tagger()(t.review_batch())
    return tagged.select("review_id", F.array_join("adjective_list", " ").alias("adjectives"))


@query
def t9_review_adjectives_joined(t: Tables) -> DataFrame:
    """The same with the dictionary joined to the words."""
    tagged = t.tagger(max_words=100)(t.review_batch())
    return tagged.select("review_id", F.array_join("adjective_list", " ").alias("adjectives"))


@query
def t9_adjectives_by_sentence(t: Tables) -> DataFrame:
    """Adjectives by a model of tagged sentences, so that one word may be tagged in two ways."""
    model = tagging.learn_tags(t.tagged_sentences())
    tagged = tagging.adjectives_by_sentence(model)(t.review_batch())
    return tagged.select("review_id", F.array_join("adjective_list", " ").alias("adjectives"))


@query
def t10_word_weights(t: Tables) -> DataFrame:
    counts = marts.word_counts(t.dated_reviews(), t.tagger(), ["author"])
    return words.word_weights(counts).select("word", "word_count", rounded("weight"))


# --- composed queries --------------------------------------------------------


@query
def c1_clean_catalog(t: Tables) -> DataFrame:
    return catalog.clean_catalog(t.raw_catalog())


@query
def c2_enriched_reviews(t: Tables) -> DataFrame:
    enriched = reviews.enrich_reviews(t.review_batch(), t.catalog(), t.scorer())
    return enriched.select(
        "review_id", "asin", "author", "price", "title", as_text("review_date"), "rating",
        F.md5("review_text").alias("text_digest"), rounded("review_sentiment_score", 4),
    )


@query
def c2_enriched_line_items(t: Tables) -> DataFrame:
    """As many reviews as there are line items, with the texts of the benchmark."""
    enriched = reviews.enrich_reviews(t.line_reviews(), t.catalog(), t.scorer())
    return enriched.select(
        "review_id", "asin", "author", "price", "title", as_text("review_date"), "rating",
        F.md5("review_text").alias("text_digest"), rounded("review_sentiment_score", 4),
    )


@query
def c3_normalised_reviews(t: Tables) -> DataFrame:
    normal = reviews.normalise_reviews(unread_reviews(t))
    return aggregates.rows_per_group(normal, "asin", "review_date", "rating", "review_text")


@query
def c4_authors_with_most_ratings(t: Tables) -> DataFrame:
    top = dashboard.authors_with_most_ratings(joined_items(t))
    return top.select("author", rounded("avg_rating"), "rating_count")


@query
def c5_books_with_most_ratings(t: Tables) -> DataFrame:
    top = dashboard.books_with_most_ratings(joined_items(t), 100)
    return top.select("title", rounded("avg_rating"), "rating_count")


@query
def c6_author_search(t: Tables) -> DataFrame:
    found = dashboard.search_yearly(t.scored_reviews(), "author", SEARCH_SOURCE)
    return found.select("author", "year", rounded("avg_rating"), rounded("avg_sentiment", 4))


@query
def c7_book_search(t: Tables) -> DataFrame:
    found = dashboard.search_yearly(t.scored_reviews(), "title", SEARCH_LANGUAGE)
    return found.select("title", "year", rounded("avg_rating"), rounded("avg_sentiment", 4))


def _yearly_tables(t: Tables, entity: str) -> tuple[DataFrame, DataFrame]:
    scored = stored(t.scored_reviews().select(entity, "review_date", "rating", "review_sentiment_score"), "scored")
    tables_of = (marts.rating_per_year(scored, entity), marts.sentiment_per_year(scored, entity))
    return tuple(stored(table, "yearly") for table in tables_of)


@query
def c6_author_search_in_stored_tables(t: Tables) -> DataFrame:
    found = dashboard.search_yearly_tables(*_yearly_tables(t, "author"), "author", SEARCH_SOURCE)
    return found.select("author", "year", rounded("avg_rating"), rounded("avg_sentiment", 4))


@query
def c7_book_search_in_stored_tables(t: Tables) -> DataFrame:
    found = dashboard.search_yearly_tables(*_yearly_tables(t, "title"), "title", SEARCH_LANGUAGE)
    return found.select("title", "year", rounded("avg_rating"), rounded("avg_sentiment", 4))


@query
def c6_author_search_by_trigrams(t: Tables) -> DataFrame:
    scored = stored(t.scored_reviews().select("author", "review_date", "rating", "review_sentiment_score"), "scored")
    index = TrigramIndex(fresh_path(t.spark, "author-index"))
    index.build(scored, "author")
    found = marts.rating_and_sentiment_per_year(index.rows_with(scored, "author", SEARCH_SOURCE), "author")
    return found.select("author", "year", rounded("avg_rating"), rounded("avg_sentiment", 4))


@query
def c7_book_search_by_trigrams(t: Tables) -> DataFrame:
    """A pattern of one letter."""
    scored = stored(t.scored_reviews().select("title", "review_date", "rating", "review_sentiment_score"), "scored")
    index = TrigramIndex(fresh_path(t.spark, "title-index"))
    index.build(scored, "title")
    found = marts.rating_and_sentiment_per_year(index.rows_with(scored, "title", SEARCH_LANGUAGE), "title")
    return found.select("title", "year", rounded("avg_rating"), rounded("avg_sentiment", 4))


@query
def c7_matching_titles(t: Tables) -> DataFrame:
    return dashboard.matching_titles(marts.rating_per_year(joined_items(t), "title"), SEARCH_TITLE)


@query
def c8_author_word_cloud(t: Tables) -> DataFrame:
    cloud = dashboard.word_cloud(_adjective_mart(t), "author", SEARCH_SOURCE, top=200)
    return cloud.select("word", "word_count", rounded("weight"))


@query
def c9_book_word_cloud(t: Tables) -> DataFrame:
    cloud = dashboard.word_cloud(_adjective_mart(t), "title", SEARCH_LANGUAGE, top=200)
    return cloud.select("word", "word_count", rounded("weight"))


@query
def c10_review_topics(t: Tables) -> DataFrame:
    return _words_in_vocabulary(t, 10)


@query
def c11_top_sports_with_others(t: Tables) -> DataFrame:
    shares = workouts.top_sports_with_others(t.workouts(), k=3)
    return shares.select("sport", F.col("users_count").cast("bigint").alias("users_count"), rounded("percentage"))


@query
def c12_sports_by_mean_heart_rates(t: Tables) -> DataFrame:
    return workouts.sports_by_mean_heart_rates(t.workouts()).select(
        "sport", "distinct_means", rounded("mean_heart_rate")
    )


@query
def c13_dataset_profile(t: Tables) -> DataFrame:
    """Totals, size summary, missing values, statistics and genders, as name and value."""
    sized = workouts.with_record_count(t.workouts())
    listed = profile.dataset_profile(
        sized, "per_workout_record_count", 50, ["gender", "sport"], ["id", "userId"], ["heart_rate", "altitude", "speed"]
    )
    return listed.select("measure", rounded("value"))


# --- streaming ---------------------------------------------------------------


def _write_arrays(batch: DataFrame, number: str, source: str) -> int:
    """Four arrivals of feed files of JSON arrays, each in a folder of its own; returns the files of an arrival.

    All arrivals have the same number of files, which grows with the rows, so that
    this number per batch makes a batch of each arrival. A line holds about a
    hundred reviews.
    """
    arrival = (F.col(number) % FEED_FILES).cast("int")
    parts = stored(batch.withColumn("_arrival", arrival), "feed-rows")
    sizes = [r.n for r in parts.groupBy("_arrival").agg(F.count(F.lit(1)).alias("n")).collect()] or [0]
    files = max(1, min(-(-max(sizes) // ROWS_PER_FEED_FILE), min(sizes) // 1_000))
    lines = max(1, max(sizes) // files // 100)
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id()), F.lit(files * lines))
    numbered = parts.withColumn("_line", spread).withColumn("_file", F.col("_line") % files)
    for i in range(FEED_FILES):
        dealt = numbered.where(F.col("_arrival") == i).repartition("_file")
        lines = dealt.groupBy("_file", "_line").agg(F.to_json(F.collect_list(F.struct(*schemas.REVIEW_BATCH.names))).alias("value"))
        lines.select("value", F.col("_file").alias("file")).write.partitionBy("file").text(f"{source}/arrival={i}")
    return files


def _feed_reviews(t: Tables) -> DataFrame:
    dated = scalars.iso_text(F.col("l_shipdate"))
    return t.table("lineitem").select(
        F.col("l_partkey").cast("string").alias("asin"),
        dated.alias("review_date"),
        (F.col("l_quantity").cast("int") % 5 + 1).alias("rating"),
        F.lit("read").alias("review_text"),
        F.col("l_orderkey").alias("order"),
    )


def _load_arrays(t: Tables, batch: DataFrame, file: str, target: str, runs: int = 1, **options) -> None:
    source, state = (fresh_path(t.spark, n) for n in ("feed", "state"))
    files = _write_arrays(batch, file, source)
    for _ in range(runs):
        stream = feed.read_feed(t.spark, f"{source}/*/*", schemas.REVIEW_BATCH, files_per_batch=files)
        feed.load_to_end(stream, target, state, **options)


@query
def x1_feed_in_micro_batches(t: Tables) -> DataFrame:
    target = fresh_path(t.spark, "loaded")
    _load_arrays(t, _feed_reviews(t), "order", target)
    loaded = feed.loaded_table(t.spark, target, schemas.REVIEW_BATCH)
    return aggregates.rows_per_group(loaded, "batch_id", "asin", "rating")


@query
def x2_each_batch_enriched_and_appended(t: Tables) -> DataFrame:
    """Four batches; before each, the items of its quarter of the catalog arrive."""
    items, target = fresh_path(t.spark, "catalog"), fresh_path(t.spark, "enriched")
    whole, arrived = stored(t.catalog(), "whole-catalog"), []
    t.spark.createDataFrame([], schemas.CATALOG).write.parquet(items)

    def current() -> DataFrame:
        return t.spark.read.schema(schemas.CATALOG).parquet(items)

    enrich = reviews.review_enricher(current, t.scorer())

    def grow_and_enrich(batch: DataFrame) -> DataFrame:
        new = whole.where(F.col("asin").cast("bigint") % FEED_FILES == len(arrived))
        new.write.mode("append").parquet(items)
        arrived.append(1)
        return enrich(batch)

    by_item = t.review_batch().withColumn("quarter", F.col("asin").cast("bigint") % FEED_FILES)
    _load_arrays(t, by_item.drop("review_id"), "quarter", target, transform=grow_and_enrich, number="review_id")
    loaded = feed.loaded_table(t.spark, target, schemas.ENRICHED)
    wrong = keys.primary_key_violations(loaded, "review_id").agg(F.count(F.lit(1)))
    return loaded.withColumn("repeated_ids", wrong.scalar()).select(
        "batch_id", "asin", "author", "price", "title", as_text("review_date"), "rating", "repeated_ids",
        F.md5("review_text").alias("text_digest"), rounded("review_sentiment_score", 4),
    )


@query
def x3_runs_until_the_input_ends(t: Tables) -> DataFrame:
    """Two runs over one feed: the second finds nothing new and adds nothing."""
    target = fresh_path(t.spark, "loaded")
    _load_arrays(t, _feed_reviews(t), "order", target, runs=2)
    items = joins.lookup_join(feed.loaded_table(t.spark, target, schemas.REVIEW_BATCH), t.catalog(), ["asin"])
    dated = items.withColumn("review_date", scalars.parse_review_date(F.col("review_date")))
    return marts.rating_per_year(dated, "author").select("author", "year", rounded("avg_rating"))


@query
def x4_rows_loaded_per_batch(t: Tables) -> DataFrame:
    target = fresh_path(t.spark, "loaded")
    _load_arrays(t, _feed_reviews(t), "order", target)
    return feed.committed_progress(t.spark, target).drop("run")


@query
def x1_same_rows_after_merging_files(t: Tables) -> DataFrame:
    """The batches merged into few files, the files of each batch removed, and the rows of the merged table."""
    target = fresh_path(t.spark, "loaded")
    _load_arrays(t, _feed_reviews(t), "order", target)
    feed.compact(t.spark, target, schemas.REVIEW_BATCH)
    feed.remove_replaced(t.spark, target)
    loaded = feed.loaded_table(t.spark, target, schemas.REVIEW_BATCH)
    return aggregates.rows_per_group(loaded, "batch_id", "asin", "rating")


def _after_each_batch(t: Tables, mart: live_marts.LiveMart, average: Column) -> DataFrame:
    """The mart as it stood after each of the four batches."""
    states = [
        mart.read(t.spark, version=i + 1).withColumn("after_batch", F.lit(i).cast("bigint")) for i in range(FEED_FILES)
    ]
    return reduce(DataFrame.unionByName, states).select("after_batch", mart.entity, "year", average)


@query
def a7_live_rating_per_author_year(t: Tables) -> DataFrame:
    """The mart after each of four batches, from sums of that batch and those before it."""
    target, folder = fresh_path(t.spark, "loaded"), fresh_path(t.spark, "mart")
    schema = types.StructType([f for f in schemas.ENRICHED if f.name in ("asin", "author", "title", "review_date", "rating")])
    items = stored(t.catalog().drop("price"), "catalog")

    def enrich(batch: DataFrame) -> DataFrame:
        joined = joins.lookup_join(batch, items, ["asin"])
        return joined.select("asin", "author", "title", scalars.parse_review_date(F.col("review_date")).alias("review_date"), "rating")

    mart = live_marts.LiveMart(folder, target, schema, "author", marts.RATING, folded_after=2)
    _load_arrays(t, _feed_reviews(t), "order", target, transform=enrich, after_batch=mart.follow)
    return _after_each_batch(t, mart, rounded("avg_rating"))


@query
def a8_live_sentiment_per_title_year(t: Tables) -> DataFrame:
    target, folder = fresh_path(t.spark, "enriched"), fresh_path(t.spark, "mart")
    schema = types.StructType([f for f in schemas.ENRICHED if f.name != "review_id"])
    enrich = reviews.review_enricher(stored(t.catalog(), "catalog"), t.scorer())
    mart = live_marts.LiveMart(folder, target, schema, "title", marts.SENTIMENT, folded_after=2)
    by_item = t.review_batch().withColumn("quarter", F.col("asin").cast("bigint") % FEED_FILES)
    _load_arrays(t, by_item.drop("review_id"), "quarter", target, transform=enrich, after_batch=mart.follow)
    return _after_each_batch(t, mart, rounded("avg_sentiment", 4))


# --- quality and keys --------------------------------------------------------


@query
def q1_primary_key_violations(t: Tables) -> DataFrame:
    return keys.primary_key_violations(t.table("lineitem"), "l_orderkey", "l_linenumber")


@query
def q2_foreign_key_violations(t: Tables) -> DataFrame:
    missing = keys.foreign_key_violations(t.rated_items(), t.catalog(), "asin")
    return aggregates.rows_per_group(missing, "asin")


@query
def q3_length_violations(t: Tables) -> DataFrame:
    return keys.length_violations(t.catalog(), {"asin": 3, "author": 8, "title": 12})


@query
def q3_stored_lengths_hold(t: Tables) -> DataFrame:
    """Number of values too long for the stored columns."""
    too_long = keys.length_violations(t.catalog(), schemas.MAX_LENGTHS)
    return aggregates.row_count(too_long, "violations")


def _order_lines(t: Tables) -> DataFrame:
    """Order lines with a key that is not unique, items that are not in the catalog, long and missing texts."""
    line = t.table("lineitem")
    flag = F.concat(F.col("l_returnflag"), F.when(F.col("l_quantity") % 7 == 0, "-long").otherwise(""))
    return line.select(
        F.when(F.col("l_orderkey") % 101 != 0, F.col("l_orderkey")).alias("order_no"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").cast("string").alias("asin"),
        F.when(F.col("l_quantity") % 11 != 0, F.col("l_quantity").cast("int")).alias("quantity"),
        flag.alias("flag"),
    )


def _validated_lines(t: Tables) -> validated.ValidatedTable:
    """Two loads: the lines of the even orders, then all lines."""
    lines = _order_lines(t)
    rules = validated.Rules(
        key=("order_no", "line_no"), required=("quantity",), max_lengths={"flag": 4}, parents={"asin": t.catalog}
    )
    table = validated.ValidatedTable(t.spark, fresh_path(t.spark, "lines"), lines.schema, rules)
    table.load(lines.where(F.col("order_no") % 2 == 0))
    table.load(lines)
    return table


@query
def q1_rows_admitted_at_load(t: Tables) -> DataFrame:
    return _validated_lines(t).read()


@query
def q1_rows_in_quarantine(t: Tables) -> DataFrame:
    return _validated_lines(t).quarantine().withColumn("reasons", F.array_join("reasons", "; "))


@query
def q2_known_keys_by_filter(t: Tables) -> DataFrame:
    """The items of the catalog that are reviewed, found without moving the reviews."""
    items = t.catalog().select("asin")
    return key_filter.found_keys(items, t.rated_items())


@query
def q4_surrogate_key(t: Tables) -> DataFrame:
    order = ["asin", "review_date", "rating"]
    numbered = keys.add_surrogate_key(t.rated_items(), "review_id", order)
    return numbered.select("review_id", "asin", as_text("review_date"), "rating")
