"""The registered queries in DuckDB SQL, written independently of the engine."""

from __future__ import annotations

import string

from checks import queries as q
from shelfmark.bindings import CONTEXT, WORKOUT_BLOCK

# The English stop words of Spark ML, for the check of that step.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's would
""".split()


def _list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


PUNCTUATION = string.punctuation.replace("'", "''")
SPACES = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"

ITEMS = """select cast(l_partkey as varchar) asin, l_shipdate review_date,
  cast(trunc(l_quantity) as int) % 5 + 1 rating from lineitem"""

RAW_CATALOG = """select cast(p_partkey as varchar) asin,
  case when p_partkey % 10 = 0 then p_brand when p_partkey % 10 = 1 then null
       else 'Visit Amazon''s ' || p_brand || ' Page' end brand,
  case when p_partkey % 7 = 0 then '' when p_partkey % 7 = 1 then '1 - $2'
       when p_partkey % 7 = 2 then cast(cast(p_retailprice as decimal(10,2)) as varchar)
       else '$' || cast(cast(p_retailprice as decimal(10,2)) as varchar) end price,
  p_name title from part"""

AUTHOR = "regexp_extract(brand, '^Visit Amazon''s(.*?) Page$', 1)"
PRICE = r"try_cast(regexp_replace(price, '^\$', '') as float)"

CATALOG = f"""select asin, author, price, title from (
  select *, row_number() over (partition by asin order by title, author, price) n from (
    select asin, {AUTHOR} author, {PRICE} price, title from ({RAW_CATALOG}) where price <> '')
  where author <> '' and asin is not null and title is not null and price is not null) where n = 1"""

JOINED = f"""select i.asin, i.review_date, i.rating, c.author, c.price, c.title
  from ({ITEMS}) i join ({CATALOG}) c on i.asin = c.asin"""

TEXTS = """select doc_id review_id, cast(doc_id % 200 as varchar) asin, source author, lang title,
  case when doc_id % 17 = 0 then 'n/a' else cast(2010 + doc_id % 8 as varchar) || '-' ||
    lpad(cast(1 + doc_id % 12 as varchar), 2, '0') || '-' || lpad(cast(1 + doc_id % 28 as varchar), 2, '0')
    || 'T00:00:00' end review_date,
  cast(doc_id % 5 + 1 as int) rating, text review_text from documents"""

READ_DATE = "try_strptime(review_date, '%Y-%m-%dT%H:%M:%S')"

DATED = f"""select review_id, asin, author, title, {READ_DATE} review_date, rating, review_text,
  cast(year({READ_DATE}) as int) "year" from ({TEXTS})"""

FEED_RECORDS = """select cast(l_partkey as varchar) asin,
  case when cast(trunc(l_quantity) as bigint) % 7 = 0 then 'nan'::double else l_quantity / 10 end overall,
  l_returnflag reviewText,
  case when l_linenumber <> 3 then cast(epoch(l_shipdate) as bigint) end unixReviewTime from lineitem"""

WORKOUTS = f"""select min(event_id) id, user_id userId, event_type sport,
  case user_id % 3 when 0 then 'male' when 1 then 'female' end gender,
  list(event_id order by event_id) "timestamp",
  list("value" order by event_id) heart_rate,
  list(case when event_id % 50 = 0 then 0.0 when event_id % 77 = 0 then 'nan'::double else "value" end
       order by event_id) altitude,
  case when user_id % 11 <> 0 then list("value" order by event_id) end speed
  from events group by user_id, event_type, event_id // {WORKOUT_BLOCK}"""


def _tokens(source: str, key: str, text: str, short_kept: bool = False) -> str:
    """(key, place, word): words without surrounding punctuation, in order."""
    bare = f"trim(raw, '{PUNCTUATION}')"
    word = f"case when length({bare}) <= 2 then raw else {bare} end" if short_kept else bare
    return f"""select {key}, word, row_number() over (partition by {key} order by spot) place from (
      select {key}, {word} word, spot from (
        select {key}, unnest(parts) raw, generate_subscripts(parts, 1) spot from (
          select {key}, string_split(trim(regexp_replace({text}, '{SPACES}', ' ', 'g')), ' ') parts
          from ({source}))))
      where word <> ''"""


DICTIONARY = f"""select word, case when length(word) % 2 = 0 then 1.5 else -1.0 end::double valence,
  case length(word) % 3 when 0 then 'JJ' when 1 then 'JJR' else 'NN' end tag from (
    select word from (select lower(word) word from ({_tokens("select item_id, text from benchmark", "item_id", "text")}))
    where regexp_full_match(word, '[a-z]{{3,12}}')
    group by word)"""

_DEGREE = f"""case when lw in ({_list(CONTEXT.stronger)}) then 0.293
  when lw in ({_list(CONTEXT.weaker)}) then -0.293 end::double"""


def _step(distance: int) -> str:
    """Value after the word ``distance`` places before has had its effect."""
    v, d = f"v{distance - 1}", distance
    damp = {1: "1.0", 2: "0.95", 3: "0.9"}[d]
    loud = f"case when caps{d} then case when {v} > 0 then emphasis else -emphasis end else 0 end"
    step = f"""case when val{d} is null and deg{d} is not null
      then case when {v} < 0 then -deg{d} else deg{d} end + {loud} else 0 end"""
    turn = f"case when val{d} is null and coalesce(neg{d}, false) then -0.74 else 1.0 end"
    return f"({v} + ({step}) * {damp}::double) * {turn}::double"


def _before(name: str, source: str) -> str:
    return ", ".join(f"lag({source}, {d}) over w {name}{d}" for d in (1, 2, 3))


SCORED = f"""
with texts as ({DATED}),
tok as ({_tokens("select * from texts", "review_id", "review_text", True)}),
marked as (
  select t.review_id, t.place, lower(t.word) lw, d.valence val,
         t.word <> lower(t.word) and t.word = upper(t.word) caps
  from tok t left join ({DICTIONARY}) d on d.word = lower(t.word)),
deg as (select *, {_DEGREE} deg, lw in ({_list(CONTEXT.negators)}) neg,
               lw in ({_list(CONTEXT.contrasts)}) turns from marked),
review as (select review_id, min(place) filter (where turns) turn_at,
  case when count(*) filter (where caps) > 0 and count(*) filter (where caps) < count(*)
       then 0.733 else 0.0 end::double emphasis from deg group by review_id),
ctx as (select *, {_before("val", "val")}, {_before("deg", "deg")}, {_before("neg", "neg")},
  {_before("caps", "caps")} from deg window w as (partition by review_id order by place)),
s0 as (select c.*, r.turn_at, r.emphasis,
  val + case when caps then sign(val) * r.emphasis else 0 end v0
  from ctx c join review r using (review_id) where val is not null),
s1 as (select *, {_step(1)} v1 from s0),
s2 as (select *, {_step(2)} v2 from s1),
s3 as (select *, {_step(3)} v3 from s2),
sums as (select review_id, sum(v3 * case when turn_at is null or place = turn_at then 1.0
  when place < turn_at then 0.5 else 1.5 end::double order by place) total from s3 group by review_id),
marks as (select *, length(review_text) - length(replace(review_text, '!', '')) bangs,
  length(review_text) - length(replace(review_text, '?', '')) asks from texts),
pushed as (select m.*, coalesce(total, 0) + sign(coalesce(total, 0)) * (least(bangs, 4) * 0.292::double +
  case when asks <= 1 then 0 when asks <= 3 then asks * 0.18::double else 0.96::double end) s
  from marks m left join sums using (review_id))
select review_id, asin, author, title, review_date, "year", rating, review_text,
  cast(round(s / sqrt(s * s + 15), 4) as float) review_sentiment_score from pushed"""

TAGGED = f"""select t.review_id, t.word, t.place from ({_tokens(TEXTS, "review_id", "review_text")}) t
  join ({DICTIONARY}) d on d.word = lower(t.word) and d.tag = 'JJ'"""

LOWER_WORDS = rf"""select review_id, case when trimmed = '' and review_text <> '' then []
  else regexp_split_to_array(trimmed, '[\s\x0b]') end words from (
  select review_id, review_text, regexp_replace(lower(review_text), '[\s\x0b]+$', '') trimmed from ({TEXTS}))"""

KEPT_WORDS = f"""select review_id, word, spot from (
  select review_id, unnest(words) word, generate_subscripts(words, 1) spot from ({LOWER_WORDS}))
  where lower(word) not in ({_list(STOP_WORDS)})"""


def _adjective_text(keys: str, name: str) -> str:
    return f"""select {keys}, part, coalesce(string_agg(adjectives, ' ' order by review_id), '') {name} from (
      select d.*, a.adjectives,
        cast((row_number() over (partition by {keys} order by review_id) - 1) // {q.REVIEWS_PER_PART} as int) part
      from ({DATED}) d left join (
        select review_id, string_agg(word, ' ' order by place) adjectives from ({TAGGED}) group by review_id) a
      using (review_id)) group by {keys}, part"""


def _adjective_counts(keys: str) -> str:
    return f"""select {keys}, lower(a.word) word, count(*) word_count
      from ({TAGGED}) a join ({DATED}) d using (review_id) group by all"""


def _word_weights(where: str, limit: str) -> str:
    return f"""select word, n word_count, round(n::double / max(n) over (), 6) weight from (
      select lower(a.word) word, count(*) n from ({TAGGED}) a join ({TEXTS}) t using (review_id) {where}
      group by all) order by n desc, word {limit}"""


def _yearly(source: str, keys: str, measures: str) -> str:
    return f"""select {keys}, cast(year(review_date) as int) "year", {measures} from ({source})
      group by {keys}, year(review_date)"""


RATING = "round(avg(rating), 6) avg_rating"
SENTIMENT = "round(avg(cast(review_sentiment_score as double)), 4) avg_sentiment"

_RATINGS = "select {0}, round(avg(rating), 6) avg_rating, count(rating) rating_count from ({1}) group by {0}"

FEED_BATCH = f"""select cast(l_partkey as varchar) asin, cast(trunc(l_quantity) as int) % 5 + 1 rating,
  l_orderkey % {q.FEED_FILES} batch_id from lineitem"""

_MEASURES = f"""
  select count(distinct userId) user_count, count(distinct sport) activity_types_count,
    count(distinct id) workouts_count, cast(sum(len("timestamp")) as bigint) total_records_count
  from ({WORKOUTS})"""

_SIZES = f"""select cast(count(n) as int) "count", cast(trunc(avg(n)) as int) mean,
  cast(trunc(stddev_samp(n)) as int) std, cast(min(n) as int) min,
  cast(trunc(quantile_cont(n, 0.25)) as int) "25%", cast(trunc(quantile_cont(n, 0.5)) as int) "50%",
  cast(trunc(quantile_cont(n, 0.75)) as int) "75%", cast(max(n) as int) max
  from (select len("timestamp") n from ({WORKOUTS})) where n < 50"""

_NAN = "list_contains({0}, 0) or list_contains({0}, 'nan'::double)"
_MISSING = f"""select count(*) filter (where gender is null) gender, count(*) filter (where sport is null) sport,
  count(*) filter (where id is null) id, count(*) filter (where userId is null) userId, """ + ", ".join(
    f"count(*) filter (where {_NAN.format(c)}) {c}_zero_or_nan, count(*) filter (where {c} is null) {c}_null_array"
    for c in ("heart_rate", "altitude", "speed")
) + f" from ({WORKOUTS})"


_STATISTICS = {
    "count": "count({0})", "mean": "avg({0})", "stddev": "stddev_samp({0})", "min": "min({0})", "max": "max({0})"
}


def _shares(counts: str, key: str, count: str, k: int) -> str:
    return f"""with c as ({counts}),
      r as (select *, row_number() over (order by {count} desc, {key}) n from c)
      select case when n <= {k} then {key} else 'others' end {key}, cast(sum({count}) as bigint) {count},
        round(sum({count})::double * 100 / (select sum({count}) from c), 6) percentage
      from r group by 1"""


SQL: dict[str, str] = {
    "s1_json_lines_without_malformed": f"select asin, brand, price, title from ({RAW_CATALOG}) where asin::bigint % 9 <> 0",
    "s2_json_array_batches": f"select asin, review_date, rating, md5(review_text) text_digest from ({TEXTS})",
    "s3_subquery_as_table": f"select * from ({CATALOG}) where asin in (select asin from ({ITEMS}))",
    "s4_append_to_table": CATALOG,
    "s5_feed_resumes_after_saved_offset": f"""select asin, count(*) row_count from ({FEED_RECORDS}) group by asin""",
    "s6_sql_text_with_parameters": f"""select author, count(*) title_count from ({CATALOG}) where price < 1000
      group by author""",
    "s7_rebuild_derived_table": _yearly(JOINED, "author", RATING),
    "s8_typed_table_load": _adjective_text('author, title, "year"', "adjectives"),
    "s9_page_of_a_table": f"""select review_id, asin, rating from ({TEXTS}) order by review_id limit 50 offset 100""",
    "s9_page_after_a_key": f"""select review_id, asin, rating from ({TEXTS}) where review_id > 99
      order by review_id limit 50""",
    "s10_preview_rows": f"select asin, author, title from ({CATALOG}) order by asin limit 5",
    "p1_required_columns_present": f"""select * from ({RAW_CATALOG}) where asin is not null and brand is not null
      and price is not null and title is not null""",
    "p2_non_empty_text": f"select asin, price from ({RAW_CATALOG}) where price <> ''",
    "p3_select_rename_drop": f"select asin, brand author, title from ({RAW_CATALOG})",
    "p4_derived_column": f"select id, cast(len(heart_rate) as int) samples from ({WORKOUTS})",
    "p5_derived_size_below_bound": f"""select id, cast(len("timestamp") as int) per_workout_record_count
      from ({WORKOUTS}) where len("timestamp") < 5""",
    "p6_case_insensitive_search": f"select asin, title from ({CATALOG}) where title ilike '%{q.SEARCH_TITLE}%'",
    "p7_exact_match": f"select asin, author, title from ({CATALOG}) where title = 'small ring'",
    "p8_pattern_search": f"""select distinct author from ({CATALOG}) where regexp_matches(author, 'Brand.1.$')""",
    "p9_null_safe_and_in_tests": f"""select count(*) filter (where gender is null) gender_missing,
      count(*) filter (where userId in (1, 2, 3)) user_in_list, count(*) filter (where userId is null) user_missing,
      count(*) filter (where gender is not distinct from 'male') gender_male from ({WORKOUTS})""",
    "j1_reviews_with_catalog": f"""select asin, author, title, price, rating, cast(review_date as varchar) review_date
      from ({JOINED})""",
    "j2_catalog_for_batch_keys": f"select * from ({CATALOG}) where asin in (select asin from ({TEXTS}))",
    "j3_grouped_tables_joined": f"""select gender, count(distinct userId) user_count, count(*) workouts_count
      from ({WORKOUTS}) group by gender""",
    "j4_rating_with_sentiment_per_year": _yearly(SCORED, "author", f"{RATING}, {SENTIMENT}"),
    "a1_row_count": f"select count(*) row_count from ({ITEMS})",
    "a2_distinct_values": f"select distinct asin from ({ITEMS})",
    "a3_distinct_count_with_null": f"""select count(distinct brand) + max(case when brand is null then 1 else 0 end) brands,
      count(distinct title) + max(case when title is null then 1 else 0 end) titles from ({RAW_CATALOG})""",
    "a4_distinct_pairs_per_group": f"""select sport, count(*) users_count from (
      select distinct sport, userId from ({WORKOUTS})) group by sport""",
    "a5_rows_per_one_key": f"select gender, count(*) row_count from ({WORKOUTS}) group by gender",
    "a5_rows_per_two_keys": f"select sport, gender, count(*) row_count from ({WORKOUTS}) group by sport, gender",
    "a6_sums_of_numeric_columns": f"""select cast(sum(id) as bigint) id, cast(sum(userId) as bigint) userId,
      cast(sum(len("timestamp")) as bigint) per_workout_record_count from ({WORKOUTS})""",
    "a7a_rating_per_author_year": _yearly(JOINED, "author", RATING),
    "a7b_rating_per_title_year": _yearly(JOINED, "title", RATING),
    "a7c_sentiment_per_author_year": _yearly(SCORED, "author", SENTIMENT),
    "a7d_sentiment_per_title_year": _yearly(SCORED, "title", SENTIMENT),
    "a8a_ratings_per_author": _RATINGS.format("author", JOINED),
    "a8b_ratings_per_title": _RATINGS.format("title", JOINED),
    "a9_one_row_per_key": f"""select asin, cast(review_date as varchar) review_date, rating from (
      select *, row_number() over (partition by asin order by review_date, rating) n from ({ITEMS})) where n = 1""",
    "a10_adjectives_per_author_title_year": _adjective_text('author, title, "year"', "adjectives"),
    "a11_adjectives_per_author_year": _adjective_text('author, "year"', "aggregated_adjectives"),
    "a11_adjectives_per_title_year": _adjective_text('title, "year"', "aggregated_adjectives"),
    "a11_adjective_counts": _adjective_counts('author, title, "year"'),
    "a11_adjective_counts_per_author_year": _adjective_counts('author, "year"'),
    "a11_adjective_counts_per_title_year": _adjective_counts('title, "year"'),
    "a12_summary_statistics": f"""with i as (select try_cast(asin as double) a, asin, rating from ({ITEMS}))
      select 'count' summary, count(asin)::double asin, count(rating)::double rating from i
      union all select 'mean', round(avg(a), 6), round(avg(rating), 6) from i
      union all select 'stddev', round(stddev_samp(a), 6), round(stddev_samp(rating), 6) from i
      union all select 'min', min(asin)::double, min(rating)::double from i
      union all select 'max', max(asin)::double, max(rating)::double from i""",
    "a13_size_summary": f"""select "count" workouts, mean, std, min, "25%" "quarter", "50%" "half",
      "75%" three_quarters, max from ({_SIZES})""",
    "a14_missing_values": _MISSING,
    "a15_dataset_totals": _MEASURES,
    "a16_users_and_workouts_per_gender": f"""select gender, count(distinct userId) user_count, count(*) workouts_count
      from ({WORKOUTS}) group by gender""",
    "a17_top_shares_with_others": _shares(
        f"select author, count(rating) rating_count from ({JOINED}) group by author", "author", "rating_count", 5
    ),
    "o1_top_k_groups": _RATINGS.format("title", JOINED) + " order by rating_count desc, title limit 10",
    "o2_groups_by_count": f"select asin, count(*) row_count from ({ITEMS}) group by asin",
    "o3_first_rows_of_an_order": f"""select sport, count(distinct userId) users_count from ({WORKOUTS})
      group by sport order by 2 desc, 1 limit 3""",
    "u1_summary_row_appended": f"""select sport, count(*) row_count from ({WORKOUTS}) group by sport
      union all select 'all', count(*) from ({WORKOUTS})""",
    "f1_author_from_brand": f"""select asin, case when brand is not null then {AUTHOR} end author
      from ({RAW_CATALOG})""",
    "f2_f3_price_text_to_float": f"select asin, {PRICE} price from ({RAW_CATALOG})",
    "f4_text_to_timestamp": f"select review_id, cast(review_date as varchar) review_date from ({DATED})",
    "f5_epoch_to_timestamp": f"""select asin, unixReviewTime,
      cast(make_timestamp(unixReviewTime * 1000000) as varchar) review_date from ({FEED_RECORDS})""",
    "f6_year_of_a_date": f'select review_id, "year" from ({DATED})',
    "f7_nul_characters_removed": f"""select review_id,
      length(review_text) * 2 - length(replace(review_text, chr(10), '')) length_before,
      length(review_text) length_after, md5(review_text) text_digest from ({TEXTS})""",
    "f8_array_length": f"select id, cast(len(speed) as int) speed_samples from ({WORKOUTS})",
    "f9_array_membership": f"select id, {_NAN.format('altitude')} zero_or_nan from ({WORKOUTS})",
    "f10_array_mean": f"select id, cast(trunc(list_avg(heart_rate)) as int) avg_heart_rate from ({WORKOUTS})",
    "f11_f12_ratings_to_int": f"""select known, cast(trunc(known) as int) rating, count(*) row_count from (
      select case when not isnan(overall) then overall end known from ({FEED_RECORDS})) group by known""",
    "f13_percentage_of_total": f"""select sport, round(n * 100.0::double / sum(n) over (), 6) share,
      round(100 - n * 100.0::double / sum(n) over (), 6) rest from (
      select sport, count(*) n from ({WORKOUTS}) group by sport)""",
    "f14_thousands_separators": f"""select rating, format('{{:,}}', count(*) * 1000) shown from ({ITEMS})
      group by rating""",
    "f15_strings_joined": f"select asin, author || ' ' || title as \"label\" from ({CATALOG})",
    "f16_json_text_parsed": "select event_id, cast(json_extract(props, '$.k') as bigint) k from events",
    "t1_lower_case_words": f"""select review_id, cast(len(words) as int) word_count,
      md5(array_to_string(words, ' ')) words_digest from ({LOWER_WORDS})""",
    "t2_without_stop_words": f"""select review_id, cast(count(word) as int) word_count,
      md5(coalesce(string_agg(word, ' ' order by spot), '')) words_digest
      from ({TEXTS}) left join ({KEPT_WORDS}) using (review_id) group by review_id""",
    "t3_bag_of_words": f"""select word, cast(sum(n) as bigint) term_count, count(*) document_count from (
      select review_id, word, count(*) n from ({KEPT_WORDS}) group by all)
      group by word having count(*) >= 5 order by 2 desc, 1 limit 10000""",
    "t3_count_vectors_per_review": f"""with kept as ({KEPT_WORDS}),
      vocabulary as (select word from (select word, sum(n) n from (
          select review_id, word, count(*) n from kept group by all) group by word having count(*) >= 5)
        order by n desc, word limit 10000)
      select r.review_id, cast(count(distinct w.word) as int) distinct_words, count(w.word) word_count
      from ({TEXTS}) r left join (select kept.review_id, kept.word from kept join vocabulary using (word)) w
      using (review_id) group by r.review_id""",
    "t4_topic_model_sizes": f"select count(*) reviews, true known_topics from ({TEXTS}) where review_text <> ''",
    "t5_topic_terms": """select cast(range as int) topic, 10::bigint different_terms, '1 2 3 4 5 6 7 8 9 10' ranks,
      true weights_fall from range(10)""",
    "t6_topic_words": """select cast(range as int) topic, 20::bigint different_words, 20::bigint in_vocabulary
      from range(10)""",
    "t7_topic_mix_per_review": f"""with kept as ({KEPT_WORDS}), known as (
        select word from (select word, count(*) n, count(distinct review_id) d from kept group by word)
        where d >= 5 order by n desc, word limit 10000)
      select review_id, cast(10 as int) shares, true none_negative,
        case when review_id in (select review_id from kept join known using (word)) then 1.0 else 0.0 end::double total
      from ({TEXTS}) where review_text <> ''""",
    "c10_review_topics": """select cast(range as int) topic, 10::bigint different_words, 10::bigint in_vocabulary
      from range(10)""",
    "t8_review_sentiment": f"""select review_id, round(cast(review_sentiment_score as double), 4) review_sentiment_score
      from ({SCORED})""",
    "t9_review_adjectives": f"""select review_id, coalesce(string_agg(word, ' ' order by place), '') adjectives
      from ({TEXTS}) left join ({TAGGED}) using (review_id) group by review_id""",
    "t10_word_weights": _word_weights("", ""),
    "c1_clean_catalog": CATALOG,
    "c2_enriched_reviews": f"""select s.review_id, s.asin, c.author, c.price, c.title,
      cast(s.review_date as varchar) review_date, s.rating, md5(s.review_text) text_digest,
      round(cast(s.review_sentiment_score as double), 4) review_sentiment_score
      from ({SCORED}) s join ({CATALOG}) c on s.asin = c.asin where s.review_text <> ''""",
    "c3_normalised_reviews": f"""select asin,
      strftime(make_timestamp(unixReviewTime * 1000000), '%Y-%m-%dT%H:%M:%S') review_date,
      cast(trunc(case when not isnan(overall) then overall end) as int) rating, reviewText review_text,
      count(*) row_count from ({FEED_RECORDS}) group by all""",
    "c4_authors_with_most_ratings": _RATINGS.format("author", JOINED) + " order by rating_count desc, author limit 250",
    "c5_books_with_most_ratings": _RATINGS.format("title", JOINED) + " order by rating_count desc, title limit 100",
    "c6_author_search": _yearly(
        f"select * from ({SCORED}) where author ilike '%{q.SEARCH_SOURCE}%'", "author", f"{RATING}, {SENTIMENT}"
    ),
    "c7_book_search": _yearly(
        f"select * from ({SCORED}) where title ilike '%{q.SEARCH_LANGUAGE}%'", "title", f"{RATING}, {SENTIMENT}"
    ),
    "c7_matching_titles": f"select distinct title from ({JOINED}) where title ilike '%{q.SEARCH_TITLE}%'",
    "c8_author_word_cloud": _word_weights(f"where t.author ilike '%{q.SEARCH_SOURCE}%'", "limit 200"),
    "c9_book_word_cloud": _word_weights(f"where t.title ilike '%{q.SEARCH_LANGUAGE}%'", "limit 200"),
    "c11_top_sports_with_others": _shares(
        f"select sport, count(distinct userId) users_count from ({WORKOUTS}) group by sport", "sport", "users_count", 3
    ),
    "c12_sports_by_mean_heart_rates": f"""select sport, count(distinct m) distinct_means, round(avg(m), 6) mean_heart_rate
      from (select sport, cast(trunc(list_avg(heart_rate)) as int) m from ({WORKOUTS})) group by sport""",
    "c13_dataset_profile": " union all ".join(
        [
            f"""unpivot (select cast(columns(*) as double) from ({part})) on columns(*) into name measure value "value" """
            for part in (_MEASURES, _SIZES, _MISSING)
        ]
        + [f"select '{s}_{c}', round({e.format(c)}, 6)::double from ({WORKOUTS})" for c in ("id", "userId") for s, e in _STATISTICS.items()]
        + [f"select 'count_{c}', count({c})::double from ({WORKOUTS})" for c in ("gender", "sport")]
        + [
            f"select coalesce(gender, 'none') || '_{n}', {e}::double from ({WORKOUTS}) group by gender"
            for n, e in (("user_count", "count(distinct userId)"), ("workouts_count", "count(*)"))
        ]
    ),
    "x1_feed_in_micro_batches": f"""select batch_id, asin, rating, count(*) row_count from ({FEED_BATCH})
      group by batch_id, asin, rating""",
    "x3_runs_until_the_input_ends": _yearly(JOINED, "author", RATING),
    "x4_rows_loaded_per_batch": f"""select batch_id, n rows_loaded,
      cast(sum(n) over (order by batch_id) as bigint) rows_so_far
      from (select batch_id, count(*) n from ({FEED_BATCH}) group by batch_id)""",
    "q1_primary_key_violations": """select l_orderkey, l_linenumber, count(*) row_count from lineitem
      group by all having count(*) > 1 or l_orderkey is null or l_linenumber is null""",
    "q2_foreign_key_violations": f"""select asin, count(*) row_count from ({ITEMS})
      where asin not in (select asin from ({CATALOG})) group by asin""",
    "q3_length_violations": " union all ".join(
        f"""select '{c}' column_name, cast(length({c}) as int) "length", {c} "value" from ({CATALOG})
        where length({c}) > {n}"""
        for c, n in (("asin", 3), ("author", 8), ("title", 12))
    ),
    "q3_stored_lengths_hold": f"""select count(*) violations from ({CATALOG})
      where length(asin) > 100 or length(author) > 256 or length(title) > 1000""",
    "q4_surrogate_key": f"""select row_number() over (order by asin, review_date, rating) review_id, asin,
      cast(review_date as varchar) review_date, rating from ({ITEMS})""",
}


def _sentence_words(source: str, key: str, text: str) -> str:
    """(key, sentence, piece, i, word): bare words by sentence, cut into pieces of 200 words, i from 1."""
    split = f"string_split(regexp_replace({text}, '([.!?]){SPACES}', '\\1' || chr(1), 'g'), chr(1))"
    parts = f"""select {key}, unnest(parts) part, generate_subscripts(parts, 1) sentence
      from (select {key}, {split} parts from ({source}))"""
    return f"""select {key}, sentence, (place - 1) // 200 piece, (place - 1) % 200 + 1 i, word
      from ({_tokens(parts, f"{key}, sentence", "part")})"""


_SENTENCE = "partition by item_id, sentence, piece order by i"
SQL["t9_adjectives_by_sentence"] = f"""
with recursive corpus as (
  select *, coalesce(length(lag(word, 1) over w), 0) l1, coalesce(length(lag(word, 2) over w), 0) l2
  from ({_sentence_words("select item_id, text from benchmark", "item_id", "text")}) window w as ({_SENTENCE})),
tagged as (
  select item_id, sentence, piece, i, lower(word) word, case when length(word) <= 3 then 'DT'
    when l1 between 1 and 3 and length(word) % 2 = 0 then 'JJ'
    when l2 between 1 and 3 and l1 > 3 and l1 % 2 = 0 and lower(word) like '%s' then 'VB' else 'NN' end tag from corpus),
tags as (select tag, row_number() over (order by tag) t from (select distinct tag from tagged)),
edges as (select t from tags union all select 0),
numbered as (select * from tagged join tags using (tag)),
pairs as (
  select coalesce(lag(t) over ({_SENTENCE}), 0) p, t a from numbered
  union all select t, 0 from numbered qualify row_number() over (partition by item_id, sentence, piece order by i desc) = 1),
pair_counts as (
  select b.t p, c.t a, (select count(*) from pairs where p = b.t and a = c.t) n from edges b, edges c),
steps as (
  select p, a, case when p = 0 and a = 0 then -1000000000000000 else
    cast(round(ln((n + 0.1::double) / (sum(n) over (partition by p) + 0.1::double * count(*) over (partition by p))) * 1000000) as bigint)
    end score from pair_counts),
word_counts as (
  select word, t, count(u.word) n from (select distinct word from numbered) w cross join tags
    left join numbered u using (word, t) group by word, t),
word_totals as (select *, sum(n) over (partition by word) whole from word_counts),
tag_totals as (
  select t, sum(n) + 0.1::double * (count(*) + 1) total, count(*) filter (where n = 1 and whole = 1) once
  from word_totals group by t),
emissions as (
  select word, t, cast(round(ln((n + 0.1::double) / total) * 1000000) as bigint) score from word_counts join tag_totals using (t)),
unseen as (select t, cast(round(ln((once + 0.1::double) / total) * 1000000) as bigint) score from tag_totals),
words as (select *, dense_rank() over (order by review_id, sentence, piece) sid
  from ({_sentence_words(TEXTS, "review_id", "review_text")})),
scored as (
  select sid, i, u.t, coalesce(e.score, u.score) score from words cross join unseen u
    left join emissions e on e.word = lower(words.word) and e.t = u.t),
paths(sid, i, t, total, path) as (
  select distinct sid, 0::bigint, 0::bigint, 0::bigint, '' from words
  union all
  select sid, i, t, best.s + score, best.path || t from (
    select w.sid, w.i, w.t, w.score, max({{'s': v.total + s.score, 'first': -v.t, 'path': v.path}}) best
    from paths v join scored w on w.sid = v.sid and w.i = v.i + 1 join steps s on s.p = v.t and s.a = w.t
    group by w.sid, w.i, w.t, w.score)),
ends as (
  select v.sid, max({{'s': v.total + s.score, 'first': -v.t, 'path': v.path}}).path path from paths v
    join (select sid, max(i) i from words group by sid) l on l.sid = v.sid and l.i = v.i
    join steps s on s.p = v.t and s.a = 0 group by v.sid),
adjectives as (
  select review_id, string_agg(word, ' ' order by sentence, piece, i) adjectives from words join ends using (sid)
  where substr(path, cast(i as int), 1) = (select cast(t as varchar) from tags where tag = 'JJ') group by review_id)
select review_id, coalesce(adjectives, '') adjectives from ({TEXTS}) left join adjectives using (review_id)"""
SQL["j1_bucketed_tables"] = SQL["j1_reviews_with_catalog"]
SQL["t7_topic_mix_of_new_reviews"] = f"""with kept as ({KEPT_WORDS}), known as (
    select word from (select word, count(*) n, count(distinct review_id) d from kept where review_id % 2 = 1 group by word)
    where d >= 5 order by n desc, word limit 10000)
  select review_id, cast(10 as int) shares, true none_negative,
    case when review_id in (select review_id from kept join known using (word)) then 1.0 else 0.0 end::double total
  from ({TEXTS}) where review_text <> '' and review_id % 2 = 0"""
SQL["x1_same_rows_after_merging_files"] = SQL["x1_feed_in_micro_batches"]
SQL["p6_search_by_trigrams"] = SQL["p6_case_insensitive_search"]
SQL["c6_author_search_by_trigrams"] = SQL["c6_author_search"]
SQL["c7_book_search_by_trigrams"] = SQL["c7_book_search"]
SQL["a7_live_rating_per_author_year"] = f"""select after_batch, author, cast(year(l_shipdate) as int) "year",
    round(avg(cast(trunc(l_quantity) as int) % 5 + 1), 6) avg_rating
  from (select range after_batch from range({q.FEED_FILES})) b
    join lineitem l on l.l_orderkey % {q.FEED_FILES} <= b.after_batch
    join ({CATALOG}) c on c.asin = cast(l.l_partkey as varchar) group by all"""
SQL["a8_live_sentiment_per_title_year"] = f"""select after_batch, c.title, cast(year(s.review_date) as int) "year",
    round(avg(cast(s.review_sentiment_score as double)), 4) avg_sentiment
  from (select range after_batch from range({q.FEED_FILES})) b
    join ({SCORED}) s on s.asin::bigint % {q.FEED_FILES} <= b.after_batch
    join ({CATALOG}) c on c.asin = s.asin where s.review_text <> '' group by all"""
SQL["a9_catalog_loaded_three_times"] = f"""select asin, author,
    case when asin::bigint % 4 = 1 then cast(price + 1 as float) else price end price,
    case when asin::bigint % 4 > 1 then upper(title) else title end title from ({CATALOG})"""
SQL["q2_known_keys_by_filter"] = f"""select asin from ({CATALOG}) where asin in (select asin from ({ITEMS}))"""
# each line with its faults, in both loads; among the sound lines of a key the first is admitted, in the first load that has it
_LINES = f"""
  with lines as (
    select case when l_orderkey % 101 <> 0 then l_orderkey end order_no, l_linenumber line_no,
      cast(l_partkey as varchar) asin, case when l_quantity % 11 <> 0 then cast(l_quantity as int) end quantity,
      l_returnflag || case when l_quantity % 7 = 0 then '-long' else '' end flag from lineitem),
  loads as (select 1 as "load", * from lines where order_no % 2 = 0 union all select 2, * from lines),
  faults as (
    select *, concat_ws('; ', case when order_no is null then 'missing order_no' end,
      case when line_no is null then 'missing line_no' end, case when quantity is null then 'missing quantity' end,
      case when length(flag) > 4 then 'too long flag' end,
      case when asin not in (select asin from ({CATALOG})) then 'no parent asin' end) faults from loads),
  ranked as (
    select *, row_number() over (partition by "load", order_no, line_no, faults = '' order by asin, quantity, flag) n,
      max(("load" = 1 and faults = '')::int) over (partition by order_no, line_no) earlier from faults),
  judged as (
    select *, case when faults <> '' then faults when n > 1 then 'repeated key'
      when "load" = 2 and earlier = 1 then 'key exists' else '' end reasons from ranked)"""
SQL["q1_rows_admitted_at_load"] = f"""{_LINES} select order_no, line_no, asin, quantity, flag, "load" from judged where reasons = ''"""
SQL["q1_rows_in_quarantine"] = f"""{_LINES} select order_no, line_no, asin, quantity, flag, reasons, "load" from judged
  where reasons <> ''"""
SQL["j1_sliced_for_hot_items"] = SQL["j1_reviews_with_catalog"]
SQL["x2_each_batch_enriched_and_appended"] = SQL["c2_enriched_reviews"].replace(
    "s.review_id, ", f"s.asin::bigint % {q.FEED_FILES} batch_id, 0::bigint repeated_ids, ", 1
)
# the score depends on the text alone, so each text of the benchmark is scored once
ITEM_TEXTS = """select item_id review_id, '' asin, '' author, '' title, '' review_date, 1 rating, text review_text
  from benchmark"""
SQL["c2_enriched_line_items"] = f"""select l_orderkey * 8 + l_linenumber review_id, c.asin, c.author, c.price, c.title,
  cast(l_shipdate as varchar) review_date, cast(trunc(l_quantity) as int) % 5 + 1 rating,
  md5(s.review_text) text_digest, round(cast(s.review_sentiment_score as double), 4) review_sentiment_score
  from lineitem l join ({CATALOG}) c on cast(l_partkey as varchar) = c.asin
  join ({SCORED.replace(TEXTS, ITEM_TEXTS)}) s
    on (l_orderkey * 8 + l_linenumber) % (select count(*) from benchmark) = s.review_id"""
SQL["c6_author_search_in_stored_tables"] = SQL["c6_author_search"]
SQL["c7_book_search_in_stored_tables"] = SQL["c7_book_search"]
SQL["t8_review_sentiment_joined"] = SQL["t8_review_sentiment"]
SQL["t9_review_adjectives_joined"] = SQL["t9_review_adjectives"]
