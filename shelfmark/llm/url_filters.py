"""URL filters: host and path rules, and a cascade of Bloom filters over the pages' addresses.

The cascade answers membership of a list exactly for every key of a known
universe. Level 1 holds the listed keys; each later level holds the keys of the
other side that the level before lets through wrongly; the last one lets none
through. A key's answer is the parity of the first level that refuses it, so no
row is ever joined with the list. DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, exp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored
from shelfmark.operators.joins import sliced_join
from shelfmark.operators.sizing import fits_broadcast

BITS_PER_KEY = 8
HASHES = 5
# the share of other keys that a filter of so many bits and hashes lets through
PASSED = (1 - exp(-HASHES / BITS_PER_KEY)) ** HASHES
KEYS_PER_SHARD = 50_000
WORD = 64
# a page with fewer characters outside its tags is thin
THIN = 1_000

# The rules (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def lower_ascii(column: Column) -> Column:
    """A-Z lower-cased, all else unchanged."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """From after the first ``://`` to ``/``, ``?``, ``#`` or the end; empty without ``://`` or for a null."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as struct(rule, verdict), or null.

    A rule fits its host and all subdomains, where the path starts with the
    rule's. Of equally long rules the first in text order wins. ``rules`` is a
    short list that becomes part of the plan.
    """
    longest_first = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    found = [
        F.when(
            ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path)),
            F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for rule_host, rule_path, verdict in longest_first
    ]
    nothing = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*found, nothing)


def _places(key: Column, level: Column, bits: Column) -> list[Column]:
    """The bit positions of a key, by hashes that depend on the level."""
    return [F.pmod(F.xxhash64(key, level, F.lit(i)), bits) for i in range(HASHES)]


def _passes(key: Column, level: Column, bits: Column, words: Column) -> Column:
    """True where all bits of the key are set."""
    tests = [
        F.get(words, F.floor(p / WORD).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), (p % WORD).cast("int"))) != 0
        for p in _places(key, level, bits)
    ]
    return reduce(lambda a, b: a & b, tests)


def _filter_of(keys: DataFrame, level: int) -> DataFrame:
    """One Bloom filter per shard: (shard, bits, words). The words of a shard come from their set positions."""
    sized = keys.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    sized = sized.select("shard", (F.ceil(F.col("n") * BITS_PER_KEY / WORD) * WORD).cast("bigint").alias("bits"))
    placed = keys.join(F.broadcast(sized), "shard").select(
        "shard", "bits", F.explode(F.array(*_places(F.col("key"), F.lit(level), F.col("bits")))).alias("place")
    )
    word = F.floor(F.col("place") / WORD).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("place") % WORD).cast("int"))
    words = placed.groupBy("shard", "bits", word.alias("word")).agg(F.bit_or(one).alias("mask"))
    held = words.groupBy("shard", "bits").agg(F.map_from_entries(F.collect_list(F.struct("word", "mask"))).alias("set"))
    last = (F.col("bits") / WORD).cast("int") - 1
    full = F.transform(F.sequence(F.lit(0), last), lambda i: F.coalesce(F.element_at("set", i), F.lit(0).cast("bigint")))
    return held.select("shard", "bits", full.alias("words"))


def build_cascade(listed: DataFrame, universe: DataFrame) -> DataFrame:
    """The cascade over ``universe`` (column key) of the keys in ``listed`` (column key).

    Returns (shard, levels), where levels is an array of struct(bits, words); a
    shard without listed keys has no row. Nulls are no keys, repeated keys count
    once, listed keys outside the universe are added to it. Keys are dealt to
    shards by hash, so that a filter holds about 50,000 keys whatever the list's
    length. Runs a few jobs per level; each level is some hundredth of the one before.
    """
    marked = (
        listed.select("key", F.lit(1).alias("side"))
        .unionByName(universe.select("key", F.lit(0).alias("side")))
        .where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.max("side").alias("side"))
    )
    keys = stored(marked, "url-keys")
    sides = {r.side: r.n for r in keys.groupBy("side").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = sides.get(1, 0)
    shards = max(1, ceil(max(size, PASSED * sides.get(0, 0)) / KEYS_PER_SHARD))
    keys = keys.withColumn("shard", F.pmod(F.xxhash64("key", F.lit("shard")), F.lit(shards)).cast("int"))
    inside, outside, levels, level = keys.where("side = 1"), keys.where("side = 0"), [], 1
    while size:
        bloom = stored(_filter_of(inside, level), "url-filter")
        levels.append(bloom.select("shard", F.lit(level).alias("level"), "bits", "words"))
        kept = outside.join(shared(bloom), "shard").where(
            _passes(F.col("key"), F.lit(level), F.col("bits"), F.col("words"))
        )
        inside, outside = stored(kept.select("key", "side", "shard"), "url-passed"), inside
        size, level = inside.count(), level + 1
    if not levels:
        return keys.sparkSession.createDataFrame([], "shard int, levels array<struct<bits:bigint,words:array<bigint>>>, shards int")
    rows = reduce(DataFrame.unionByName, levels).groupBy("shard").agg(
        F.array_sort(F.collect_list(F.struct("level", "bits", "words"))).alias("all")
    )
    levels = F.transform("all", lambda x: F.struct(x.bits.alias("bits"), x.words.alias("words")))
    return stored(rows.select("shard", levels.alias("levels"), F.lit(shards).alias("shards")), "url-cascade")


def shared(filters: DataFrame) -> DataFrame:
    """Broadcast if measured small enough."""
    return F.broadcast(filters) if fits_broadcast(filters) else filters


def is_listed(df: DataFrame, key: str, cascade: DataFrame, name: str) -> DataFrame:
    """Adds the boolean ``name``: whether the cascade lists the key; false for a null.

    Exact for the keys of the cascade's universe. Each row only meets the filters of
    its shard. Where the filters of all shards are too large for a broadcast, the
    rows are dealt out by shard, those of a hot one to several tasks.
    """
    found = cascade.select("shards").first()
    if found is None:
        return df.withColumn(name, F.lit(False))
    shard = F.pmod(F.xxhash64(key, F.lit("shard")), F.lit(found.shards)).cast("int")
    filters = cascade.select(F.col("shard").alias("_shard"), F.col("levels").alias("_levels"))
    rows = df.withColumn("_shard", shard)
    if fits_broadcast(filters):
        joined = rows.join(F.broadcast(filters), "_shard", "left")
    else:
        joined = sliced_join(rows, filters, ["_shard"], "left")
    numbered = F.transform("_levels", lambda x, i: F.struct(x.bits.alias("bits"), x.words.alias("words"), (i + 1).alias("level")))
    let_through = F.aggregate(
        numbered,
        F.lit(0),
        lambda depth, x: F.when(
            (depth == x.level - 1) & _passes(F.col(key), x.level, x.bits, x.words), x.level
        ).otherwise(depth),
    )
    answer = F.coalesce(let_through % 2 == 1, F.lit(False)) & F.col(key).isNotNull()
    return joined.withColumn(name, answer).select(*df.columns, name)


def address_of(url: Column) -> Column:
    """Host and path; null without a host."""
    host = host_of(url)
    return F.when(host != "", F.concat(host, path_of(url)))


def judge_urls(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``.

    The longest fitting rule decides. Without one, an address of ``listed`` (column
    key: host and path) is blocked, by the cascade over all addresses of the pages,
    and any other allowed. A null url, or one without ``://``, has an empty host and
    path, and is allowed. Repeated rows and null ids are judged row by row; urls may
    be of any length; an empty table gives no rows; other columns are ignored.
    """
    url = F.col("url")
    parts = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), address_of(url).alias("_address"))
    cascade = build_cascade(listed, parts.select(F.col("_address").alias("key")).distinct())
    judged = is_listed(parts, "_address", cascade, "_blocked").withColumn(
        "_rule", matching_rule(F.col("host"), F.col("path"), rules)
    )
    method = F.when(F.col("_blocked"), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce(F.col("_rule.verdict"), method).alias("verdict")
    )


def thin_addresses(pages: DataFrame, thin: int = THIN) -> DataFrame:
    """The list that the query uses: (key), the addresses under which a page has little text.

    A page is thin if fewer than ``thin`` characters of its html stand outside
    tags; a null html has none. The list grows with the pages, and an address does
    not tell whether it is in it.
    """
    text = F.regexp_replace(F.coalesce(F.col("html"), F.lit("")), "<[^>]*>", "")
    return pages.where(F.length(text) < thin).select(address_of(F.col("url")).alias("key")).distinct()
