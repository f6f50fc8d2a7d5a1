"""Secret scans over a ledger of content-addressed blobs.

Every version of every path is named by the SHA-256 of its text. A scan reads
only the blobs that the ledger has not seen under the present rule version, each
once however many paths hold it, and findings are joined back to all paths.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored
from shelfmark.operators.sizing import fits_broadcast

# The rules, in the order of their kinds. Kind, pattern, group whose length counts, least length.
RULES = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
# Each finds a superset of the texts in which its rule matches, and finds it fast.
HINTS = {"assign": r"(?i)(?:pass(?:word|wd)|secret|token|api_?key)", "access": r"AKIA[A-Z0-9]{12}", "hex": r"[0-9a-f]{32}"}
RULE_VERSION = "base-1"
SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string>>"
MASK = "[SECRET]"
BROADCAST_HITS = 100_000


def spans_of(text: Column, kind_no: int, rules=RULES) -> Column:
    """The spans of one rule, in code points: leftmost matches that do not overlap, of the least length.

    The starts follow from the lengths of the matches and of the texts between them.
    """
    kind, pattern, group, least = rules[kind_no]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = matches if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.split(text, pattern, -1)
    found = F.zip_with(
        matches, counted, lambda m, c: F.struct(F.length(m).alias("size"), F.length(c).alias("counted"))
    )
    found = F.zip_with(
        found, F.slice(between, F.lit(1), F.size(matches)), lambda m, b: F.struct(m.size.alias("size"), m.counted.alias("counted"), F.length(b).alias("before"))
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(done: Column, m: Column) -> Column:
        begin = done.at + m.before
        span = F.array(
            F.struct(begin.alias("start"), F.lit(kind_no).alias("kind_no"), (begin + m.size).alias("end"), F.lit(kind).alias("kind"))
        )
        return F.struct(
            (begin + m.size).alias("at"),
            F.when(m.counted >= least, F.concat(done.spans, span)).otherwise(done.spans).alias("spans"),
        )

    spans = F.aggregate(found, start, step, lambda done: done.spans)
    hint = HINTS.get(kind)
    return spans if hint is None else F.when(text.rlike(hint), spans).otherwise(F.array().cast(SPAN))


def all_spans(text: Column, rules=RULES) -> Column:
    """The spans of all rules by start, then by kind as listed."""
    return F.sort_array(F.concat(*(spans_of(text, i, rules) for i in range(len(rules)))))


def blob_of(text: Column) -> Column:
    """The address of a text; a null is an empty text."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def empty_ledger(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], f"blob string, rule_version string, spans {SPAN}")


def scan_unseen(
    versions: DataFrame, paths: DataFrame, ledger: DataFrame | None = None, rules=RULES, rule_version: str = RULE_VERSION
) -> DataFrame:
    """New ledger rows (blob, rule_version, spans) for the blobs of ``paths`` unseen under the rule version.

    ``versions`` has doc_id and text; ``paths`` is its (doc_id, blob). Of the
    paths of a blob the one with the smallest id is read, so that a text held
    by a third of all paths is scanned once, and moved once.
    """
    first = paths.groupBy("blob").agg(F.min("doc_id").alias("_path"))
    if ledger is not None:
        seen = ledger.where(F.col("rule_version") == rule_version).select("blob")
        first = first.join(seen, "blob", "left_anti")
    texts = versions.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    to_read = texts.withColumn("_blob", blob_of(F.col("text"))).join(
        first.hint("shuffle_hash"), (F.col("_blob") == F.col("blob")) & F.col("doc_id").eqNullSafe(F.col("_path"))
    )
    found = to_read.select("blob", F.lit(rule_version).alias("rule_version"), all_spans(F.col("text"), rules).alias("spans"))
    return found.dropDuplicates(["blob"])


def scan_documents(
    documents: DataFrame, ledger: DataFrame | None = None, rules=RULES, rule_version: str = RULE_VERSION
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, blob, spans) for every row of ``documents``, and the ledger after the scan.

    ``ledger`` is what an earlier call returned; its findings are used again. A
    null text is empty and has no spans. Repeated rows, repeated ids and null
    ids each keep their row. The ledger is written to the shared folder.
    """
    paths = stored(documents.select("doc_id", blob_of(F.col("text")).alias("blob")), "secret-paths")
    added = stored(scan_unseen(documents, paths, ledger, rules, rule_version), "secret-ledger")
    whole = added if ledger is None else ledger.unionByName(added)
    hits = whole.where((F.col("rule_version") == rule_version) & (F.size("spans") > 0)).select("blob", "spans")
    joined = paths.join(hits, "blob", "left")
    return joined.select("doc_id", "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans")), whole


def redact(text: Column, spans: Column, mask: str = MASK) -> Column:
    """The text with each span, or run of overlapping spans, replaced by ``mask``."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(state: Column, span: Column) -> Column:
        apart = span.start >= state.at
        before = F.substring(text, state.at + 1, span.start - state.at)
        return F.struct(
            F.when(apart, F.concat(state.done, before, F.lit(mask))).otherwise(state.done).alias("done"),
            F.greatest(state.at, span.end).alias("at"),
        )

    return F.aggregate(
        spans, start, step, lambda s: F.concat(s.done, F.substring(text, s.at + 1, F.length(text)))
    )


def redact_documents(documents: DataFrame) -> DataFrame:
    """``documents`` with every secret replaced by a mask; n_chars follows. Null texts stay null.

    The findings are joined by the text's address; texts without secrets pass as they are.
    """
    found, _ = scan_documents(documents)
    hits = found.where(F.size("spans") > 0).groupBy("blob").agg(F.first("spans").alias("_spans"))
    hits = stored(hits.withColumnRenamed("blob", "_address"), "secret-hits")
    hits = F.broadcast(hits) if fits_broadcast(hits, max_rows=BROADCAST_HITS) else hits
    marked = documents.withColumn("_address", blob_of(F.col("text"))).join(hits, "_address", "left")
    clean = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(redact(F.col("text"), F.col("_spans")))
    out = marked.withColumn("text", clean)
    out = out.withColumn("n_chars", F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint")))
    return out.select(*documents.columns)


def digest(found: DataFrame, rules=RULES) -> DataFrame:
    """What the query returns, from (doc_id, spans)."""
    written = F.array_join(
        F.transform("spans", lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ","
    )
    kinds = F.transform("spans", lambda s: s.kind)
    counts = [F.size(F.array_remove(kinds, other)).cast("bigint") for other, *_ in rules]
    counts = [(F.size("spans") - rest).cast("bigint").alias(f"n_{kind}") for rest, (kind, *_) in zip(counts, rules)]
    return found.select("doc_id", *counts, F.sha2(written.cast("binary"), 256).alias("base_sha256"), written.alias("spans"))
