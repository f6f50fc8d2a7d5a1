"""Token counts from pre-token frequencies, without any ids."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored
from shelfmark.llm.pretokens import pretokenizer
from shelfmark.llm.terms import LONGEST, RARE_TYPE, count_terms, frequent_floor, frequent_terms, sum_rare

TOKENIZER = "byte_bpe_50k.json"
FREQUENCIES = "row long, doc_id long, n_bytes long, tokens long, rare array<struct<term:binary,n:int>>"


def count_pieces(counts: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Adds ``pieces``: how many tokens each distinct pre-token (column term) makes."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = pretokenizer(tokenizer).encode
        for batch in batches:
            ids = encode([t.decode() for t in batch.column(0).to_pylist()])
            sizes = pa.array([len(x) for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes], ["term", "n", "pieces"])

    return counts.select("term", "n").mapInArrow(pieces, "term binary, n long, pieces long")


def token_counts(documents: DataFrame, tokenizer: str = TOKENIZER, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``documents``.

    Every distinct pre-token of the table is encoded once. The frequencies of a
    document's pre-tokens are joined with that table: the most frequent by a
    dictionary of at most 200,000 entries, the others by a shuffle on the
    pre-token. A null or empty text has no tokens; repeated rows, repeated ids
    and null ids each keep their row; an empty table gives no rows; other columns
    are ignored. Two tables are written to the shared folder.
    """

    def splitter():
        split = pretokenizer(tokenizer).split
        return lambda text: [t.encode() for t in split(text)]

    table = stored(count_pieces(count_terms(documents, splitter), tokenizer), "token-pieces")
    floor = frequent_floor(table)
    held = {t.decode(): n for t, n in frequent_terms(table, floor, "pieces").items()}
    known = documents.sparkSession.sparkContext.broadcast(held)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, pieces = pretokenizer(tokenizer).split, known.value
        for batch in batches:
            sizes, tokens, rare = [], [], []
            for text in batch.column(2):
                text = text.as_py() or ""
                seen = Counter(split(text))
                sizes.append(len(text) if text.isascii() else len(text.encode()))
                tokens.append(sum(n * pieces[t] for t, n in seen.items() if t in pieces))
                rare.append([{"term": t.encode(), "n": n} for t, n in seen.items() if t not in pieces])
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array(rare, RARE_TYPE)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_bytes", "tokens", "rare"])

    numbered = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    rows = stored(numbered.mapInArrow(frequencies, FREQUENCIES), "token-frequencies")
    cold = table.where((F.col("n") < floor) | (F.octet_length("term") > LONGEST))
    sums = sum_rare(rows, cold, "pieces")
    n_tokens = (F.col("tokens") + F.coalesce("total", F.lit(0))).cast("long")
    return (
        rows.drop("rare")
        .join(sums, "row", "left")
        .select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit"))
    )
