"""Deterministic WARC archives: written in shards of a set size, committed by a manifest, read back as streams.

The same pages give the same files byte for byte, however they are partitioned.
Spark's own writer and reader move the bytes, so archives may live in any store
that Spark reaches.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import small_batches, stored
from shelfmark.operators.joins import lookup_join
from shelfmark.sources import folders

# The names of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE, END = b"\r\n", b"\r\n\r\n"

LEAST_REVISITED = 1_000
ROLL_BYTES = 64 << 20
# The pages have no crawl time; a fixed one keeps the archives repeatable.
CRAWLED = "2000-01-01T00:00:00Z"
LEVEL = 6
# A gzip member of less than 2**24 bytes ends with a zero byte, see ``_write_shards``.
MEMBER_BYTES = (1 << 24) - 1
MANIFEST = "manifest"
MANIFEST_COLUMNS = "file string, records long, bytes long, first_page_id long, last_page_id long"
ORDER = ["page_id", "alike", "row"]


def gzip_members(data: bytes, most: int = MEMBER_BYTES) -> bytes:
    """``data`` as gzip members of at most ``most`` bytes each, without a time in their heads."""
    out = []
    for at in range(0, len(data), most):
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        out += [packer.compress(data[at : at + most]), packer.flush()]
    return b"".join(out)


def sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(name: str) -> str:
    return uuid.UUID(bytes=hashlib.sha256(name.encode()).digest()[:16], version=5).urn


def record(kind: str, name: str, block: bytes, content_type: str, headers: list[tuple[str, str]], date: str = CRAWLED) -> bytes:
    """One WARC record; control characters and blanks in a header's value are written as %XX."""
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id(name)}>"), ("WARC-Date", date), *headers]
    fields += [("WARC-Block-Digest", sha1_label(block)), ("Content-Type", content_type), ("Content-Length", str(len(block)))]
    lines = [f"{k}: {re.sub('[\x00-\x20\x7f]', lambda m: f'%{ord(m[0]):02X}', v)}".encode() for k, v in fields]
    return LINE.join([VERSION, *lines]) + END + block + END


def page_record(page_id: int | None, url: str | None, payload: bytes, content: str, refers_to: int | None, date: str = CRAWLED) -> bytes:
    """The response record of a page, or the revisit record that points to the page ``refers_to``.

    A page without a url is at ``about:blank``. A record's id follows from its page
    and payload, so rows alike in both share one.
    """
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Target-URI", url or "about:blank"), ("WARC-Payload-Digest", sha1_label(payload))]
    if page_id is not None:
        headers.append(("Page-ID", str(page_id)))
    kind, block = "response", head + payload
    if refers_to is not None:
        kind, block = "revisit", head
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{record_id(f'{refers_to}:{content}')}>"), ("Refers-To-Page-ID", str(refers_to))]
    return record(kind, f"{page_id}:{content}", block, "application/http;msgtype=response", headers, date)


def with_originals(pages: DataFrame, least: int = LEAST_REVISITED) -> DataFrame:
    """(page_id, url, payload, content, refers_to): of equal payloads of at least ``least`` bytes, all but the largest page_id refer to it.

    ``content`` is the payload's SHA-256. The copies are counted before they are
    shuffled, and only payloads that occur twice are joined, broadcast if measured
    small and sliced otherwise.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = small_batches(pages).select(F.col("page_id").cast("long"), "url", payload.alias("payload")).withColumn("content", F.sha2("payload", 256))
    groups = rows.where(F.octet_length("payload") >= least).groupBy("content")
    originals = groups.agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1 and original is not null")
    joined = lookup_join(rows, originals.drop("n"), ["content"], "left")
    older = F.col("page_id").isNull() | (F.col("page_id") < F.col("original"))
    return joined.select("page_id", "url", "payload", "content", F.when(older, F.col("original")).alias("refers_to"))


def _packed(pages: DataFrame, date: str) -> DataFrame:
    """The records as gzip members, with what they are sorted by; ``row`` tells rows alike in that apart."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                page_id, url, payload, content, refers_to = (c.to_pylist() for c in batch.slice(at, 100).columns)
                members = [gzip_members(page_record(*row, date)) for row in zip(page_id, url, payload, content, refers_to)]
                alike = [hashlib.sha256(f"{c}{u}".encode()).hexdigest() for c, u in zip(content, url)]
                columns = [pa.array(page_id, pa.int64()), pa.array(alike), pa.array(members, pa.binary()), pa.array(map(len, members), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "alike", "member", "size"])

    packed = pages.mapInArrow(pack, "page_id long, alike string, member binary, size long")
    return stored(packed.withColumn("row", F.monotonically_increasing_id()), "warc-members")


def _shards(records: DataFrame, roll_bytes: int) -> DataFrame:
    """(shard, first, records, bytes, first_page_id, last_page_id): where in the order each shard begins.

    Only the sort keys and sizes are moved for this, never the records.
    """
    ranges = records.select(*ORDER, "size").repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far = 0
        for batch in batches:
            sizes = np.asarray(batch.column(3)).astype(np.int64)
            ends = so_far + np.cumsum(sizes)
            so_far = int(ends[-1]) if len(ends) else so_far
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends - sizes)], [*ORDER, "size", "part", "within"])

    placed = ranges.select(*ORDER, "size", F.spark_partition_id().alias("part"))
    pinned = stored(placed.mapInArrow(count, "page_id long, alike string, row long, size long, part int, within long"), "warc-order")
    sizes = pinned.groupBy("part").agg(F.sum("size").alias("bytes"))
    # one row per partition, so the window without a partitioning stays tiny
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("offset"))
    start = F.col("offset") + F.col("within")
    numbered = pinned.join(F.broadcast(offsets), "part").withColumn("shard", F.floor(start / F.lit(roll_bytes)))
    return numbered.groupBy("shard").agg(
        F.min(F.struct(*ORDER)).alias("first"), F.count(F.lit(1)).alias("records"), F.sum("size").alias("bytes"),
        F.min("page_id").alias("first_page_id"), F.max("page_id").alias("last_page_id"),
    )


def shard_name(prefix: str, shard: int) -> str:
    return f"{prefix}-{shard:08d}.warc.gz"


def shard_head(name: str, date: str) -> bytes:
    """The warcinfo record that begins a shard, as a gzip member."""
    block = b"software: shelfmark\r\nformat: WARC File Format 1.1\r\n"
    return gzip_members(record("warcinfo", name, block, "application/warc-fields", [("WARC-Filename", name)], date))


def _write_shards(records: DataFrame, firsts: list[tuple[int, tuple]], heads: DataFrame, folder: str) -> None:
    """One file per shard, its members in order.

    The records find their shard by where these begin in the order, and are moved
    once. The text writer puts a separator after each value. A member's last byte
    is the highest of its length, which is zero; it is left out of the value and
    stands as the separator, so the files hold the members and nothing else.
    """
    shards, begins = [n for n, _ in firsts], [key for _, key in firsts]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(*(c.to_pylist() for c in batch.columns[:3]))
            found = [shards[bisect_right(begins, _sort_key(*key)) - 1] for key in keys]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], [*ORDER, "member", "shard"])

    dealt = records.select(*ORDER, "member").mapInArrow(find, "page_id long, alike string, row long, member binary, shard long")
    # a head has neither, and so stands before all pages, with and without a page_id
    rows = dealt.withColumn("later", F.lit(True)).unionByName(heads.withColumn("later", F.lit(False)), allowMissingColumns=True)
    value = F.substring(F.col("member"), F.lit(1), F.octet_length("member") - 1).cast("string")
    ordered = rows.repartition("shard").sortWithinPartitions("shard", "later", *ORDER).select(value.alias("value"), "shard")
    ordered.write.partitionBy("shard").option("maxRecordsPerFile", 0).text(folder, lineSep="\0", compression="none")


def _sort_key(page_id: int | None, alike: str, row: int) -> tuple:
    return page_id is not None, page_id or 0, alike, row


def write_archives(pages: DataFrame, path: str, roll_bytes: int = ROLL_BYTES, prefix: str = "pages", date: str = CRAWLED) -> DataFrame:
    """Writes a record for every row of ``pages`` (page_id, url, html) and returns the manifest.

    The records are sorted by page_id, nulls first, then by a digest of payload and
    url. A shard holds the records that begin within ``roll_bytes`` compressed
    bytes, so a record is never cut; where one is larger than that, a number is
    left out. The shards are written into a folder of a temporary name, renamed one
    by one, and count once the manifest (file, records, bytes, first_page_id,
    last_page_id) stands, which is renamed last. An archive that has one is not
    written again. Of each shard, the name, the size and where it begins go
    through the driver, some hundred bytes.

    A null html is an empty payload; texts may be of any length up to a row's 2
    GB. Repeated rows are records of their own; rows with the largest page_id of
    their payload are all responses, and those without a page_id revisit it. Other
    columns are ignored. An empty table gives a manifest without rows.
    """
    spark = pages.sparkSession
    if folders.exists(spark, f"{path}/{MANIFEST}"):
        raise FileExistsError(f"{path} holds a finished archive")
    records = _packed(with_originals(pages), date)
    found = _shards(records, roll_bytes).orderBy("shard").collect()
    heads = [(r.shard, bytearray(shard_head(shard_name(prefix, r.shard), date))) for r in found]
    attempt = f"{path}/_attempt-{uuid.uuid4().hex}"
    firsts = [(r.shard, _sort_key(*r["first"])) for r in found]
    _write_shards(records, firsts, spark.createDataFrame(heads, "shard long, member binary"), f"{attempt}/shards")
    listed = []
    for r, (_, head) in zip(found, heads):
        name, size = shard_name(prefix, r.shard), r.bytes + len(head)
        parts = folders.matching(spark, f"{attempt}/shards/shard={r.shard}/part-*")
        if [length for _, length in parts] != [size]:
            raise OSError(f"{name} was not written as one file of {size} bytes")
        folders.move(spark, parts[0][0], f"{path}/{name}")
        listed.append((name, r.records, size, r.first_page_id, r.last_page_id))
    spark.createDataFrame(listed, MANIFEST_COLUMNS).write.parquet(f"{attempt}/{MANIFEST}")
    folders.move(spark, f"{attempt}/{MANIFEST}", f"{path}/{MANIFEST}")
    folders.remove(spark, attempt)
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_COLUMNS).parquet(f"{path}/{MANIFEST}")


def _headers(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in lines.split(LINE)[1:])
    return {k.decode().lower(): v.strip().decode() for k, _, v in pairs}


def parse_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a stream, its length and block digest checked."""
    buffer = bytearray()
    for chunk in chunks:
        buffer += chunk
        at = 0
        while (cut := buffer.find(END, at)) >= 0:
            if not buffer.startswith(VERSION + LINE, at):
                raise ValueError("a record does not begin where the last one ended")
            headers = _headers(bytes(buffer[at:cut]))
            begin = cut + len(END)
            end = begin + int(headers["content-length"])
            if len(buffer) < end + len(END):
                break
            block = bytes(buffer[begin:end])
            if buffer[end : end + len(END)] != END or headers["warc-block-digest"] != sha1_label(block):
                raise ValueError(f"record {headers.get('warc-record-id')} is damaged")
            yield headers, block
            at = end + len(END)
        del buffer[:at]
    if buffer:
        raise ValueError("the archive ends within a record")


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of the pages in the manifest's shards.

    Each shard is read as a stream by one task, which holds a record at a time and
    checks every digest. The digest is bare lower-case hex; a revisit has no
    payload, and the length and digest of the one it refers to. Without
    ``payloads`` that column is left out.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = [f.split()[0] for f in schema.split(", ")]
    if payloads:
        schema, kinds, names = f"{schema}, payload binary", [*kinds, pa.binary()], [*names, "payload"]
    files = [f"{path}/{row.file}" for row in read_manifest(spark, path).select("file").toLocalIterator()]
    if not files:
        return spark.createDataFrame([], schema)

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        lines = (b"\n".join([*batch.column(0).to_pylist(), b""]) for batch in batches)
        for headers, block in parse_records(lines):
            if headers["warc-type"] not in ("response", "revisit"):
                continue
            head, _, payload = block.partition(END)
            size = int(_headers(head)["content-length"])
            label = headers["warc-payload-digest"]
            is_response = headers["warc-type"] == "response"
            if is_response and (size != len(payload) or label != sha1_label(payload)):
                raise ValueError(f"the payload of {headers['warc-record-id']} is damaged")
            page_id, refers_to = (headers.get(k) for k in ("page-id", "refers-to-page-id"))
            yield (
                None if page_id is None else int(page_id), headers["warc-target-uri"], size,
                base64.b32decode(label.removeprefix("sha1:")).hex(), headers["warc-type"],
                None if refers_to is None else int(refers_to), payload if is_response else None,
            )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        for row in pages(batches):
            out.append(row[: len(kinds)])
            size += row[2] if payloads else 0
            if len(out) == 1_000 or size > 4_000_000:
                yield batch()
                out, size = [], 0
        if out:
            yield batch()

    text = spark.read.text(files, lineSep="\n").select(F.col("value").cast("binary"))
    return small_batches(text).mapInArrow(read, schema)


def digest(archived: DataFrame) -> DataFrame:
    """What the query returns of the pages read back."""
    return archived.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
