import gzip
import hashlib
import os
import random

import pytest

from shelfmark.llm import warc

SCHEMA = "page_id long, url string, html string, size long, content string, tie int, shard int, start long"


@pytest.fixture
def pages(spark):
    """Pages with extra columns whose names the operator uses itself."""

    def make(rows):
        return spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], SCHEMA)

    return make


HOSTILE = [
    None, "", "plain", "\r\n", "\r\n\r\n", "\n\n\r\r\r\n", "ends with \r\n", "\0\0\x1f\x8b\x08\0", "é\U0001f600﻿",
    "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n",
    "HTTP/1.1 200 OK\r\nContent-Length: 0\r\n\r\n", "x" * 999, "x" * 1000, "é" * 500, "é" * 499, "long " * 60_000,
]
URLS = ["http://a/", "http://a/\r\nWARC-Type: revisit", "http://é/ b\t", "", None, "http://a/" + "b" * 5_000]


def hostile_pages(copies=3, seed=0):
    rng = random.Random(seed)
    rows = [(i * 7 % 101, rng.choice(URLS), html) for i, html in enumerate(HOSTILE * copies)]
    return [*rows, (None, "http://n/", "x" * 1000), (None, "http://n/", "y" * 2000), *[(500, "http://r/", "z" * 1500)] * 3]


def expected(rows):
    largest = {}
    for page_id, _, html in rows:
        if page_id is not None:
            largest[html or ""] = max(page_id, largest.get(html or "", page_id))
    out = []
    for page_id, _, html in rows:
        data, original = (html or "").encode(), largest.get(html or "")
        revisits = len(data) >= 1000 and original is not None and (page_id is None or page_id < original)
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisits else "response", original if revisits else None))
    return sorted(out, key=repr)


def files(path):
    names = sorted(n for n in os.listdir(path) if n.endswith(".warc.gz"))
    return {n: open(f"{path}/{n}", "rb").read() for n in names}


def test_pages_come_back_whole(spark, pages, rows, tmp_path):
    given = hostile_pages()
    path = str(tmp_path / "a")
    warc.write_archives(pages(given), path)
    back = warc.read_archives(spark, path)
    assert rows(warc.digest(back)) == expected(given)
    responses = sorted((r.page_id is not None, r.page_id, bytes(r.payload)) for r in back.collect() if r.payload is not None)
    want = {(p, (h or "").encode()) for p, _, h in given}
    assert {(p, data) for _, p, data in responses} <= want
    assert {data for _, _, data in responses} == {data for _, data in want}
    assert warc.read_archives(spark, path, payloads=False).columns == back.columns[:-1]


def test_files_do_not_depend_on_partitions_and_roll_by_their_size(spark, pages, rows, tmp_path):
    given, roll = hostile_pages(copies=6), 1_500
    table = pages(given)
    one = warc.write_archives(table.repartition(1), str(tmp_path / "one"), roll)
    many = warc.write_archives(table.orderBy("html").repartition(23), str(tmp_path / "many"), roll)
    a, b = files(tmp_path / "one"), files(tmp_path / "many")
    assert a == b and len(a) > 3 and rows(one) == rows(many)
    manifest = {r.file: r for r in one.collect()}
    assert {n: len(data) for n, data in a.items()} == {n: r.bytes for n, r in manifest.items()}
    ids, total = [], 0
    for name, data in a.items():
        found = list(warc.parse_records(iter([gzip.decompress(data)])))
        assert [h["warc-type"] for h, _ in found].count("warcinfo") == 1 and found[0][0]["warc-filename"] == name
        assert len(found) == manifest[name].records + 1
        sizes = [len(m) for m in members(data)[1:]]
        total += sum(sizes)
        # all but the last record of a file begin before its end
        assert sum(sizes[:-1]) < roll and int(name.split("-")[1].split(".")[0]) == (total - sizes[-1]) // roll
        ids += [int(h.get("page-id", -1)) for h, _ in found[1:]]
    assert ids == sorted(ids) and len(ids) == len(given)
    assert not [n for n in os.listdir(tmp_path / "one") if n.startswith("_")]


def members(data):
    """The gzip members of a file, one by one."""
    import zlib

    out = []
    while data:
        unpack = zlib.decompressobj(31)
        unpack.decompress(data)
        assert unpack.eof
        out.append(data[: len(data) - len(unpack.unused_data)])
        data = unpack.unused_data
    return out


def test_each_record_is_a_member_and_a_long_one_is_several():
    data = random.Random(1).randbytes(5_000)
    packed = warc.gzip_members(data, 1_024)
    assert len(members(packed)) == 5 and gzip.decompress(packed) == data and packed[-1] == 0
    assert len(members(warc.gzip_members(b"x" * 100))) == 1


def test_headers_can_not_be_forged():
    text = warc.page_record(1, "http://a/\r\nWARC-Type: revisit\r\n\r\n", b"body", "c", None)
    ((headers, block),) = warc.parse_records(iter([text]))
    assert headers["warc-type"] == "response" and headers["warc-target-uri"] == "http://a/%0D%0AWARC-Type:%20revisit%0D%0A%0D%0A"
    assert block.endswith(b"\r\n\r\nbody")


def test_records_are_found_however_the_stream_is_cut():
    data = [warc.page_record(i, "http://a/", (h or "").encode(), "c", None) for i, h in enumerate(HOSTILE[:12])]
    whole = b"".join(data)
    for step in (1, 7, 1000):
        found = list(warc.parse_records(whole[i : i + step] for i in range(0, len(whole), step)))
        assert [int(h["page-id"]) for h, _ in found] == list(range(12))


def test_damage_is_noticed():
    text = warc.page_record(1, "http://a/", b"body", "c", None)
    for broken in (text[:-3], text.replace(b"body", b"bodi"), text + b"more"):
        with pytest.raises(ValueError):
            list(warc.parse_records(iter([broken])))


def test_revisits_name_the_record_they_refer_to(spark, pages, tmp_path):
    path = str(tmp_path / "a")
    warc.write_archives(pages([(1, "http://a/", "x" * 1000), (9, "http://b/", "x" * 1000)]), path)
    (data,) = files(path).values()
    (_, (old, old_block), (new, _)) = warc.parse_records(iter([gzip.decompress(data)]))
    assert old["warc-refers-to"] == new["warc-record-id"] and old["warc-payload-digest"] == new["warc-payload-digest"]
    assert old_block.endswith(b"Content-Length: 1000\r\n\r\n") and old["warc-profile"] == warc.PROFILE


def test_only_the_manifest_s_files_count(spark, pages, rows, tmp_path):
    path = str(tmp_path / "a")
    os.makedirs(path)
    # what a run that broke off left: a shard of a name to come, and one beyond
    for number in (0, 77):
        with open(f"{path}/{warc.shard_name('pages', number)}", "wb") as file:
            file.write(warc.gzip_members(warc.page_record(99, "http://old/", b"old", "c", None)))
    warc.write_archives(pages([(1, "http://a/", "new")]), path)
    assert [r[0] for r in rows(warc.read_archives(spark, path))] == [1]
    with pytest.raises(FileExistsError):
        warc.write_archives(pages([(2, "http://a/", "newer")]), path)


def test_an_empty_table_gives_an_empty_archive(spark, pages, tmp_path):
    path = str(tmp_path / "a")
    assert warc.write_archives(pages([]), path).collect() == []
    assert warc.read_archives(spark, path).collect() == []
