"""WARC archives: round trip, members, index, awkward rows."""

from __future__ import annotations

import gzip
import json
import os

from helpers import same

from phenomill.llm import warc


def test_archive_round_trip(spark, tmp_path, frame):
    rows = [(i, f"http://x/{i}\r\nEvil: 1", ["<p>a</p>", None, "", "é\r\n\r\nWARC/1.1\r\n", "z" * 100_000][i % 5]) for i in range(40)]
    rows += [(None, None, "<p>a</p>"), (None, "u", "only"), (5, "again", "<p>other</p>")]
    df = frame("page_id long, url string, html string", *rows).selectExpr("*", "'x' AS key", "1 AS size").repartition(3)
    warc.write_archives(df, f"{tmp_path}/streams", records_per_file=10)
    index = warc.normalise(spark, f"{tmp_path}/streams", f"{tmp_path}/members")
    mine = sorted((tuple(r) for r in warc.read_records(index).drop("payload", "url").collect()), key=str)
    stays: dict = {}
    for key, _, html in rows:
        if key is not None:
            stays[html or ""] = max(stays.get(html or "", key), key)
    expected = []
    for key, _, html in rows:
        body = (html or "").encode()
        other = stays.get(html or "") if stays.get(html or "") != key else None
        expected.append((key, "revisit" if other is not None else "response", other, len(body), warc.base32_sha1(body)))
    assert mine == sorted(expected, key=str)
    # each record is a member of its own, where the index beside the archive says
    for entry in index.select("archive").distinct().collect():
        path = entry.archive.removeprefix("file:").replace("//", "/")
        data = open(path, "rb").read()
        side = [json.loads(x) for x in open(path + ".idx")]
        assert sum(x["length"] for x in side) == len(data) and len(side) <= 10
        for x in side:
            record = gzip.decompress(data[x["offset"] : x["offset"] + x["length"]])
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n") and b"\nEvil" not in record
    assert not [f for f in os.listdir(f"{tmp_path}/members") if "part." in f or f.endswith(".part")]


def test_least_bytes(frame):
    df = frame("page_id long, url string, html string", (1, "a", "x"), (2, "b", "x"), (3, "c", "xxxx"), (4, "d", "xxxx"))
    same(warc.archived_pages(df, least_bytes=2).select("page_id", "refers_to").collect(), {1: (None,), 2: (None,), 3: (4,), 4: (None,)})


def test_no_pages(spark):
    assert warc.archived_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_inflate_members():
    data = gzip.compress(b"a" * 10) + gzip.compress(b"b" * 10)
    assert b"".join(warc.inflated(data[i : i + 7] for i in range(0, len(data), 7))) == b"a" * 10 + b"b" * 10
