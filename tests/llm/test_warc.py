"""Archives written and read back, against the pages themselves."""

import base64
import gzip
import hashlib
import os

import pytest

from tallyfold.llm import warc
from tallyfold.llm.common import new_folder
from tallyfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def expected(pages):
    first = {}
    for i, html in pages:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, html in pages:
        raw = (html or "").encode()
        ref = first.get(html or "")
        ref = None if ref == i else ref
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if ref is not None else "response", ref))
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_query_equals_pages(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert rows(QUERIES["op4_warc"](spark, SF)) == expected(pages)


@pytest.mark.parametrize("archive,gap,span", [(256 << 20, 64 << 10, 4 << 20), (2_000, 0, 10), (500, 300, 1_000)])
def test_round_trip_and_edge_cases(spark, monkeypatch, archive, gap, span):
    for name, value in (("ARCHIVE_BYTES", archive), ("READ_GAP", gap), ("READ_BYTES", span)):
        monkeypatch.setattr(warc, name, value)
    pages = [(1, "u", "<p>é</p>"), (2, None, None), (3, "bad\r\nWARC-Type: x", ""), (0, "u", "<p>é</p>"), (0, "u", "<p>é</p>"),
             (None, "n", "<p>é</p>"), (6, "u6", "a\r\n\r\nb\r\n\r\n" * 50), (7, "", "x" * 300_000), (None, "", "lonely")]
    d = spark.createDataFrame([(i, u, h, "c", 1) for i, u, h in pages], "page_id long, url string, html string, file string, offset int")
    folder = new_folder(spark, "warc-test")
    index = warc.write(d, folder)
    got = warc.read(index, folder)
    assert rows(got) == expected([(i, h) for i, _, h in pages])
    payloads = {r.page_id: bytes(r.payload).decode() for r in got.collect() if r.payload is not None}
    assert payloads[6] == pages[6][2] and payloads[7] == pages[7][2] and payloads[2] == ""
    some = warc.read(index.where("page_id in (6, 3)"), folder).collect()
    assert sorted((r.page_id, r.url) for r in some) == [(3, "bad WARC-Type: x"), (6, "u6")]
    whole = b"".join(gzip.open(os.path.join(folder.removeprefix("file:"), f)).read() for f in os.listdir(folder.removeprefix("file:")) if f.endswith(".gz"))
    assert whole.count(b"WARC/1.1\r\n") == len(pages)


def test_small_payloads_are_responses(spark):
    d = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbb"), (4, "u", "bbb")], "page_id long, url string, html string")
    folder = new_folder(spark, "warc-test")
    kinds = {r.page_id: r.record_type for r in warc.write(d, folder, least=3).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_ranges():
    assert list(warc.ranges([(0, 10), (10, 5), (70_000 + 15, 5), (200_000, 9)])) == [
        (0, 15, [0, 1]), (70_015, 70_020, [2]), (200_000, 200_009, [3])
    ]
