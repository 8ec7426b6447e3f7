from __future__ import annotations

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from parcelspark.llm import warc
from parcelspark.llm.common import new_path

PAGES = [
    (1, "http://a/ b\r\nX", "a\r\n\r\nb\r\n"),
    (2, None, None),
    (3, "x", ""),
    (4, "http://www.E.com:80", "\r\n"),
    (5, "u", "a\r\n\r\nb\r\n"),
    (None, "u", "q"),
    (None, "u", "a\r\n\r\nb\r\n"),
    (7, "u", "\r"),
    (8, "http://[bad", "x\r"),
    (9, "u", "\n\r\r\nWARC/1.1\r\n\r\n"),
    (10, "u", "é😀" * 100_000),
    (11, "u", "twice"),
    (11, "u", "twice"),
]


def index(spark, rows, **options):
    path = new_path(spark, "warc")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("Digest", F.lit(1))
    warc.write_archives(pages, path, F.timestamp_seconds("page_id"), **options)
    return warc.read_archives(spark, path)


def test_records_come_back_whole(spark):
    found = warc.merged_index(index(spark, PAGES), rows_per_range=3).collect()
    assert len(found) == len(PAGES)
    largest = {}
    for page, _, html in PAGES:
        if page is not None:
            largest[html or ""] = max(largest.get(html or "", page), page)
    expected = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        best = largest.get(html or "", page)
        expected.append((page, len(data), digest, "response" if best == page else "revisit", None if best == page else best))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_index_is_in_one_order(spark):
    rows = [(i, f"http://h{i % 5}.org/{i % 3}", f"p{i}") for i in range(400)]
    found = warc.merged_index(index(spark, rows), rows_per_range=50).toPandas().sort_values("position")
    keys = list(zip(found.url_key, found.captured, found.page_id))
    assert keys == sorted(keys) and found.range.nunique() > 1
    assert found.position.tolist() == list(range(400)) and found.range.is_monotonic_increasing


def test_runs_that_hold_more_than_a_batch_are_merged_whole(spark):
    rows = [(i, f"http://h{i * 7919 % 900}.org/", f"p{i % 700}") for i in range(6_000)]
    both = index(spark, rows[::2]).union(index(spark, rows[1::2]))
    found = warc.merged_index(both).toPandas().sort_values("position")
    keys = list(zip(found.url_key, found.captured, found.page_id))
    assert keys == sorted(keys) and sorted(found.page_id) == list(range(6_000))
    assert found.run.nunique() > 1 and found.range.nunique() == 1


def test_small_payloads_need_not_be_revisits(spark):
    found = index(spark, [(1, "u", "aa"), (2, "u", "aa"), (3, "u", "aaaa"), (4, "u", "aaaa")], least_bytes=3).collect()
    assert {r.page_id: r.record_type for r in found} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_empty_table(spark):
    assert warc.merged_index(index(spark, PAGES).limit(0)).count() == 0


def test_loser_tree_merges_any_runs():
    draw = random.Random(2)
    for _ in range(500):
        runs = [sorted((draw.randrange(9), i) for i in range(draw.randrange(5))) for _ in range(draw.randrange(8))]
        assert list(warc.loser_tree(runs, lambda x: x)) == sorted(x for run in runs for x in run)


def test_damaged_archives_are_refused():
    lines = [("f", x) for x in ("WARC/1.1", "Content-Length: 3", "", "abcdef", "", "")]
    with pytest.raises(ValueError):
        list(warc._records(iter(lines)))
    with pytest.raises(ValueError):
        list(warc._records(iter(lines[:3])))
    with pytest.raises(ValueError):
        list(warc._records(iter([("f", "junk")])))


@pytest.mark.parametrize(
    ("url", "key"),
    [("http://www.Example.com/A?b=1", "com,example)/a?b=1"), ("https://x.org:443", "org,x)/"), ("x", "x"), ("http://h:8080/p", "h:8080)/p")],
)
def test_url_key(url, key):
    assert warc.url_key(url) == key
