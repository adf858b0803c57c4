"""Operators on pages against brute force, and on edge cases."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.llm import queries as Q
from strata.llm import url_bloom, warc_index
from strata.llm.common import table
from strata.session import state_path
from tests.conftest import SMOKE_SF

PAGE = "page_id long, url string, html string"
SAME = "<p>" + "equal " * 300 + "é</p>"
ROWS = [
    (1, "http://a.example.org/x", SAME),
    (2, "https://www.a.example.org/x/", SAME),
    (3, "http://b.example.com/de/1", "short"),
    (4, "http://b.example.com/de/2", "short"),
    (5, None, None),
    (6, "no scheme", ""),
    (7, "http://A.example.org/x?b=2&utm_source=feed&a=1#top", SAME),
    (7, "http://A.example.org/x?b=2&utm_source=feed&a=1#top", SAME),
    (None, "http://c.example.org/a b\r\nc", SAME),
    (None, None, "x" * 200_000),
    (8, "http://d.example.net", "x" * 1000),
    (9, "http://d.example.net?q", "x" * 999),
    (10, "http://d.example.net/?q", "x" * 1000),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, PAGE)


def archive_by_hand(rows):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [i for i, _, h in rows if (h or "").encode() == data and i is not None]
        of = max(same, default=None) if len(data) >= 1000 else None
        revisit = of is not None and page_id != of
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", of if revisit else None))
    return Counter(out)


def read_back(spark, pages):
    captures, shards = warc_index.archive(spark, pages)
    return captures, shards, warc_index.lookup(captures, shards)


def test_warc_round_trip(spark, pages):
    rows = [tuple(r) for r in table(spark, SMOKE_SF, "pages").select("page_id", "url", "html").collect()]
    assert Counter(map(tuple, Q.op7_warc(spark, SMOKE_SF).collect())) == archive_by_hand(rows)
    captures, _, out = read_back(spark, pages)
    assert Counter(map(tuple, out.collect())) == archive_by_hand(ROWS)
    extra = pages.select("*", *[F.lit(1).alias(n) for n in ("key", "digest", "size", "of", "file", "length")])
    assert Counter(map(tuple, read_back(spark, extra)[2].collect())) == archive_by_hand(ROWS)
    assert read_back(spark, pages.where("false"))[2].count() == 0
    kinds = Counter(r.record_type for r in captures.collect())
    assert kinds == {"response": 9, "revisit": 4}


def test_warc_of_two_payloads_under_one_key(spark):
    """Rows that share page_id and URL are captures of one key; a revisit finds the one with its payload."""
    x, y, u = "x" * 1500, "y" * 1500, "http://u.example.org/"
    rows = [(9, u, x), (9, u, y), (3, "http://v.example.org/", y), (4, "http://w.example.org/", x), (9, u, "short")]
    got = read_back(spark, spark.createDataFrame(rows, PAGE))[2].collect()
    assert Counter(map(tuple, got)) == archive_by_hand(rows)


def test_index_lookup_by_address(spark):
    """Few lines a block, several shards: every address finds all of its captures and no others."""
    rows = [(i, f"http://h{i % 7}.example.org/p{i % 30}", f"body {i}") for i in range(300)]
    folder = state_path(spark, "warc-test")
    docs = spark.createDataFrame(rows, PAGE).repartition(5)
    captures = warc_index.write_archives(docs, f"{folder}/a", file_bytes=2000)
    shards = warc_index.write_index(captures, f"{folder}/i", block_lines=4)
    index = warc_index.Index([tuple(r) for r in shards.collect()])
    for host in range(7):
        for path in range(30):
            address = f"org,example,h{host})/p{path}"
            found = sorted(int(f["WARC-Record-ID"][10:-1]) for f, _ in index.records(address + " ", address + " ~"))
            assert found == [i for i in range(300) if i % 7 == host and i % 30 == path]
    wanted = spark.createDataFrame([("org,example,h3)/p3",), ("org,example,h9)/p3",)], "key string")
    got = warc_index.lookup(wanted, shards).collect()
    assert sorted(r.page_id for r in got) == [i for i in range(300) if i % 7 == 3 and i % 30 == 3]


def test_records_are_plain_warc(spark, pages):
    import gzip

    folder = state_path(spark, "warc-plain")
    captures = warc_index.write_archives(pages, folder).collect()
    for name in {r.file for r in captures}:
        raw = open("/" + name.removeprefix("file:").lstrip("/"), "rb").read()
        assert gzip.decompress(raw).count(b"WARC/1.1\r\nWARC-Type: ") == sum(r.file == name for r in captures)


def parts_by_hand(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match("[^?#]*", rest[len(host) :])[0]


def rule_by_hand(host, path):
    fits = [r for r in Q.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def test_url_filter(spark, pages):
    rows = {r.page_id: r.url for r in table(spark, SMOKE_SF, "pages").collect()}
    got = Q.op10_url_filter(spark, SMOKE_SF).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = parts_by_hand(rows[r.page_id])
        rule = rule_by_hand(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule.name if rule else None)
        assert r.verdict == (rule.verdict if rule else "block" if r.listed else "allow")
    listed = spark.createDataFrame([("https://a.example.org/x?a=1&b=2",), (None,), ("no scheme",), ("http://d.example.net/",)], "url string")
    got = Counter((r.page_id, r.listed, r.verdict) for r in url_bloom.filter_urls(pages, listed).collect())
    yes = {7, 8}
    assert got == Counter((i, i in yes, "block" if i in yes else "allow") for i, _, _ in ROWS)
    assert url_bloom.filter_urls(pages, listed.where("false")).where("listed").count() == 0
    assert url_bloom.filter_urls(pages.where("false"), listed).count() == 0
    extra = pages.select("*", *[F.lit(i).alias(n) for i, n in enumerate("host path rule listed block word0 canonical _url bits1".split())])
    assert Counter((r.page_id, r.listed, r.verdict) for r in url_bloom.filter_urls(extra, listed).collect()) == got


@pytest.mark.parametrize("limit", [0, 32_000_000])
def test_bloom_passes_every_listed_url(spark, limit):
    """Few bits a URL make false positives; the exact join removes them, broadcast or not."""
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.example.org/"), "id").alias("url"))
    listed = pages.where("page_id % 3 = 0").select("url")
    out = url_bloom.filter_urls(pages, listed, bits_per_url=2, broadcast_bytes=limit)
    assert out.count() == 3000 and out.where("listed <> (page_id % 3 = 0)").count() == 0
