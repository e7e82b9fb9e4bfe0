import base64
import glob
import hashlib
import os
from collections import Counter

import pytest

from topicweave.llm import warc

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def brute(rows):
    first = {}
    for page_id, html in rows:
        key = (page_id is None, page_id or 0, page_id)
        first[html or ""] = min(first.get(html or "", key), key)
    out = Counter()
    for page_id, html in rows:
        raw = (html or "").encode()
        lead = first[html or ""][2]
        own = lead == page_id
        out[(page_id, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if own else "revisit", None if own else lead)] += 1
    return out


def pages(spark):
    texts = ["<p>é漢😀</p>", None, "", "a", "a", "a", FAKE, FAKE + FAKE, "x" + FAKE * 30 + "WARC/1.1\r\n", "WARC/1.1\r\n" * 50, "\r\n\r\n", "\r\n\r\nWARC/1.1\r\n\r\n", "b" * 300_000, "\0\x85 line"]
    rows = [(20 - i, t, "u", 1) for i, t in enumerate(texts)] + [(20, texts[0], "u", 1), (None, "lonely", None, None), (-5, "a", None, None)]
    return spark.createDataFrame(rows, "page_id long, html string, url string, digest int")


@pytest.mark.parametrize("per_file", [1, 3, 2000])
def test_round_trip(spark, scratch, per_file):
    df = pages(spark)
    warc.write_warc(df, scratch + "/w", records_per_file=per_file)
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_warc(spark, scratch + "/w").collect())
    assert got == brute([(r.page_id, r.html) for r in df.collect()])


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.op9_warc_chain(spark, sf).collect())
    assert got == brute(rows)


def test_only_chained_records_count(spark, scratch):
    df = spark.createDataFrame([(1, FAKE * 40)], "page_id long, html string")
    warc.write_warc(df, scratch + "/w")
    assert warc.scan_archives(spark, scratch + "/w").count() == 41
    assert [r.page_id for r in warc.read_warc(spark, scratch + "/w").collect()] == [1]


def test_chains_by_brute_force(spark):
    import random

    rnd = random.Random(8)
    rows, want = [], set()
    for f in range(5):
        links = {}
        for at in range(0, 400, 2):
            if rnd.random() < 0.9:
                links[at] = at + 2 * rnd.randrange(1, 4)
        if f < 4:
            links[0] = 2
        else:
            links.pop(0, None)
        at = 0
        while at in links:
            want.add((f"f{f}", at))
            at = links[at]
        rows += [(f"f{f}", a, b) for a, b in links.items()]
    got = warc.chained(spark.createDataFrame(rows, "file string, at long, next long"))
    assert {(r.file, r.at) for r in got.collect()} == want


def test_small_payloads_can_stay_responses(spark, scratch):
    df = spark.createDataFrame([(i, "same") for i in range(3)], "page_id long, html string")
    warc.write_warc(df, scratch + "/w", min_revisit_bytes=10)
    assert {r.record_type for r in warc.read_warc(spark, scratch + "/w").collect()} == {"response"}


def test_empty(spark, scratch):
    warc.write_warc(spark.createDataFrame([], "page_id long, html string"), scratch + "/w")
    assert warc.read_warc(spark, scratch + "/w").count() == 0


def test_archives_are_bounded_in_bytes(spark, scratch):
    """Long records go into archives of their own; the round trip holds."""
    rows = [(i, "x" * (10 * i) + str(i)) for i in range(60)] + [(100 + i, f"{i}" + "long" * 5000) for i in range(7)] + [(200, "y" * 100_000)]
    df = spark.createDataFrame(rows, "page_id long, html string").coalesce(1)
    warc.write_warc(df, scratch + "/w", tiers=((1000, 10), (50_000, 3), (None, 1)))
    sizes = [os.path.getsize(f) for f in glob.glob(scratch + "/w/part-*")]
    assert max(sizes) < 110_000 and len([n for n in sizes if n > 20_000]) == 4  # 3 + 3 + 1 long ones, and the longest
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_warc(spark, scratch + "/w").collect())
    assert got == brute(rows)


def test_record_headers(spark, scratch):
    rows = [(1, "http://a.example/x y\r\nEvil: 1", "same"), (2, "http://b.example/", "same"), (3, None, "other")]
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), scratch + "/w", written="2024-02-29T01:02:03Z")
    data = b"".join(open(f, "rb").read() for f in glob.glob(scratch + "/w/part-*"))
    heads = [r.split(b"\r\n\r\n")[0].decode().split("\r\n") for r in data.split(b"WARC/1.1\r\n")[1:]]
    heads = [dict(line.split(": ", 1) for line in h) for h in heads]
    by_id = {h["WARC-Record-ID"]: h for h in heads}
    assert all(h["WARC-Date"] == "2024-02-29T01:02:03Z" and "Evil" not in h for h in heads)
    assert by_id["<urn:page:1>"]["WARC-Target-URI"] == "http://a.example/x%20y%20%20Evil:%201"
    assert by_id["<urn:page:3>"]["WARC-Target-URI"] == "urn:page:3"
    assert by_id["<urn:page:2>"]["WARC-Type"] == "revisit" and by_id["<urn:page:2>"]["WARC-Profile"] == warc.REVISIT_PROFILE
    assert by_id["<urn:page:2>"]["WARC-Refers-To"] == "<urn:page:1>" and "WARC-Profile" not in by_id["<urn:page:1>"]


def test_hot_payloads_are_joined_apart(spark, scratch):
    df = pages(spark)
    for hot in (0, 2):
        warc.write_warc(df, f"{scratch}/{hot}", hot=hot)
        got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_warc(spark, f"{scratch}/{hot}").collect())
        assert got == brute([(r.page_id, r.html) for r in df.collect()])
