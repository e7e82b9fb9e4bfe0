import hashlib
import random
from collections import Counter

import pytest

from topicweave.llm import suffix_dedup as sd


def brute(texts, span=200):
    seen = Counter()
    for t in texts:
        for i in range(len(t) - span + 1):
            seen[t[i : i + span]] += 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - span + 1):
            if seen[t[i : i + span]] > 1:
                gone[i : i + span] = b"\1" * span
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def run(spark, docs, monkeypatch=None, **options):
    import topicweave.llm.suffix_dedup as m

    rows = docs.select("doc_id", "text").collect()
    want = Counter((r.doc_id, *b) for r, b in zip(rows, brute([(r.text or "").encode() for r in rows]), strict=True))
    real, read = m.removed_repeats, m.read_table
    try:
        m.read_table = lambda *a: docs
        m.removed_repeats = lambda s, d: real(s, d, **options)
        got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in m.op3_deep_shallow(spark, "").collect())
    finally:
        m.removed_repeats, m.read_table = real, read
    assert got == want


@pytest.mark.parametrize("large", [20_000, 1, 0])
def test_sample_and_tricky_equal_brute_force(spark, sample, tricky, large):
    run(spark, tricky, large=large)
    if large != 1:
        run(spark, sample, large=large)


def test_shared_passages_with_different_edges(spark):
    rnd = random.Random(3)
    junk = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    p, q = junk(260), junk(450)
    texts = [junk(rnd.randrange(300)) + p[rnd.randrange(40) :] + junk(rnd.randrange(300)) for _ in range(25)]
    texts += [junk(50) + q[rnd.randrange(240) : 460 - rnd.randrange(200)] + junk(50) for _ in range(25)]
    texts += ["ab" * 300, "z" * 700, q + q]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    run(spark, docs)
    run(spark, docs, large=3)


def test_long_text_over_several_parts(spark, monkeypatch):
    monkeypatch.setattr(sd, "PART", 700)
    rnd = random.Random(9)
    texts = ["".join(rnd.choice("abcd") for _ in range(rnd.randrange(4000))) for _ in range(6)]
    texts.append(texts[0][500:2500] + texts[1][:900])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    run(spark, docs)


def test_deep_shallow_order_and_prefixes():
    rnd = random.Random(1)
    strings = [bytes(rnd.choice(b"ab\0") for _ in range(rnd.randrange(60))) for _ in range(300)]
    strings += [b"a" * n for n in range(40)] * 2
    import numpy as np

    group = np.array([rnd.randrange(3) for _ in strings])
    order, shared = sd.deep_shallow(strings, group)
    assert [(group[i], strings[i]) for i in order] == sorted((g, s) for g, s in zip(group, strings, strict=True))
    for a, b, n in zip(order[:-1], order[1:], shared[1:], strict=True):
        want = -1 if group[a] != group[b] else len([1 for k in range(min(len(strings[a]), len(strings[b]))) if strings[a][: k + 1] == strings[b][: k + 1]])
        assert n == want


def test_empty(spark, empty):
    run(spark, empty)


def test_multikey_quicksort_buckets_are_in_order():
    rnd = random.Random(11)
    strings = [bytes(rnd.choice(b"ab\0") for _ in range(rnd.randrange(90))) for _ in range(500)] + [b"q" * 80] * 3 + [b""] * 2
    for shallow in (16, 64):
        buckets = list(sd.multikey_quicksort(strings, list(range(len(strings))), shallow))
        assert sorted(i for b in buckets for i in b) == list(range(len(strings)))
        firsts = [strings[b[0]][:shallow] for b in buckets]
        assert firsts == sorted(firsts)
        for b in buckets:
            assert len({strings[i][:shallow] for i in b}) == 1


def crowd(n=60):
    """One passage in many texts: its edges make groups of ``n`` runs."""
    rnd = random.Random(12)
    junk = lambda k: "".join(rnd.choice("abcdefgh ") for _ in range(k))
    passage = junk(700)
    return [(i, junk(rnd.randrange(250)) + passage + junk(rnd.randrange(250))) for i in range(n)]


@pytest.mark.parametrize("large", [20_000, 8])
def test_the_sort_decides_every_removed_byte(spark, monkeypatch, large):
    docs = spark.createDataFrame(crowd(), "doc_id long, text string").repartition(3)
    real, groups = sd.sorted_repeats, []

    def seen(items, span=sd.SPAN):
        groups.append([r["count"] for r in items.groupBy("key").count().collect()])
        return real(items, span)

    monkeypatch.setattr(sd, "sorted_repeats", seen)
    run(spark, docs, large=large)
    sizes = [max(g, default=0) for g in groups]
    # groups of all texts reach the sort, or are split by content until they fit
    assert sizes[0] >= 60 if large > 60 else len(sizes) > 1 and max(sizes) <= large
    monkeypatch.setattr(sd, "sorted_repeats", lambda items, span=sd.SPAN: real(items.where("false"), span))
    assert sd.removed_repeats(spark, docs, large=large).count() == 0


def test_split_groups_keep_what_windows_share(spark):
    """Every window that two strings share has one group for both."""
    rnd = random.Random(13)
    rows = []
    core = bytes(rnd.choice(b"xyz") for _ in range(400))
    for i in range(30):
        lo, hi = sorted(rnd.randrange(0, 169) for _ in range(2))
        text = bytearray(core)
        for _ in range(rnd.randrange(3)):
            text[rnd.randrange(400)] = 33
        at = 200
        rows.append((b"%d" % i, b"k", 1, lo, hi, bytes(text[at - hi : at])[::-1], bytes(text[at : at + 200 - lo])))
    items = spark.createDataFrame(rows, sd.ITEM_SCHEMA)
    for width in sd.RANGES:
        parts = sd.split_groups(items, width).collect()
        keys = {}
        for p in parts:
            for d in range(p.lo, p.hi + 1):
                assert (p.parent, d) not in keys
                keys[p.parent, d] = p.key, p.left[:d], p.right[: 200 - d]
        for i, _, _, lo, hi, left, right in rows:
            assert {d for x, d in keys if x == i} == set(range(lo, hi + 1))
            for j, _, _, lo2, hi2, left2, right2 in rows:
                for d in range(max(lo, lo2), min(hi, hi2) + 1):
                    if left[:d] == left2[:d] and right[: 200 - d] == right2[: 200 - d]:
                        assert keys[i, d] == keys[j, d]
