from collections import defaultdict

from topicweave.llm import mixing as mx
import re


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        got = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        above = [s for s in free if got[s] > most * sizes[s]]
        if not above:
            return {**fixed, **got}
        fixed.update({s: most * sizes[s] for s in above})


def check(spark, docs):
    rows = docs.select("doc_id", "text", "source").collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    got = mx.mix_sources(spark, docs).collect()
    assert len(got) == len(rows)
    want = targets(dict(sizes)) if rows else {}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] + 1
    return sorted(((r.doc_id, r.size, r.taken) for r in got), key=str)


def test_targets_and_words_taken(spark, sample, tricky):
    check(spark, sample)
    check(spark, tricky)


def test_reruns_and_layouts_agree(spark, sample):
    a = check(spark, sample)
    assert a == check(spark, sample.repartition(7)) == check(spark, sample.coalesce(1))


def test_fractions_keep_their_expected_value():
    import random

    rnd, n = random.Random(1), 40_000
    p = q = 0.0
    for _ in range(n):
        x, y = mx._exchange(0.3, 7, 0.8, 3, rnd.random())
        assert abs(7 * x + 3 * y - (2.1 + 2.4)) < 1e-9
        assert min(abs(x), abs(x - 1), abs(y), abs(y - 1)) < 1e-12
        p, q = p + x / n, q + y / n
    assert abs(p - 0.3) < 0.01 and abs(q - 0.8) < 0.01


def test_mixed_documents_repeat_as_drawn(spark, sample, tricky):
    for docs in (sample, tricky):
        drawn = mx.mix_sources(spark, docs)
        mixed = mx.mixed_documents(spark, docs)
        assert mixed.columns == docs.columns
        assert mixed.count() == drawn.agg({"copies": "sum"}).first()[0]


def test_empty(spark, empty):
    assert mx.mix_sources(spark, empty).count() == 0
    assert mx.mixed_documents(spark, empty).count() == 0
