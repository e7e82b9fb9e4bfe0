import random
import re
from collections import Counter

from topicweave.llm import ngram_join as nj


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def brute(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    best = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            best[find(i)] = min(best.get(find(i), doc_id), doc_id)
    return Counter((rows[i][0], len(sets[i]), best.get(find(i)) if sets[i] else rows[i][0]) for i in range(len(rows))), [find(i) if sets[i] else -1 - i for i in range(len(rows))]


def check(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want, roots = brute(rows)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in nj.shingle_components(spark, docs).collect())
    assert got == want
    kept = nj.kept_documents(spark, docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(roots))


def test_sample_and_tricky_equal_brute_force(spark, sample, tricky):
    check(spark, sample)
    check(spark, tricky)


def test_clusters_of_near_copies(spark):
    rnd = random.Random(2)
    word = lambda: "w%d" % rnd.randrange(4000)
    line = [word() for _ in range(30)]
    texts = []
    for c in range(6):
        base = [word() for _ in range(rnd.randrange(20, 220))]
        if c % 2:
            base[5:5] = line
        for _ in range(25):
            t = list(base)
            for _ in range(rnd.randrange(0, 7)):
                t[rnd.randrange(len(t))] = word()
            texts.append(" ".join(t[: len(t) - rnd.randrange(4)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    check(spark, docs)


def test_prefix_length_keeps_every_linked_pair():
    for n in range(1, 300):
        for m in range(n, 2 * n):
            need = -(-80 * (n + m) // 180)  # smallest overlap of a linked pair
            if 100 * n >= 80 * m:
                assert need >= m - nj.prefix_length(m) + 1 and need >= n - nj.prefix_length(n) + 1


def test_empty(spark, empty):
    check(spark, empty)


def test_a_larger_sample_by_shared_shingles(spark):
    """Brute force over all pairs that share a shingle, on 1,000 documents."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    # passages that many documents share, at both ends of what may still link
    rnd = random.Random(11)
    passage = ["p%d" % i for i in range(60)]
    for i in range(150):
        own = ["q%d" % rnd.randrange(10**6) for _ in range(rnd.randrange(2, 40))]
        rows.append((10_000 + i, " ".join(own[: len(own) // 2] + passage[rnd.randrange(4) :] + own[len(own) // 2 :])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets, index = [], {}
    for i, (_, text) in enumerate(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
        sets.append({tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
        for s in sets[-1]:
            index.setdefault(s, []).append(i)
    common = Counter((a, b) for members in index.values() for k, b in enumerate(members) for a in members[:k])
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    want = {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}
    got = {r.doc_id: r.component_id for r in nj.shingle_components(spark, docs).collect()}
    assert got == want


def long_lists(n=260, clusters=40):
    """Many clusters of one size that share rare shingles, so lists hold
    entries of many components."""
    rnd = random.Random(21)
    shared = [["s%d_%d" % (g, i) for i in range(9)] for g in range(3)]
    texts = []
    for c in range(clusters):
        base = shared[c % 3] + ["c%d_%d" % (c, i) for i in range(60)]
        for _ in range(n // clusters):
            t = list(base)
            t[rnd.randrange(9, len(t))] = "x%d" % rnd.randrange(10**6)
            texts.append(" ".join(t))
    return list(enumerate(texts))


def test_lists_of_many_components(spark):
    check(spark, spark.createDataFrame(long_lists(120, 12), "doc_id long, text string").repartition(3))


def test_long_lists_are_dealt_out(spark):
    """Lists of more than five entries are long here: the rows stay the same."""
    rows = long_lists(120, 12)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want, _ = brute(rows)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in nj.shingle_components(spark, docs, hot=5).collect()) == want


def test_a_hub_holds_a_long_list_together(spark):
    """Each entry of a list in several parts still meets the list's one hub."""
    groups = [(g, 100, [7, 1000 + g]) for g in range(200)]
    posted = nj.postings(spark.createDataFrame(groups, "gid long, n int, prefix array<bigint>").repartition(4), hot=20)
    assert {r.parts for r in posted.collect()} == {10}  # the other lists hold one entry and are gone
    met = {(r.a, r.b) for r in nj.sparse_pairs(posted).collect()}
    assert {(0, g) for g in range(1, 200)} <= met
    assert len(met) < 2 * 200


def test_a_long_list_is_read_in_blocks(spark):
    """A list that holds every entry, in blocks of 100: each pair once, and
    only entries outside the largest component look for partners."""
    rows = [(1, c, c, 50, 0, 0 if c % 50 else c) for c in range(4000)]
    entries = spark.createDataFrame(rows, "token long, gid long, cid long, n int, pos int, comp long").repartition(4)
    long = spark.createDataFrame([(1, len(rows))], "token long, listed long")
    want = {(min(a, b), max(a, b)) for a in range(0, 4000, 50) for b in range(4000) if rows[a][5] != rows[b][5]}
    got = [(r.a, r.b) for r in nj.block_pairs(entries, long, 100).collect()]
    assert set(got) == want and len(got) == len(want)


def test_open_pairs_equal_brute_force(spark):
    rnd = random.Random(22)
    rows = []
    for token in range(6):
        for cid in rnd.sample(range(200), 40):
            n = rnd.randrange(5, 60)
            rows.append((token, cid // 3, cid, n, rnd.randrange(0, max(1, n // 5)), cid % rnd.choice([2, 5, 9])))
    want = set()
    for a in rows:
        for b in rows:
            if a[0] == b[0] and a[2] < b[2] and a[5] != b[5] and min(a[3], b[3]) * 100 >= 80 * max(a[3], b[3]):
                if (1 + min(a[3] - a[4] - 1, b[3] - b[4] - 1)) * 180 >= 80 * (a[3] + b[3]):
                    want.add((a[2], b[2], a[1], b[1]))
    entries = spark.createDataFrame(rows, "token long, gid long, cid long, n int, pos int, comp long").repartition(4)
    assert {tuple(r) for r in nj.open_pairs(entries).collect()} == want
    assert {tuple(r) for r in nj.open_pairs(entries, hot=7).collect()} == want


def test_postings_keep_what_has_a_partner(spark):
    rnd = random.Random(23)
    groups = [(g, rnd.randrange(1, 400), [rnd.randrange(60) for _ in range(rnd.randrange(1, 4))]) for g in range(120)]
    groups = [(g, n, list(dict.fromkeys(p))) for g, n, p in groups]
    rows = [(t, g, n, i) for g, n, p in groups for i, t in enumerate(p)]
    want = {r for r in rows if any(o[0] == r[0] and o[1] != r[1] and min(o[2], r[2]) * 100 >= 80 * max(o[2], r[2]) for o in rows)}
    got = nj.postings(spark.createDataFrame(groups, "gid long, n int, prefix array<bigint>").repartition(3))
    assert {(r.token, r.gid, r.n, r.pos) for r in got.collect()} == want
    dealt = nj.postings(spark.createDataFrame(groups, "gid long, n int, prefix array<bigint>").repartition(3), hot=2)
    kept = {(r.token, r.gid, r.n, r.pos) for r in dealt.collect()}
    assert want <= kept <= set(rows)


def test_sketch_grows_with_the_corpus(spark, sample):
    assert nj.sketch_bits(sample) == nj.SKETCH_BITS
    big = spark.range(1 << 40).selectExpr("id as doc_id", "cast(id as string) as text")
    assert nj.SKETCH_BITS < nj.sketch_bits(big) <= nj.MOST_SKETCH_BITS
