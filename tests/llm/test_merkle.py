import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from topicweave.llm import merkle as mk

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def siblings(tree, i):
    for nodes in tree[:-1]:
        a = i // 16 * 16
        yield nodes[a:i], nodes[i + 1 : a + 16]
        i //= 16


def leaf(row, text):
    values = [*row[:-1], text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def brute(rows):
    """rows: tuples of FIELDS."""
    rows = [tuple(r) for r in rows]
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[1]].append((r[0] is not None, r[0] or 0, leaf(r, r[-1]), r))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (*_, own, r) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            path = [*siblings(trees[s], i), *siblings(top, k)]
            text = r[-1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf(r, text)
            for left, right in path:
                node = H(*left, node, *right)
            proof = H(*[x for left, right in path for x in left + right])
            out.append((r[0], own, trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def check(df, **options):
    got = mk.proven_documents(df, **options)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = brute(df.select(*FIELDS).collect())
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)
    return want


@pytest.mark.parametrize("every", [1, 2, 3])
def test_sample_and_tricky(spark, sample, tricky, every):
    want = check(sample, every=every)
    assert 0 < sum(not r[-1] for r in want) < len(want)
    check(tricky, every=every)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 255, 256, 257, 300])
def test_sizes_around_the_blocks(spark, n):
    rows = [(i, "s", "en", 3, f"Text {i}") for i in range(n)] + [(7, None, None, None, None), (8, "", "de", 0, "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4)
    check(df)
    check(df, every=1)


def test_many_sources(spark):
    """The tree of sources is deeper than one block as well."""
    rows = [(i, f"s{i % 301}", "en", 1, "A") for i in range(700)]
    check(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"), every=1)


def test_positions_of_a_hot_source(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", i % 50) for i in range(2000)]
    nodes = spark.createDataFrame(rows, "row long, tree string, doc_id long").repartition(5)
    got = mk.numbered(nodes, ["doc_id", "row"], "test-places").collect()
    want = {}
    for tree in {r[1] for r in rows}:
        for p, r in enumerate(sorted((r for r in rows if r[1] == tree), key=lambda r: (r[2], r[0]))):
            want[r[0]] = p
    assert {r.row: r.pos for r in got} == want


def test_extra_columns_and_empty(spark, sample, empty):
    check(sample.withColumn("tree", sample.text).withColumn("claim_text", sample.text).withColumn("POS", sample.doc_id))
    assert check(empty) == []


def test_sql_twin(spark, tricky, scratch):
    tricky.drop("kept", "digest").write.parquet(scratch + "/d")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{scratch}/d/*.parquet')")
    assert Counter(con.execute(mk.OP12_SQL).fetchall()) == Counter(map(tuple, mk.proven_documents(tricky).collect()))
