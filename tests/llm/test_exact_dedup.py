import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from topicweave.llm.exact_dedup import StreamingDeduplicator, exact_dedup, kept_documents


def brute(rows):
    groups = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, i, doc_id))
    out = []
    for norm, members in groups.items():
        keep = min(members)[4]
        for m in members:
            out.append((m[4], keep, len(members), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str), len(groups)


def check(spark, docs, digest=None, **options):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want, n = brute(rows)
    got = exact_dedup(spark, docs, **({"digest": digest} if digest else {}), **options).collect()
    if digest is None:
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.digest.hex()) for r in got), key=str) == want
    else:
        assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=str) == sorted((w[:3] for w in want), key=str)
    assert sum(r.kept for r in got) == n


def test_sample_and_tricky(spark, sample, tricky):
    check(spark, sample)
    check(spark, tricky)


def test_colliding_digests_are_told_apart_by_bytes(spark, sample, tricky):
    weak = lambda c: F.substring(F.unhex(F.sha2(c.cast("binary"), 256)), 1, 1)
    check(spark, sample, weak)
    kept = kept_documents(spark, tricky, weak)
    assert kept.count() == kept_documents(spark, tricky).count() == brute([(r.doc_id, r.text) for r in tricky.collect()])[1]
    assert kept.columns == tricky.columns


def test_state_goes_on_over_several_batches(spark, sample, scratch):
    state = StreamingDeduplicator(spark, scratch + "/state", files_per_batch=1)
    state.ingest(sample.where("doc_id % 2 = 0").repartition(3))
    state.ingest(sample.where("doc_id % 2 = 1").repartition(2))
    again = StreamingDeduplicator(spark, scratch + "/state")
    sizes = {r.keep_id: r.group_size for r in again.groups().collect()}
    want = {r.keep_id: r.group_size for r in exact_dedup(spark, sample).collect()}
    assert sizes == want


def test_empty(spark, empty):
    assert exact_dedup(spark, empty).count() == 0
    assert kept_documents(spark, empty).columns == empty.columns
    assert kept_documents(spark, empty).count() == 0


def weak(c):
    return F.substring(F.unhex(F.sha2(c.cast("binary"), 256)), 1, 1)


def by_batches(parts):
    """brute() over batches, the earlier one first among fully equal rows."""
    groups = defaultdict(list)
    for b, rows in enumerate(parts):
        for i, (doc_id, text) in enumerate(rows):
            groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, b, i, doc_id))
    out = []
    for members in groups.values():
        for m in members:
            out.append((m[3], m[5], min(members)[5], len(members)))
    return sorted(out, key=str), sorted(((min(m)[3], min(m)[5]) for m in groups.values()), key=str)


def test_the_same_rows_twice_keep_one_row(spark, sample, scratch):
    rows = sample.where("doc_id < 50")
    exact_dedup(spark, rows, scratch + "/state").count()
    got = exact_dedup(spark, rows, scratch + "/state").collect()
    assert len(got) == 100 and {r.batch for r in got} == {0, 1}
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.digest for r in kept}) == len({r.digest for r in got}) and {r.batch for r in kept} == {0}


@pytest.mark.parametrize("digest", [None, weak])
def test_batches_equal_brute_force(spark, sample, tricky, scratch, digest):
    """Also where digests of different batches collide."""
    parts = [sample.where("doc_id % 3 = 0"), tricky.select("doc_id", "text"), sample.where("doc_id % 3 > 0 or doc_id < 20")]
    options = {"digest": digest} if digest else {}
    for part in parts:
        got = exact_dedup(spark, part, scratch + "/state", **options).collect()
    want, kept = by_batches([[(r.doc_id, r.text) for r in p.select("doc_id", "text").collect()] for p in parts])
    assert sorted(((r.batch, r.doc_id, r.keep_id, r.group_size) for r in got), key=str) == want
    assert sorted(((r.batch, r.doc_id) for r in got if r.kept), key=str) == kept


def test_a_collision_of_an_earlier_batch_is_remembered(spark, scratch):
    zero = lambda c: F.unhex(F.lit("00"))
    first = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    exact_dedup(spark, first, scratch + "/s", zero).count()
    state = StreamingDeduplicator(spark, scratch + "/s", zero)
    got = state.decisions(state.ingest(first.where("false"))).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in got} == {(1, 1, True), (2, 2, True)}
    got = exact_dedup(spark, spark.createDataFrame([(3, " b "), (4, "c")], "doc_id long, text string"), scratch + "/s", zero).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in got} == {(1, 1, True), (2, 3, False), (3, 3, True), (4, 4, True)}


def test_locators_name_the_kept_text(spark, sample, tricky, scratch):
    for docs in (sample, tricky.select("doc_id", "text")):
        state = StreamingDeduplicator(spark, f"{scratch}/{docs.count()}")
        rows = state.decisions(state.ingest(docs)).where("kept").select("doc_id", "digest", "file", "row_in_file")
        read = state.texts_at(rows).collect()
        assert len(read) == rows.count()
        for r in read:
            assert hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", r.text or "").encode()).digest() == r.digest


def test_hot_digests_are_joined_apart(spark, scratch):
    rows = [(i, "copy" if i % 3 else f"text {i % 7}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(spark, docs, hot=10)
    check(spark, docs, hot=0)


def test_no_python_in_the_plan(spark, sample):
    from topicweave.llm.exact_dedup import op5_stream_dedup

    plan = op5_stream_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
