import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicweave.llm import sharding as sh


def slow_table(names, slots, weights=None):
    """The turns, written out shard by shard with full preference lists."""
    weights = weights or [1] * len(names)
    number = lambda n, salt, m: int(hashlib.md5(f"{salt}:{n}".encode()).hexdigest()[:16], 16) % m
    prefs = [[(number(n, "offset", slots) + j * (number(n, "skip", slots - 1) + 1)) % slots for j in range(slots)] for n in names]
    table = [None] * slots
    while None in table:
        for s, w in enumerate(weights):
            for _ in range(w):
                free = [x for x in prefs[s] if table[x] is None]
                if free:
                    table[free[0]] = s
    return table


@pytest.mark.parametrize("weights", [None, [1, 0, 3, 2, 1]])
def test_table_equals_the_written_out_turns(weights):
    names = [f"n{i}" for i in range(5)]
    assert sh.lookup_table(names, 101, weights).tolist() == slow_table(names, 101, weights)


def test_table_is_even_and_stable():
    names = sh.shard_names(50)
    table = sh.lookup_table(names, 10007)
    counts = np.bincount(table)
    assert counts.max() - counts.min() <= 1
    fewer = sh.lookup_table(names[:-1], 10007)
    moved = (fewer != table) & (table != 49)
    assert moved.mean() < 0.05


def test_placement_equals_brute_force(spark, tricky):
    names = sh.shard_names(7)
    table = sh.lookup_table(names, 1009)
    got = sh.assign_shards(tricky, "doc_id", names, 1009).collect()
    assert len(got) == tricky.count()
    for r in got:
        slot = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16) % 1009
        assert r.slot == slot and r.shard == table[slot]


def test_query_places_every_document(spark):
    rows = sh.op6_table_shards(spark, "/root/testdata/sf0.001").collect()
    table = sh.lookup_table(sh.shard_names())
    assert len(rows) == 200
    for r in rows:
        assert r.shard == table[int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16) % sh.SLOTS]


def test_clashing_columns_and_files(spark, tricky, scratch):
    df = tricky.withColumn("Slot", tricky.doc_id).withColumn("shard", tricky.text)
    got = sh.assign_shards(df, "doc_id", ["a", "b"], 13)
    assert got.columns[-2:] != ["slot", "shard"] and set(df.columns) <= set(got.columns)
    sh.write_shards(tricky, "doc_id", sh.shard_names(3), scratch + "/out", 2, 101)
    back = spark.read.parquet(scratch + "/out")
    assert back.count() == tricky.count()
    assert Counter(r.shard for r in back.collect()) == Counter(r.shard for r in sh.assign_shards(tricky, "doc_id", sh.shard_names(3), 101).collect())


def test_bad_tables_and_empty(spark, empty):
    for names, slots, weights in ((["a"], 10, None), ([], 7, None), (["a"] * 8, 7, None), (["a"], 7, [0])):
        with pytest.raises(ValueError):
            sh.lookup_table(names, slots, weights)
    assert sh.assign_shards(empty, "doc_id", ["a"], 7).count() == 0


def test_a_hot_key_fills_many_files(spark, scratch):
    """One key holds a third of all rows: its shard's files are as large as others'."""
    rows = [(7 if i % 3 == 0 else i, f"text {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    names = sh.shard_names(4)
    shard = sh.write_shards(docs, "doc_id", names, scratch + "/hot", slots=101, rows_per_file=100)
    back = spark.read.parquet(scratch + "/hot").withColumn("file", F.input_file_name())
    assert sorted((r.doc_id, r.text) for r in back.collect()) == sorted(rows)
    hot = back.where("doc_id = 7").select(shard).first()[0]
    files = Counter(r.file for r in back.where(F.col(shard) == hot).collect())
    assert len(files) >= 8 and max(files.values()) < 1000


def test_query_writes_whole_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = sh.op6_table_shards(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: r.text_crc32 for r in rows} == {i: None if t is None else zlib.crc32(t.encode()) for i, t in docs.items()}
    assert all(r.file.startswith("part-") for r in rows) and len({r.file for r in rows}) > 1


def test_files_are_bounded_in_bytes(spark, scratch):
    rows = [(i, "x" * 1000) for i in range(400)] + [(None, None), (1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    shard = sh.write_shards(docs, "doc_id", ["a"], scratch + "/b", slots=101, bytes_per_file=40_000)
    back = spark.read.parquet(scratch + "/b").withColumn("file", F.input_file_name())
    files = back.groupBy("file").agg(F.sum(F.length("text")).alias("n")).collect()
    assert back.count() == 402 and shard in back.columns and len(files) > 4 and max(r.n for r in files) < 160_000
