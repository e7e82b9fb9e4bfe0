"""Bucketed run tables: joins by the key without an exchange."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from topicweave.plans.run import JobConfig, run_side_by_side, run_topic_job
from topicweave.sources.adapters import offers
from topicweave.sources.bucketed import NotBucketed, bucket_layout, join_buckets, read_bucketed, write_bucketed


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def brute(a, b, how):
    out = []
    for x in a:
        hits = [y for y in b if y[0] == x[0]]
        out += [(*x, y[2]) for y in hits] or ([(*x, None)] if how == "left" else [])
    return sorted(map(repr, out))


def test_join_equals_brute_force(spark, scratch):
    rnd = random.Random(3)
    names = [None, "", "a`b", "O'Neil \\ co", *[f"p{i}" for i in range(60)]]
    a = [(n, i, "x") for i, n in enumerate(rnd.sample(names, 50) + [None, "p1", "p1"])]
    b = [(n, i, f"s{i}") for i, n in enumerate(rnd.sample(names, 40) + [None, None, "p1"])]
    left = write_bucketed(spark.createDataFrame(a, "`the name` string, clash int, x string"), f"{scratch}/it's", "the name", 5)
    right = write_bucketed(spark.createDataFrame(b, "`the name` string, clash int, s string"), f"{scratch}/b", "the name", 5)
    for how in ("inner", "left"):
        got = join_buckets(spark, left, right, how)
        assert got.columns == ["the name", "clash", "x", "s"]
        assert rows_of(got) == brute(a, b, how)
        keyed = join_buckets(spark, left, right, how, null_keys=False)
        assert "Exchange" not in plan_of(keyed) and "SortMergeJoin" in plan_of(keyed)
        assert rows_of(keyed) == brute([x for x in a if x[0] is not None], b, how)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]
    assert rows_of(spark.read.parquet(left)) == sorted(map(repr, a))  # an ordinary folder for others


def test_empty_and_unfitting_tables(spark, scratch):
    none = spark.createDataFrame([], "k long, v string")
    some = spark.createDataFrame([(1, 2.0), (None, 3.0)], "k long, w double")
    write_bucketed(none, f"{scratch}/none", "k", 3)
    write_bucketed(some, f"{scratch}/some", "k", 3)
    write_bucketed(some, f"{scratch}/four", "k", 4)
    assert bucket_layout(spark, f"{scratch}/none")["buckets"] == 3
    assert read_bucketed(spark, f"{scratch}/none").columns == ["k", "v"]
    assert join_buckets(spark, f"{scratch}/some", f"{scratch}/none").count() == 0
    assert rows_of(join_buckets(spark, f"{scratch}/some", f"{scratch}/none", "left")) == ["(1, 2.0, None)", "(None, 3.0, None)"]
    with pytest.raises(NotBucketed):
        join_buckets(spark, f"{scratch}/some", f"{scratch}/four")
    some.write.parquet(f"{scratch}/plain")
    with pytest.raises(NotBucketed):
        read_bucketed(spark, f"{scratch}/plain")
    with pytest.raises(Exception, match="non-empty directory"):  # nothing is overwritten
        write_bucketed(some, f"{scratch}/some", "k", 3)


def test_run_tables_side_by_side(spark, scratch):
    feed = offers(spark, SF_SMALL)
    feed = feed.unionByName(feed.limit(3).withColumn("product_name", F.lit(None).cast("string")))
    paths = run_topic_job(spark, JobConfig(output_base=f"{scratch}/out", max_iter=1, version="b", buckets=4), offers=feed)
    run_dir = paths["items"].rsplit("/", 1)[0]
    items, topics = spark.read.parquet(paths["items"]), spark.read.parquet(paths["item_topics"])
    got = run_side_by_side(spark, run_dir)
    want = items.join(topics.select(F.col("product_name").alias("n"), "topic"), F.col("product_name").eqNullSafe(F.col("n")))
    assert rows_of(got.select("product_name", "topic")) == rows_of(want.select("product_name", "topic"))
    assert got.count() == items.count() and got.where("product_name is null").count() == 1
    plan = plan_of(join_buckets(spark, paths["items"], paths["features"], null_keys=False))
    assert "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
    assert run_side_by_side(spark, run_dir, "scored", "features").count() == items.count()
