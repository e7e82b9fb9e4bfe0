"""Distinct counts, moments and the word sketch: exact, mergeable."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_incremental import random_offers
from tests.test_rollup import _offers
from topicweave.functions.text import clean_tokens
from topicweave.operators.distincts import distinct_counts, extend_dictionary, merge_bitmaps, run_bitmaps
from topicweave.operators.features import df_band, term_stats
from topicweave.operators.moments import merge_moments, moment_stats, moments
from topicweave.operators.rollup import offer_values
from topicweave.operators.sketch import filtered_band, filtered_term_stats, frequency_sketch, may_reach, merge_sketches


def test_two_runs_and_their_union(spark):
    rows = random_offers(1, 500)
    parts = [_offers(spark, rows[:200]), _offers(spark, rows[200:])]
    values = [offer_values(p) for p in parts]
    first = extend_dictionary(values[0]).cache()
    second = extend_dictionary(values[1], first).cache()
    before = {(r.kind, r.value): r.id for r in first.collect()}
    after = {(r.kind, r.value): r.id for r in second.collect()}
    assert before.items() <= after.items()  # numbers never change
    for kind in {k for k, _ in after}:
        ids = sorted(i for (k, _), i in after.items() if k == kind)
        assert ids == list(range(1, len(ids) + 1))
    runs = [run_bitmaps(v, second) for v in values]
    runs[0] = run_bitmaps(values[0], first)  # made before the second run was known
    every = [*runs, merge_bitmaps(runs)]
    tables = [*values, values[0].unionByName(values[1])]
    for bitmaps, table in zip(every, tables):
        want = {k: len({v for kk, v in map(tuple, table.collect()) if kk == k}) for k in ("product", "retailers", "categories", "brands")}
        assert {r.kind: r.n_distinct for r in distinct_counts(bitmaps).collect()} == want


def test_many_values_over_several_bitmaps(spark):
    values = spark.range(100_000).select(F.lit("a").alias("kind"), F.pmod(F.col("id"), F.lit(70_001)).cast("string").alias("value"))
    names = extend_dictionary(values).cache()
    bitmaps = run_bitmaps(values.withColumn("day", F.col("value").cast("long") % 2), names, "day")
    assert {(r.day, r.n_distinct) for r in distinct_counts(bitmaps, "day").collect()} == {(0, 35_001), (1, 35_000)}
    assert distinct_counts(merge_bitmaps(bitmaps)).first().n_distinct == 70_001
    assert bitmaps.agg(F.max(F.length("bitmap"))).first()[0] == 4096


def test_empty_runs(spark):
    none = spark.createDataFrame([], "kind string, value string")
    names = extend_dictionary(none)
    assert names.count() == 0 and distinct_counts(run_bitmaps(none, names)).count() == 0
    some = extend_dictionary(spark.createDataFrame([("a", None), ("a", "x")], "kind string, value string"), names)
    assert {(r.value, r.id) for r in some.collect()} == {(None, 1), ("x", 2)}


def numbers(seed, n):
    rnd = random.Random(seed)
    return [(i, rnd.choice([None, 5.0, 5.0, rnd.gauss(1e6, 1e-3), rnd.random() * 10 ** rnd.randrange(-3, 9)]), rnd.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("leaf_rows", [1000, 7])
def test_moments_have_the_same_bits_under_three_layouts(spark, leaf_rows):
    df = spark.createDataFrame(numbers(1, 3000), "k long, x double, y int")
    states = []
    for parts in (1, 3, 11):
        rows = moments(df.repartition(parts, F.rand(parts)), ("x", "y"), leaf_rows).collect()
        states.append({r.column_name: tuple(r.state) for r in rows})
    assert states[0] == states[1] == states[2]
    xs = [x for _, x, _ in numbers(1, 3000) if x is not None]
    n, mean, m2, least, most = states[0]["x"]
    assert (n, least, most) == (len(xs), min(xs), max(xs))
    assert math.isclose(mean, statistics.fmean(xs), rel_tol=1e-12) and math.isclose(math.sqrt(m2 / (n - 1)), statistics.stdev(xs), rel_tol=1e-9)


def test_runs_merge_in_a_fixed_order(spark):
    df = spark.createDataFrame(numbers(2, 2000), "k long, x double, y int")
    runs = [moments(df.where(F.col("y") == i), ("x",)).withColumn("run", F.lit(i)).cache() for i in range(3)]
    merged = [merge_moments(a.unionByName(b).unionByName(c).repartition(p), "run").collect() for a, b, c, p in ((*runs, 1), (*runs[::-1], 5))]
    assert merged[0] == merged[1]
    xs = [x for _, x, _ in numbers(2, 2000) if x is not None]
    stats = moment_stats(spark.createDataFrame(merged[0], runs[0].drop("run").schema)).first()
    assert stats["count"] == len(xs) and math.isclose(stats["stddev"], statistics.stdev(xs), rel_tol=1e-9)


def test_moments_of_little(spark):
    df = spark.createDataFrame([(1.0, None), (None, None)], "a double, b double")
    got = {r.column_name: tuple(r)[1:] for r in moment_stats(moments(df, ("a", "b"))).collect()}
    assert got == {"a": (1, 1.0, None, 1.0, 1.0)}
    assert moments(df.where("false"), ("a",)).count() == 0


def _tokens(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", clean_tokens("text").alias("cleaned_words"))


@pytest.mark.parametrize("width, rows", [(1 << 14, 2), (64, 1), (3, 2), (1, 1)])
def test_band_does_not_depend_on_the_sketch(spark, width, rows):
    """Also with sketches so small that nearly everything collides."""
    toks = _tokens(spark).cache()
    n = toks.count()
    for low, high in ((0.01, 0.3), (3, 0.5), (1, 1.0)):
        want = sorted(map(tuple, df_band(term_stats(toks), n, low, high).select("word", "term_frequency", "doc_freq").collect()))
        got = sorted(map(tuple, filtered_band(toks, n, min_df=low, max_df=high, width=width, rows=rows).select("word", "term_frequency", "doc_freq").collect()))
        assert got == want


def test_fewer_words_are_shuffled(spark):
    toks = _tokens(spark).cache()
    words, kept = term_stats(toks).count(), filtered_term_stats(toks, toks.count(), min_df=0.05).count()
    band = term_stats(toks).where(F.col("doc_freq") >= 0.05 * toks.count()).count()
    assert band <= kept < words / 2


def test_counters_are_one_sided_and_merge(spark):
    toks = _tokens(spark).cache()
    half = F.pmod(F.col("doc_id"), F.lit(2)) == 0
    whole = {(r.row, r.cell): r.n for r in frequency_sketch(toks, width=50).collect()}
    merged = merge_sketches(frequency_sketch(toks.where(half), width=50), frequency_sketch(toks.where(~half), width=50))
    assert {(r.row, r.cell): r.n for r in merged.collect()} == whole
    # whatever the threshold, a word that reaches it passes
    stats = term_stats(toks).cache()
    for least in (1, 5, 40):
        passed = {r.word for r in may_reach(stats, merged, least, 50).collect()}
        assert {r.word for r in stats.where(F.col("doc_freq") >= least).collect()} <= passed


def test_sketch_of_nothing(spark):
    toks = spark.createDataFrame([(1, None), (2, [])], "doc_id long, cleaned_words array<string>")
    assert frequency_sketch(toks).count() == 0 and filtered_band(toks, 2).count() == 0
