"""The batch job with vocabulary and topics as tables (T5, M2, M5, V7)."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from topicweave.operators import features
from topicweave.plans.explore import run_report
from topicweave.plans.run import JobConfig, run_topic_job, score_items
from topicweave.sources.adapters import document_items, offers
from topicweave.sources.io import read_topic_map, read_vis_stats


def test_table_job_writes_the_same_tables(spark, scratch):
    feed = offers(spark, SF_SMALL)
    stock = run_topic_job(spark, JobConfig(output_base=f"{scratch}/out", max_iter=3, version="stock"), offers=feed)
    paths = run_topic_job(spark, JobConfig(output_base=f"{scratch}/out", max_iter=3, version="table", term_table=True), offers=feed)
    read = spark.read.parquet
    names = ("features", "vocab", "item_topics", "topics", "doc_stats", "doc_rejects", "topic_term", "prevalence", "relevance", "distances", "topic_map")
    for name in names:
        assert read(paths[name]).columns == read(stock[name]).columns
    assert sorted(map(tuple, read(paths["vocab"]).collect())) == sorted(map(tuple, read(stock["vocab"]).collect()))
    a, b = ({r.product_name: r.features for r in read(p["features"]).collect()} for p in (paths, stock))
    assert a == b
    run_dir = paths["items"].rsplit("/", 1)[0]
    items = read(paths["items"])
    assert read(paths["item_topics"]).count() == items.count()
    vis = read_vis_stats(spark, run_dir)
    assert vis["relevance"].count() == 6 * vis["vocab"].count() == vis["topic_term"].count()
    assert vis["doc_stats"].count() + read(paths["doc_rejects"]).count() == items.count()
    assert abs(vis["prevalence"].agg(F.sum("prevalence")).first()[0] - 1) < 1e-9
    report = run_report(spark, run_dir)
    assert 0 < report["top_items"].count() <= 60
    got = {r.product_name: (r.topic, r.score) for r in score_items(spark, run_dir, items.select("product_name", "description")).collect()}
    want = {r.product_name: (r.topic, r.score) for r in read(paths["item_topics"]).collect()}
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-6 for k in want)
    for p in (paths, stock):
        distances, placed = read_topic_map(spark, p["items"].rsplit("/", 1)[0])
        assert distances.count() == 15 and sorted(r.size_rank for r in placed.collect()) == [1, 2, 3, 4, 5, 6]


def test_more_terms_than_the_driver_holds(spark, scratch, monkeypatch):
    """Beyond the driver's bound the stock stage is an error, the table is not."""
    monkeypatch.setattr(features, "DEFAULT_VOCAB_SIZE", 50)
    feed = offers(spark, SF_SMALL)
    with pytest.raises(features.VocabularyOverflow):
        run_topic_job(spark, JobConfig(output_base=f"{scratch}/out", max_iter=1, version="a"), offers=feed)
    paths = run_topic_job(spark, JobConfig(output_base=f"{scratch}/out", max_iter=1, version="b", term_table=True), offers=feed)
    assert spark.read.parquet(paths["vocab"]).count() > 50


def test_scores_need_no_exchange(spark, scratch):
    """Items, sets and scores are one table: assigning topics joins nothing."""
    from topicweave.operators.topics import with_assignment

    paths = run_topic_job(spark, JobConfig(output_base=f"{scratch}/out", max_iter=1, version="x"), offers=offers(spark, SF_SMALL))
    plan = with_assignment(spark.read.parquet(paths["scored"]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert spark.read.parquet(paths["scored"]).count() == spark.read.parquet(paths["items"]).count()


def test_scoring_keeps_the_features_partitions(spark):
    """M6 does not run in the fit's fixed layout."""
    from topicweave.operators.topics import fit_lda, score_all, training_input

    _, feats = features.to_tf_idf_features(document_items(spark, SF_SMALL))
    training = training_input(feats, partitions=2)
    model = fit_lda(training, 2, 1, 1)
    training.unpersist()
    table = feats.repartition(7)
    plan = score_all(model, table)._jdf.queryExecution().toString()
    assert score_all(model, table).rdd.getNumPartitions() == 7 and "hashpartitioning(product_name" not in plan
