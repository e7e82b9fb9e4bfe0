"""Staged commit: readers see finished runs only."""

import os

import pytest

from tests.conftest import SF_SMALL
from topicweave.plans import run as run_module
from topicweave.plans.explore import run_report
from topicweave.plans.run import JobConfig, run_topic_job, score_items
from topicweave.sources.adapters import offers
from topicweave.sources.io import read_vis_stats, run_path
from topicweave.sources.publish import NoPublishedRun, drop_unpublished, new_attempt, publish, published, published_runs, resolve_run


def test_a_killed_job_leaves_the_old_run(spark, scratch, monkeypatch):
    cfg = JobConfig(output_base=f"{scratch}/out", max_iter=2, version="v")
    run_dir = run_path(cfg.output_base, "v", cfg.k, cfg.max_iter, cfg.seed)
    feed = offers(spark, SF_SMALL)

    class Killed(RuntimeError):
        pass

    def dying(sink):
        def write(df, path, *a):
            if path.endswith(sink):
                raise Killed(path)
            return real(df, path, *a)

        return write

    real = run_module.write_table
    monkeypatch.setattr(run_module, "write_table", dying("item_tf_idf_df.parquet"))
    with pytest.raises(Killed):
        run_topic_job(spark, cfg, offers=feed)
    assert published(spark, run_dir) is None and published_runs(spark, cfg.output_base) == []
    with pytest.raises(NoPublishedRun):
        run_report(spark, run_dir)

    monkeypatch.setattr(run_module, "write_table", real)
    paths = run_topic_job(spark, cfg, offers=feed)
    assert published(spark, run_dir)["paths"] == paths
    before = sorted(map(str, run_report(spark, run_dir)["top_items"].collect()))
    assert before

    for sink in ("item_df.parquet", "scored.parquet", "relevance.parquet"):
        monkeypatch.setattr(run_module, "write_table", dying(sink))
        with pytest.raises(Killed):
            run_topic_job(spark, cfg, offers=feed.where("e_price > 1000"))
        assert published(spark, run_dir)["paths"] == paths
        assert sorted(map(str, run_report(spark, run_dir)["top_items"].collect())) == before
    assert read_vis_stats(spark, run_dir)["vocab"].count() > 0
    raw = spark.read.parquet(paths["items"]).select("product_name", "description")
    assert score_items(spark, run_dir, raw).count() == raw.count()

    monkeypatch.setattr(run_module, "write_table", real)
    again = run_topic_job(spark, cfg, offers=feed)
    assert again["items"] != paths["items"] and published(spark, run_dir)["paths"] == again
    assert spark.read.parquet(paths["items"]).count() == raw.count()  # a reader of the old attempt is not disturbed
    assert [p.replace("file:", "") for p in published_runs(spark, cfg.output_base)] == [run_dir]
    assert len(drop_unpublished(spark, run_dir)) == 4
    assert os.path.exists(paths["items"]) and os.path.exists(again["items"])


def test_last_manifest_holds(spark, scratch):
    for i in range(12):
        attempt = new_attempt(scratch)
        publish(spark, scratch, attempt, {"n": str(i)})
    assert published(spark, scratch) == {"attempt": attempt, "paths": {"n": "11"}}
    assert resolve_run(spark, scratch) == attempt == resolve_run(spark, attempt)
    # a manifest that was not renamed yet does not count
    with open(f"{scratch}/_manifests/_000099-x.json.tmp", "w") as fh:
        fh.write("{")
    assert published(spark, scratch)["paths"] == {"n": "11"}
