"""Driver contract, the batch job, and Spark-vs-DuckDB on the small tables."""

import math
import os

import duckdb
import pandas
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from topicweave.plans.catalog import QUERIES
from topicweave.plans.run import JobConfig, MalformedFeed, run_sweep, run_topic_job, score_items
from topicweave.sources.adapters import offers
from topicweave.sources.io import load_model, preview, read_vis_stats

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _canon(pdf):
    cols = sorted(pdf.columns)

    def n(v):
        if v is None or v is pandas.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        return v.item() if hasattr(v, "item") else v

    rows = [tuple(n(x) for x in r) for r in pdf[cols].itertuples(index=False)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 20


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["topic", "product_name", "categories", "brands"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "float": "FLOAT", "double": "DOUBLE",
                  "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_against_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    s = sdf.toPandas()
    d = duck.execute(E.oracle_sql()[name]).fetchdf()
    assert _canon(s) == _canon(d)
    # same column names and types on both sides
    spark_types = {f.name: _SPARK_TO_DUCK.get(f.dataType.simpleString()) for f in sdf.schema.fields}
    duck_types = {r[0]: r[1] for r in duck.execute(f"describe {E.oracle_sql()[name]}").fetchall()}
    assert spark_types == duck_types


def test_run_topic_job(spark, scratch):
    feed = f"{scratch}/feed"
    offers(spark, SF_SMALL).write.json(feed)
    cfg = JobConfig(output_base=f"{scratch}/out/", source_json=feed, max_iter=5, version="t1")
    paths = run_topic_job(spark, cfg)
    assert "run=t1/k=6/iter=5/seed=100" in paths["items"]
    assert "//" not in paths["items"].replace("file://", "")
    items = spark.read.parquet(paths["items"])
    assert items.count() == offers(spark, SF_SMALL).select("product_name").distinct().count()
    topics = spark.read.parquet(paths["topics"]).collect()
    assert len(topics) == 6 and all(len(r["top_terms"]) == 10 for r in topics)
    it = spark.read.parquet(paths["item_topics"])
    assert it.columns == ["product_name", "brands", "categories", "topicDistribution", "score", "topic"]
    for k in ("doc_stats", "doc_rejects", "topic_term", "prevalence", "relevance", "vocab", "features", "model", "feature_model", "config", "rejects"):
        assert os.path.exists(paths[k].replace("file:", ""))
    run_dir = paths["items"].rsplit("/", 1)[0]
    vis = read_vis_stats(spark, run_dir)
    assert set(vis) == {"doc_stats", "vocab", "topic_term", "prevalence", "relevance"}
    assert vis["doc_stats"].where("not complete").count() == 0
    rejected = spark.read.parquet(paths["doc_rejects"])
    assert rejected.where("complete").count() == 0
    assert vis["doc_stats"].count() + rejected.count() == items.count()
    assert vis["relevance"].count() == 6 * vis["vocab"].count()
    assert load_model(paths["model"]).vocabSize() == vis["vocab"].count()
    from topicweave.plans.explore import run_report

    rep = run_report(spark, run_dir)
    assert rep["overview"].first()["product_distinct"] == items.count()
    top = rep["top_items"].collect()
    assert 0 < len(top) <= 60 and [r["topic"] for r in top] == sorted(r["topic"] for r in top)
    cats = rep["topic_categories"].collect()
    assert {r["topic"] for r in cats} == {r["topic"] for r in top}
    assert {r["summary"] for r in rep["describe"].collect()} >= {"count", "mean", "stddev", "min", "max"}


def test_config_overrides():
    cfg = JobConfig(output_base="/x").with_overrides(seed=0, k=None)
    assert cfg.seed == 0 and cfg.k == 6


def test_preview_and_clean_description(spark, capsys):
    from topicweave.operators.features import with_clean_description

    df = spark.createDataFrame([("a<b>c 1,2",)], ["description"])
    out = with_clean_description(df).first()["description"]
    assert out == "ac "
    preview(df, 60)
    assert "description" in capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_query_plans(spark, name):
    """Every query of the catalog stays in the JVM: no Python UDF / Arrow eval."""
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for marker in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert marker not in plan, (name, marker)


def test_topic_job_is_reproducible(spark, scratch):
    """Two runs of the job on the same input write identical items, topic
    assignments and topic descriptions (deterministic representative values,
    vocabulary order, training layout and seed)."""
    feed = offers(spark, SF_SMALL)
    runs = []
    for v in ("a", "b"):
        cfg = JobConfig(output_base=f"{scratch}/out", max_iter=5, version=v)
        runs.append(run_topic_job(spark, cfg, offers=feed.repartition(3 if v == "a" else 5)))

    def rows(path, cols):
        return sorted(tuple(r) for r in spark.read.parquet(path).select(*cols).collect())

    a, b = runs
    item_cols = ["product_name", "codes", "brands", "retailers", "categories", "description", "price"]
    assert rows(a["items"], item_cols) == rows(b["items"], item_cols)
    assert rows(a["item_topics"], ["product_name", "score", "topic"]) == rows(
        b["item_topics"], ["product_name", "score", "topic"]
    )
    assert rows(a["topics"], ["topic", "top_terms"]) == rows(b["topics"], ["topic", "top_terms"])


def test_saved_run_scores_raw_text(spark, scratch):
    """The saved feature stage and model reproduce the job's own assignment;
    nothing is left outside the run's folder; the sweep writes per point."""
    from topicweave.session import ensure_checkpoint_dir

    def left():
        folder = ensure_checkpoint_dir(spark).replace("file:", "")
        return set(os.listdir(folder)) if os.path.exists(folder) else set()

    before = left()
    cfg = JobConfig(output_base=f"{scratch}/out", max_iter=3, version="s")
    paths = run_topic_job(spark, cfg, offers=offers(spark, SF_SMALL))
    assert left() <= before
    assert all(os.path.abspath(p.replace("file:", "")).startswith(f"{scratch}/out") for p in paths.values())
    run_dir = paths["items"].rsplit("/", 1)[0]
    raw = spark.read.parquet(paths["items"]).select("product_name", "description")
    got = {r["product_name"]: (r["topic"], r["score"]) for r in score_items(spark, run_dir, raw).collect()}
    want = {r["product_name"]: (r["topic"], r["score"]) for r in spark.read.parquet(paths["item_topics"]).collect()}
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-6 for k in want)
    grid = [(3, 2, 1), (4, 2, 1)]
    folders = run_sweep(spark, cfg, run_dir, grid)
    for point in grid:
        assert spark.read.parquet(f"{folders[point]}/topics_df.parquet").count() == point[0]
        assert spark.read.parquet(f"{folders[point]}/item_topic_df.parquet").count() == len(want)
        assert load_model(f"{folders[point]}/lda_model").topicsMatrix().numCols == point[0]


def test_malformed_feed_fails_on_request(spark, scratch):
    with open(f"{scratch}/feed.jl", "w") as fh:
        fh.write('{"product_name": "p", "item_code": "1"}\n{broken\n')
    cfg = JobConfig(output_base=f"{scratch}/out", source_json=f"{scratch}/feed.jl", version="m", fail_on_rejects=True)
    with pytest.raises(MalformedFeed):
        run_topic_job(spark, cfg)


def test_rewritten_tables_are_fitted_anew(spark, scratch):
    import shutil

    from topicweave.plans.catalog import _doc_lda

    shutil.copyfile(f"{SF_SMALL}/documents.parquet", f"{scratch}/documents.parquet")
    a = _doc_lda(spark, scratch)
    assert _doc_lda(spark, scratch) is a
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id < 150").toPandas().to_parquet(f"{scratch}/documents.parquet")
    assert _doc_lda(spark, scratch).vocab.n_docs == 150
