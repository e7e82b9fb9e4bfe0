"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Every query is executed completely through the ``noop`` sink (no result is
collected on the driver), after one warm-up query that is not counted.  The
LDA queries share one fit per session: the first of them (``lda_topk``) pays
for it, those listed under ``after_shared_fit`` do not.  ``baseline`` times the
not part of the total.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from topicweave.functions.constants import MAX_DF, MIN_DF, WHITESPACE_PATTERN  # noqa: E402
from topicweave.functions.text import clean_markup  # noqa: E402
from topicweave.operators.features import to_tf_idf_features  # noqa: E402
from topicweave.operators.topics import fit_lda, training_input  # noqa: E402
from topicweave.plans.catalog import QUERIES  # noqa: E402
from topicweave.plans.run import JobConfig, run_topic_job  # noqa: E402
from topicweave.session import local_session  # noqa: E402
from topicweave.sources.adapters import document_items, offers  # noqa: E402


class _Steps:
    """Timed steps that are not single queries (they map to BASELINE rows)."""

    def __init__(self, spark, sf_dir, scratch):
        self.spark, self.sf_dir, self.scratch = spark, sf_dir, scratch
        self.feats = self.vocab = None

    def features_fit(self):
        # baseline row: fit tokenizer + stop words + vectorizer + IDF, plus one row count
        self.vocab, self.feats = to_tf_idf_features(document_items(self.spark, self.sf_dir))
        self.feats.count()

    def lda_fit(self):
        # baseline row: LDA fit, k=6, 50 iterations, seed 100, on prepared features
        if self.feats is None:
            self.features_fit()
        training = training_input(self.feats)
        training.count()  # prepared features, as in the baseline row
        t0 = time.perf_counter()
        fit_lda(training, 6, 50, 100)
        return time.perf_counter() - t0

    def topic_job(self):
        # the whole batch job on the offer feed, all outputs written
        cfg = JobConfig(output_base=f"{self.scratch}/out", version="bench")
        run_topic_job(self.spark, cfg, offers=offers(self.spark, self.sf_dir))

    def stock_features_fit(self):
        from pyspark.ml import Pipeline
        from pyspark.ml.feature import IDF, CountVectorizer, RegexTokenizer, StopWordsRemover

        items = document_items(self.spark, self.sf_dir).withColumn("description", clean_markup("description"))
        stages = [
            RegexTokenizer(inputCol="description", outputCol="words", pattern=WHITESPACE_PATTERN),
            StopWordsRemover(inputCol="words", outputCol="kept"),
            CountVectorizer(inputCol="kept", outputCol="counts", minDF=MIN_DF, maxDF=MAX_DF),
            IDF(inputCol="counts", outputCol="features"),
        ]
        self.stock = Pipeline(stages=stages).fit(items).transform(items).select("product_name", "features")
        self.stock.count()

    def stock_lda_fit(self):
        from pyspark.ml.clustering import LDA

        cached = self.stock.cache()
        cached.count()
        t0 = time.perf_counter()
        LDA(k=6, maxIter=50, seed=100).fit(cached)
        elapsed = time.perf_counter() - t0
        cached.unpersist()
        return elapsed


STEPS = ["features_fit", "lda_fit", "topic_job"]
BASELINE = ["stock_features_fit", "stock_lda_fit"]
AFTER_SHARED_FIT = ["lda_topics", "lda_doc_stats", "lda_prevalence", "lda_relevance"]

HEADLINE = [
    "item_rollup",
    "features_fit",
    "lda_fit",
    "item_overview",
    "clean_text_pages",
    "tokens_no_stopwords",
    "word_count",
    "vocab_df_band",
    "tfidf_long",
    "tfidf_vector_unpacked",
    "ids_to_words",
    "topk_per_topic",
    "lda_topk",  # features + LDA fit (k=6, 50 iterations) + assignment + top-10
    "lda_topics",
    "lda_doc_stats",
    "lda_prevalence",
    "lda_relevance",
    "offers_lda_topk",  # offers: rollup -> features -> LDA -> report
    "topic_job",  # the batch job end to end, every table and the model written
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="tw-bench-", dir="/tmp")
    spark = local_session(
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        input_partitions=int(cpus),  # the test tables are one row group each
        checkpoint_dir=f"{scratch}/ckpt",
        driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
    )
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    times: dict[str, float] = {}
    steps = _Steps(spark, sf_dir, scratch)
    baseline: dict[str, float] = {}
    QUERIES["merge_categories"](spark, sf_dir.replace("sf0.1", "sf0.01")).write.format("noop").mode("overwrite").save()  # warm-up
    for name in only or HEADLINE + BASELINE:
        t0 = time.perf_counter()
        if name in STEPS + BASELINE:
            inner = getattr(steps, name)()
            elapsed = inner if inner is not None else time.perf_counter() - t0
        else:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - t0
        (baseline if name in BASELINE else times)[name] = round(elapsed, 3)
        print(f"# {name}: {elapsed:.3f}s", file=sys.stderr)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "baseline": baseline,
                "after_shared_fit": [q for q in AFTER_SHARED_FIT if q in times],
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
