"""LDA topic model: fit, assign, describe, topic-term table, sweep.

Training is ``pyspark.ml.clustering.LDA``.  Two things make a run
reproducible (the same seed gives the same model whatever the input layout):
the vocabulary order (see ``features``) and the canonical training layout
``repartition(n, key).sortWithinPartitions(key)`` with a fixed ``n``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicweave.functions.arrays import dist_array, top_index, top_score
from topicweave.functions.constants import (
    DEFAULT_K,
    DEFAULT_MAX_ITER,
    DEFAULT_SEED,
    DEFAULT_TOPIC_TERMS,
)
from topicweave.session import ensure_checkpoint_dir
from topicweave.sources.io import save_model

# Training partitions of a run, recorded with it.  Online LDA runs two small
# jobs an iteration over them; raise it with the corpus (some 100 MB of
# vectors a partition), not with the cluster.
LAYOUT_PARTITIONS = 8
DOCS_A_PARTITION = 10_000


def layout_partitions(n_docs: int) -> int:
    """Training partitions of a corpus: ``LAYOUT_PARTITIONS``, and more from so
    many documents on that a partition would hold over ``DOCS_A_PARTITION``."""
    return max(LAYOUT_PARTITIONS, -(-n_docs // DOCS_A_PARTITION))


def canonical_layout(df: DataFrame, key: str = "product_name", partitions: int = LAYOUT_PARTITIONS) -> DataFrame:
    """Hash-partition on ``key`` into a fixed number of partitions and sort
    inside each, so row order no longer depends on upstream execution."""
    return df.repartition(partitions, key).sortWithinPartitions(key)


def training_input(
    features: DataFrame,
    key: str = "product_name",
    partitions: int = LAYOUT_PARTITIONS,
    words_col: str = "cleaned_words",
) -> DataFrame:
    """Narrow rows (key, features, doc_length) in the canonical layout, kept
    in memory or on the executors' disks (LDA makes one pass per iteration).

    The layout depends on ``partitions`` alone, an explicit run parameter:
    neither on the number of documents nor on a session setting.  It is the
    same after a lost executor, whose part is computed again from the feature
    table.  Call ``unpersist()`` when the model and the scores are written.
    """
    length = F.col("doc_length") if "doc_length" in features.columns else F.size(words_col).alias("doc_length")
    narrow = features.select(key, "features", length)
    return canonical_layout(narrow, key, partitions).persist(StorageLevel.MEMORY_AND_DISK)


def fit_lda(
    features: DataFrame,
    k: int = DEFAULT_K,
    max_iter: int = DEFAULT_MAX_ITER,
    seed: int = DEFAULT_SEED,
    features_col: str = "features",
    optimizer: str = "online",
) -> LDAModel:
    """M5: fit LDA on TF-IDF vectors (pass the output of ``training_input``)."""
    lda = LDA(k=k, maxIter=max_iter, seed=seed, featuresCol=features_col, optimizer=optimizer)
    return lda.fit(features)


ITEM_KEYS = ("product_name", "brands", "categories")


def with_assignment(scored: DataFrame, keep: Iterable[str] = ITEM_KEYS) -> DataFrame:
    """M7 + P2: from rows holding ``topicDistribution``, the arg-max ``score``
    (float) and ``topic`` (int); an all-zero distribution gives 0.0 / 0.  The
    distribution is an ML vector or an ``array<double>``."""
    plain = scored.schema["topicDistribution"].dataType.typeName() == "array"
    dist = F.col("topicDistribution") if plain else dist_array("topicDistribution")
    return scored.select(
        *keep,
        "topicDistribution",
        top_score(dist).alias("score"),
        top_index(dist).alias("topic"),
    )


def assign_topics(model: LDAModel, features: DataFrame, keep: Iterable[str] = ITEM_KEYS) -> DataFrame:
    """M6 + M7: infer ``topicDistribution`` and assign the best topic."""
    return with_assignment(model.transform(features), keep)


def score_all(model: LDAModel, features: DataFrame, key: str = "product_name", keep: Iterable[str] = (), words_col: str = "cleaned_words") -> DataFrame:
    """M6: ``key, keep, topicDistribution, doc_length`` of every document, in
    the partitions that ``features`` has (the feature table's own ones: the
    fixed layout is for the fit alone).

    Write it once and let every consumer read the table, so that none of them
    runs the per-document inference again.
    """
    length = F.col("doc_length") if "doc_length" in features.columns else F.size(words_col).alias("doc_length")
    return model.transform(features.select(key, *keep, "features", length)).select(key, *keep, "topicDistribution", "doc_length")


def topic_weights(spark: SparkSession, model_path: str) -> DataFrame:
    """``term_idx, weights array<double>``: a saved model's matrix, one row a
    term, read from the model's own table (the driver never holds it)."""
    saved = spark.read.parquet(f"{model_path.rstrip('/')}/data").select(F.unwrap_udt("topicsMatrix").alias("m"))
    shape = saved.select(F.col("m.numRows").alias("v"), F.col("m.numCols").alias("k"), F.col("m.isTransposed").alias("by_row"), F.col("m.values").alias("x"))

    def place(i, t):
        return F.when(F.col("by_row"), i * F.col("k") + t).otherwise(t * F.col("v") + i)

    def row(i):
        topics = F.sequence(F.lit(0), F.col("k") - 1)
        return F.struct(i.alias("term_idx"), F.transform(topics, lambda t: F.get(F.col("x"), place(i, t))).alias("weights"))

    return shape.select(F.explode(F.transform(F.sequence(F.lit(0), F.col("v") - 1), row)).alias("r")).select("r.*")


def term_shares(weights: DataFrame, vocab_df: DataFrame) -> DataFrame:
    """M9 / V4: ``topic, term_idx, word, weight, prob`` for every term of a
    given topic-term matrix (``term_idx, weights``); ``prob`` is the entry's
    share of its topic.  What is broadcast has one row a topic.
    """
    opened = weights.select("term_idx", F.posexplode("weights").alias("topic", "weight"))
    totals = opened.groupBy("topic").agg(F.sum("weight").alias("total"))
    joined = opened.join(F.broadcast(totals), "topic").join(vocab_df.select("term_idx", "word"), "term_idx")
    return joined.select("topic", "term_idx", "word", "weight", (F.col("weight") / F.col("total")).alias("prob"))


def term_distribution(model: LDAModel, vocab_df: DataFrame, model_path: str | None = None) -> DataFrame:
    """M9 / V4 of a fitted model: ``term_shares`` of its matrix, as saved in
    ``model_path`` (saved in the shared checkpoint folder without it)."""
    spark = vocab_df.sparkSession
    path = model_path or save_model(model, f"{ensure_checkpoint_dir(spark)}/lda-{uuid.uuid4().hex}")
    return term_shares(topic_weights(spark, path), vocab_df)


def leading_terms(terms: DataFrame, n_terms: int = DEFAULT_TOPIC_TERMS) -> DataFrame:
    """``topic, term_rank, term_idx, word, weight``: each topic's ``n_terms``
    most probable terms (ties by term index), from any table of
    ``topic, term_idx, word, prob``.

    The rank filter is planned as a limit before the shuffle.
    """
    w = Window.partitionBy("topic").orderBy(F.col("prob").desc(), F.col("term_idx").asc())
    ranked = terms.withColumn("term_rank", F.row_number().over(w) - 1).where(F.col("term_rank") < n_terms)
    return ranked.select("topic", "term_rank", "term_idx", "word", F.col("prob").alias("weight"))


def described(top: DataFrame) -> DataFrame:
    """M8 + F7: ``topic, top_terms array<struct<words, termWeights>>`` in rank
    order, from ``leading_terms``: parallel word and weight lists, zipped."""
    ordered = F.array_sort(F.collect_list(F.struct("term_rank", "word", "weight")))
    lists = top.groupBy("topic").agg(ordered.alias("t")).select(
        "topic",
        F.transform("t", lambda x: x["word"]).alias("words"),
        F.transform("t", lambda x: x["weight"]).alias("termWeights"),
    )
    return lists.select("topic", F.arrays_zip("words", "termWeights").alias("top_terms"))


def topic_terms(model: LDAModel, vocab_df: DataFrame, n_terms: int = DEFAULT_TOPIC_TERMS, model_path: str | None = None) -> DataFrame:
    """M8 in long form: one row per (topic, rank) with the word and its weight."""
    return leading_terms(term_distribution(model, vocab_df, model_path), n_terms)


def describe_topics(model: LDAModel, vocab_df: DataFrame, n_terms: int = DEFAULT_TOPIC_TERMS, model_path: str | None = None) -> DataFrame:
    """M8: ``topic, top_terms array<struct<words, termWeights>>`` in rank order."""
    return described(topic_terms(model, vocab_df, n_terms, model_path))


@dataclass
class SweepResult:
    k: int
    max_iter: int
    seed: int
    log_likelihood: float
    log_perplexity: float
    model: LDAModel


def sweep(
    training: DataFrame,
    grid: Iterable[tuple[int, int, int]],
    features_col: str = "features",
    max_parallel: int = 4,
    fitted: Mapping[tuple[int, int, int], LDAModel] | None = None,
) -> list[SweepResult]:
    """One fit per ``(k, iterations, seed)`` on features computed once.

    The fits are independent, so they are submitted as concurrent Spark jobs
    (each LDA iteration is a small job; run one after another they would
    leave most of the cluster idle).  ``logLikelihood`` is a distributed
    evaluation over the training input; the perplexity is what
    ``logPerplexity`` gives, minus that bound over the input's weight, without
    inferring every document again.  Results keep the grid order.

    ``fitted`` holds models by point that were fitted on ``training`` before:
    the same fit again would give the same model, bit for bit.
    """
    fitted = fitted or {}
    values = F.coalesce(F.unwrap_udt(features_col)["values"], F.array().cast("array<double>"))
    weight = training.select(F.sum(F.aggregate(values, F.lit(0.0), lambda a, x: a + x))).first()[0] or 0.0

    def one(point: tuple[int, int, int]) -> SweepResult:
        k, it, seed = point
        model = fitted.get((k, it, seed)) or fit_lda(training, k, it, seed, features_col)
        bound = float(model.logLikelihood(training))
        return SweepResult(k, it, seed, bound, -bound / weight if weight else float("nan"), model)

    points = list(grid)
    with ThreadPoolExecutor(max_workers=max(1, min(len(points), max_parallel))) as pool:
        return list(pool.map(one, points))


def sweep_table(
    training: DataFrame,
    grid: Iterable[tuple[int, int, int]],
    features_col: str = "features",
    fitted: Mapping[tuple[int, int, int], LDAModel] | None = None,
) -> DataFrame:
    """M10 as a table: ``k, max_iter, seed, log_likelihood, log_perplexity``."""
    rows = [
        (r.k, r.max_iter, r.seed, r.log_likelihood, r.log_perplexity)
        for r in sweep(training, grid, features_col, fitted=fitted)
    ]
    return training.sparkSession.createDataFrame(
        rows, "k int, max_iter int, seed int, log_likelihood double, log_perplexity double"
    )
