"""Topic-visualization statistics as distributed tables.

Each statistic is a DataFrame keyed by its natural key, never a
position-paired driver list: document lengths and distributions come from
one projection of the scored features, so no row pairing is needed (J3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicweave.functions.arrays import dist_array, dist_sum, is_complete

DEFAULT_LAMBDA = 0.6


def doc_stats(
    scored_features: DataFrame,
    key: str = "product_name",
    words_col: str = "cleaned_words",
    dist_col: str = "topicDistribution",
    tol: float = 1e-9,
    exact: bool = False,
) -> DataFrame:
    """V1 + V5 + P6: ``key, doc_length, topic_dist, dist_sum, complete``.

    ``dist_col`` holds an ML vector or an ``array<double>``; ``doc_length``
    counts every kept token (in or out of the vocabulary).
    ``complete`` is the sum-to-one test; ``exact=True`` uses float equality.
    """
    plain = scored_features.schema[dist_col].dataType.typeName() == "array"
    dist = F.transform(dist_col, lambda x: x.cast("double")) if plain else dist_array(dist_col)
    length = F.col("doc_length") if "doc_length" in scored_features.columns else F.size(words_col)
    return scored_features.select(
        key,
        length.cast("int").alias("doc_length"),
        dist.alias("topic_dist"),
    ).select(
        key,
        "doc_length",
        "topic_dist",
        dist_sum("topic_dist").alias("dist_sum"),
        is_complete("topic_dist", tol, exact).alias("complete"),
    )


def complete_docs(stats: DataFrame, rejects: bool = False) -> DataFrame:
    """V6: the documents whose distribution is complete, or the others."""
    complete = F.coalesce(F.col("complete"), F.lit(False))
    return stats.where(~complete if rejects else complete)


def vocab_stats(vocab_df: DataFrame) -> DataFrame:
    """V2 + V3: ``term_idx, word, term_frequency`` (corpus count per word, J2
    is the join done while the vocabulary was built)."""
    return vocab_df.select("term_idx", "word", "term_frequency")


def topic_prevalence(stats: DataFrame) -> DataFrame:
    """V7: ``topic, token_mass, prevalence`` = sum_d len_d * theta_dk, normalized.

    Grouping is by topic over a per-document explode (k rows per document),
    partially aggregated before the shuffle.
    """
    mass = (
        stats.where(F.col("complete"))
        .select("doc_length", F.posexplode_outer("topic_dist").alias("topic", "p"))
        .where(F.col("topic").isNotNull())
        .groupBy("topic")
        .agg(F.sum(F.col("doc_length") * F.col("p")).alias("token_mass"))
    )
    total = F.sum("token_mass").over(Window.partitionBy())  # k rows
    return mass.select(
        F.col("topic").cast("int").alias("topic"),
        "token_mass",
        (F.col("token_mass") / total).alias("prevalence"),
    )


def term_relevance(terms: DataFrame, vocab_df: DataFrame, lam: float = DEFAULT_LAMBDA, n_terms: int | None = None) -> DataFrame:
    """V7: ``relevance = lam * ln(phi) + (1 - lam) * ln(phi / p_w)``.

    ``terms`` holds ``topic, term_idx, word, prob`` (``term_distribution``);
    ``phi`` is the topic's term probability, ``p_w`` the word's share of all
    corpus tokens in the vocabulary (``term_frequency`` of ``vocab_df``).
    Every (topic, term) is there; with ``n_terms`` only the most relevant ones
    of each topic, ranked.
    """
    total = vocab_df.agg(F.sum("term_frequency")).first()[0]  # one number
    tf = vocab_df.select(
        "term_idx", (F.col("term_frequency") / F.lit(float(total or 1))).alias("p_w")
    )
    phi = F.col("prob")
    rel = terms.join(tf, "term_idx").select(
        "topic",
        "term_idx",
        "word",
        "prob",
        "p_w",
        (phi / F.col("p_w")).alias("lift"),
        (F.lit(lam) * F.log(phi) + F.lit(1.0 - lam) * F.log(phi / F.col("p_w"))).alias("relevance"),
    )
    if n_terms is None:
        return rel
    w = Window.partitionBy("topic").orderBy(F.col("relevance").desc(), F.col("term_idx").asc())
    return rel.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n_terms)
