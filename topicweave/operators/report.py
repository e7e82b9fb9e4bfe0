"""Report queries over scored items."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicweave.functions.constants import DEFAULT_TOP_ITEMS
from topicweave.operators.sets import distinct_members, gather_sets
from topicweave.session import cut_lineage


def rank_within_topic(
    scored: DataFrame,
    topic_col: str = "topic",
    score_col: str = "score",
    tie_col: str = "product_name",
) -> DataFrame:
    """``rank`` = row_number over (topic, score desc, tie-breaker asc).

    Without a rank limit this is a per-topic window: all rows of a topic are
    ordered in one task.  The report only needs it under ``rank <= n``; use
    ``top_per_topic`` for that, which Spark limits before the shuffle, and
    ``rank_within_topic_balanced`` to rank every row of a skewed topic.
    """
    w = Window.partitionBy(topic_col).orderBy(F.col(score_col).desc(), F.col(tie_col).asc())
    return scored.withColumn("rank", F.row_number().over(w))


def rank_within_topic_balanced(
    scored: DataFrame,
    topic_col: str = "topic",
    score_col: str = "score",
    tie_col: str = "product_name",
    partitions: int | None = None,
) -> DataFrame:
    """W1 for every row, without sending a topic to one task.

    Rows are range-partitioned and sorted by (topic, score desc, tie), so a
    topic holding most rows is split over many balanced partitions.  Each
    row's position inside its partition comes from
    ``monotonically_increasing_id`` (partition index in the high bits); the
    rank is that position minus the first position of the topic in the
    partition, plus the number of the topic's rows in earlier partitions.
    Those offsets come from a (partition, topic) count table -- partitions x
    topics rows, the only thing broadcast.  The sorted data is checkpointed
    once so both uses see the same layout.
    """
    spark = scored.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(topic_col).asc(), F.col(score_col).desc(), F.col(tie_col).asc()]
    ranged = (
        scored.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    ranged = cut_lineage(ranged)
    part = F.shiftright(F.col("_id"), 33)
    runs = ranged.groupBy(part.alias("_p"), F.col(topic_col)).agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    earlier = Window.partitionBy(topic_col).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        "_p", topic_col, "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    left = ranged.withColumn("_p", part)
    right = offsets.withColumnRenamed(topic_col, "_t").withColumnRenamed("_p", "_rp")
    # null-safe on the topic: rows without a topic are ranked as their own group
    cond = (left["_p"] == right["_rp"]) & left[topic_col].eqNullSafe(right["_t"])
    joined = left.join(F.broadcast(right), cond)
    rank = F.col("_id") - F.col("_first") + F.lit(1) + F.col("_before")
    return joined.withColumn("rank", rank.cast("long")).drop(
        "_id", "_p", "_rp", "_t", "_first", "_before"
    )


def top_per_topic(
    scored: DataFrame,
    n: int = DEFAULT_TOP_ITEMS,
    topic_col: str = "topic",
    score_col: str = "score",
    tie_col: str = "product_name",
) -> DataFrame:
    """Top ``n`` rows per topic (W1 + P4).

    The ``rank <= n`` filter over ``row_number`` is planned by Spark as a
    partial ``WindowGroupLimit`` before the shuffle: each map task forwards at
    most ``n`` rows per topic, so a topic holding most items never lands in one
    task whole.
    """
    return rank_within_topic(scored, topic_col, score_col, tie_col).where(F.col("rank") <= n)


def top_items_report(scored: DataFrame, n: int = DEFAULT_TOP_ITEMS) -> DataFrame:
    """T1 + T2 + P5: ``topic, product_name, categories, brands`` sorted by topic."""
    return (
        top_per_topic(scored, n)
        .orderBy("topic", "rank")
        .select("topic", "product_name", "categories", "brands")
    )


def topic_categories(samples: DataFrame, topic_col: str = "topic") -> DataFrame:
    """Distinct categories and brands per topic, sorted by topic.

    Topics are few, so each is a hot key: members are de-duplicated as
    ``(topic, kind, value)`` first (spread over all reducers), then gathered.
    A null element is kept once, like the nested-set union.
    """
    members = distinct_members(
        samples,
        topic_col,
        {"distinct_category": F.col("categories"), "distinct_brands": F.col("brands")},
        keep_null=("distinct_category", "distinct_brands"),
    )
    per = gather_sets(
        members, topic_col, ("distinct_category", "distinct_brands"),
        ("distinct_category", "distinct_brands"),
        rows=samples.select(topic_col),  # topics whose lists are all empty still appear
    )
    return per.orderBy(topic_col)
