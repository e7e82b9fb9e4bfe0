"""Report queries over a finished run, read back from its Parquet outputs
(entry points B and C of SURVEY §3: overview, describe, top items per topic,
per-topic categories and brands)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from topicweave.functions.constants import DEFAULT_TOP_ITEMS
from topicweave.operators.report import top_items_report, topic_categories
from topicweave.operators.rollup import describe_items, item_overview
from topicweave.sources.publish import resolve_run


def run_report(spark: SparkSession, run_dir: str, n: int = DEFAULT_TOP_ITEMS) -> dict[str, DataFrame]:
    """Lazy DataFrames for the report of one run folder (``run_path`` output)."""
    base = resolve_run(spark, run_dir)
    items = spark.read.parquet(f"{base}/item_df.parquet")
    item_topics = spark.read.parquet(f"{base}/item_topic_df.parquet")
    top = top_items_report(item_topics, n)
    return {
        "describe": describe_items(items),
        "overview": item_overview(items),
        "top_items": top,
        "topic_categories": topic_categories(top),
        "topics": spark.read.parquet(f"{base}/topics_df.parquet").orderBy("topic"),
    }
