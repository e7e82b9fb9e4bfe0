"""Adapters from the driver's test tables to the shapes the job consumes.

These are test adapters, not operators of the job: they let the offer rollup
and the document pipeline run on ``/root/testdata/sf*/`` tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicweave.session import dealt


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-offer shape from ``lineitem ⋈ part ⋈ supplier ⟕ documents``.

    One offer per line item.  Dimension joins are plain equi-joins: a side is
    broadcast only when its size is under
    ``spark.sql.autoBroadcastJoinThreshold``.  The
    description is carried per offer, as in the real feed; it is joined last, so
    no exchange of the joins holds a text per offer.
    """
    li = dealt(table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("d_partkey"), F.col("text").alias("long_description")
    )
    described = part.join(docs, part.p_partkey == docs.d_partkey, "left")
    supplied = li.join(supp, li.l_suppkey == supp.s_suppkey, "inner")
    joined = supplied.join(described, li.l_partkey == described.p_partkey, "inner")
    return joined.select(
        F.col("p_name").alias("product_name"),
        F.col("p_partkey").cast("string").alias("item_code"),
        F.col("p_brand").alias("e_brand_formatted_slug"),
        F.col("s_name").alias("retailer_code"),
        F.array(F.col("p_type"), F.concat(F.lit("SIZE_"), F.col("p_size").cast("string"))).alias(
            "e_matched_tokens_categories_formatted"
        ),
        F.col("l_extendedprice").alias("e_price"),
        F.col("long_description"),
    )


def document_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item shape from ``documents``: one item per document."""
    docs = dealt(table(spark, sf_dir, "documents"))
    return docs.select(
        F.col("doc_id").cast("string").alias("product_name"),
        F.array(F.col("source")).alias("brands"),
        F.array(F.col("lang")).alias("categories"),
        F.col("text").alias("description"),
    )
