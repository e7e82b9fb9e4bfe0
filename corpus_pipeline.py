"""A corpus pipeline of the training-data operators.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame.  ``run`` writes each stage as Parquet and reads it
back as the next one's documents, so a lost executor costs part of one stage.
All stages but the last return the columns of the documents they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from topicweave.llm import exact_dedup, mixing, ngram_join, packing, quality_rules
from topicweave.llm.common import read_table, scratch_path, scratch_scope


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects; the rules come from ``labels``."""
    rules = quality_rules.fit_rules(docs, read_table(spark, sf_dir, "labels"))
    return quality_rules.kept_documents(docs, rules)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.kept_documents(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.kept_documents(spark, docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it (0, 1 or 2)."""
    return mixing.mixed_documents(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences with their ids, and where each lies."""
    return packing.packed_pieces(spark, docs)


STAGES = [
    ("quality rules", keep_quality),
    ("exact dedup", drop_copies),
    ("n-gram jaccard join", drop_near_copies),
    ("mixing", mix),
    ("best-fit packing", pack),
]

# Learned rules, a random draw and a tokenizer: SQL cannot express them;
# tests/llm/test_pipeline.py holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        with scratch_scope(spark):  # what the stage itself wrote goes with it
            stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return docs


PIPELINE_QUERY = {"pipeline": run}
PIPELINE_ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
