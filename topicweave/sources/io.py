"""Scans and sinks (S1-S12): JSON-lines offers, Parquet tables, LDA models."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import DistributedLDAModel, LDAModel, LocalLDAModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from topicweave.sources.publish import resolve_run
from topicweave.sources.schemas import RAW_OFFER_SCHEMA

if TYPE_CHECKING:
    from topicweave.operators.features import FeatureModel


CORRUPT = "_corrupt_record"


def read_offers_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines offer feed with the explicit raw schema.

    No inference pass; Catalyst prunes the parsed fields to the ones used.  A
    line that is not JSON, or whose value has another type than the schema's,
    fails the read; ``read_offers_split`` sets such lines apart instead.
    """
    return spark.read.schema(RAW_OFFER_SCHEMA).option("mode", "FAILFAST").json(path)


def read_offers_split(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(offers, rejects)``; ``rejects`` holds the malformed lines as they
    are (``line``).  Nothing malformed becomes an offer, nothing is lost."""
    schema = StructType([*RAW_OFFER_SCHEMA.fields, StructField(CORRUPT, StringType())])
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.select("value", F.from_json("value", schema, options).alias("o"))
    bad = F.col("o").isNull() | F.col(f"o.{CORRUPT}").isNotNull()
    good = parsed.where(~bad).select(*[F.col(f"o.{f.name}").alias(f.name) for f in RAW_OFFER_SCHEMA.fields])
    return good, parsed.where(bad).select(F.col("value").alias("line"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan (filters and projections push into the reader)."""
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Parquet sink; ML vector columns round-trip unchanged."""
    df.write.mode(mode).parquet(path)
    return path


def run_path(base: str, version: str, k: int, iterations: int, seed: int) -> str:
    """Unambiguous versioned output folder for one run."""
    base = base.rstrip("/")
    return f"{base}/run={version}/k={k}/iter={iterations}/seed={seed}"


def save_model(model: LDAModel, path: str) -> str:
    """Save an LDA model; a distributed (EM) model is made local first."""
    if model.isDistributed():
        model = model.toLocal()
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> LDAModel:
    """Load a saved LDA model, local or distributed, by the class that its
    metadata names."""
    spark = SparkSession.active()
    saved = spark.read.json(f"{path.rstrip('/')}/metadata").select("class").first()["class"]
    kinds = {"LocalLDAModel": LocalLDAModel, "DistributedLDAModel": DistributedLDAModel}
    kind = kinds.get(saved.rpartition(".")[2])
    if kind is None:
        raise ValueError(f"{path} holds a {saved}, not an LDA model")
    return kind.load(path)


def save_features(model: FeatureModel, path: str) -> str:
    """The feature stage: vector pipeline, vocabulary with df, idf and
    corpus counts, and the number of documents."""
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    counted = model.vocab_df.withColumn("n_docs", F.lit(model.n_docs).cast("long"))
    write_table(counted, f"{path}/vocabulary.parquet")
    return path


def load_features(spark: SparkSession, path: str) -> FeatureModel:
    """The feature stage that ``save_features`` wrote."""
    from topicweave.operators.features import FeatureModel

    pipeline = PipelineModel.load(f"{path}/pipeline")
    table = read_table(spark, f"{path}/vocabulary.parquet")
    n_docs = table.first()["n_docs"]
    counts = pipeline.stages[0]
    return FeatureModel(
        vocabulary=list(counts.vocabulary),
        vocab_df=table.drop("n_docs"),
        pipeline=pipeline,
        n_docs=n_docs,
        words_col=counts.getInputCol(),
        features_col=pipeline.stages[-1].getOutputCol(),
    )


def preview(df: DataFrame, n: int = 20, truncate: bool | int = False) -> None:
    """Console preview of at most ``n`` rows."""
    df.show(n, truncate)


# fixed values: the statistics tables of a run
VIS_TABLES = ("doc_stats", "vocab", "topic_term", "prevalence", "relevance")


def read_vis_stats(spark: SparkSession, run_dir: str) -> dict[str, DataFrame]:
    """The visualization statistics of one run, one DataFrame per table
    (replaces unpickling a driver-side dict)."""
    base = resolve_run(spark, run_dir)
    return {name: spark.read.parquet(f"{base}/lda_vis/{name}.parquet") for name in VIS_TABLES}


def read_topic_map(spark: SparkSession, run_dir: str) -> tuple[DataFrame, DataFrame]:
    """The topics' pairwise distances and their map of one run."""
    base = resolve_run(spark, run_dir)
    return read_table(spark, f"{base}/lda_vis/distances.parquet"), read_table(spark, f"{base}/lda_vis/topic_map.parquet")
