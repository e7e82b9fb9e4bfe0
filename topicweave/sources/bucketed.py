"""Run tables in buckets (J3, S4, S5): joined by their key without an exchange.

Items, features and scores of a run are one row a product each, and readers
put them side by side.  Written into the same number of buckets of the key,
they are shuffled once, by the writer; a join then reads bucket by bucket.

A Parquet folder does not say how it is bucketed, so a small file beside the
data does (``_buckets.json``, which Parquet readers skip).  Any session builds
its scan from that file; the table that Spark's catalog needs for it lives only
while the scan is planned, so nothing is left there.  Plain readers see an
ordinary Parquet folder.

Defined cases: a null key has a bucket like any value, and ``join_buckets``
pairs null with null; an empty table keeps its schema and layout but has no
data file, so only ``read_bucketed`` reads it; ML vectors
come back in their stored form (``type, size, indices, values``), as the
catalog has no name for the vector type; a folder without the file, or with
another key or number of buckets than its partner, is an error of the join.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicweave.sources.publish import hadoop_path

LAYOUT = "_buckets.json"


class NotBucketed(ValueError):
    """The folder's files are not in (fitting) buckets."""


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> str:
    """One file a bucket of ``key``, sorted by it; the folder must be new.

    A bucket is one task's work for every join of the table, so ``buckets``
    grows with the rows: some hundred MB each.  The key should be (nearly)
    unique, as a run's product names are; all rows of one value share a bucket.
    """
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    rows = df.repartition(buckets, F.col(_quoted(key)))
    rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    spark.sql(f"drop table {name}")  # an external table: its files stay
    columns = df._jdf.schema().toDDL()
    fs, at = hadoop_path(spark, f"{path.rstrip('/')}/{LAYOUT}")
    out = fs.create(at, False)
    try:
        out.write(bytearray(json.dumps({"key": key, "buckets": buckets, "columns": columns}).encode()))
    finally:
        out.close()
    return path


def bucket_layout(spark: SparkSession, path: str) -> dict:
    """``{"key", "buckets", "columns"}`` of a folder of ``write_bucketed``."""
    at = f"{path.rstrip('/')}/{LAYOUT}"
    fs, p = hadoop_path(spark, at)
    if not fs.exists(p):
        raise NotBucketed(f"{path} does not say how it is bucketed")
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table with its buckets known to the optimizer."""
    layout, name = bucket_layout(spark, path), f"bucketed_{uuid.uuid4().hex}"
    key, where = _quoted(layout["key"]), path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"create table {name} ({layout['columns']}) using parquet "
        f"clustered by ({key}) sorted by ({key}) into {layout['buckets']} buckets location '{where}'"
    )
    try:
        return spark.table(name)  # resolved to its files here
    finally:
        spark.sql(f"drop table {name}")


def join_buckets(spark: SparkSession, left: str, right: str, how: str = "inner", null_keys: bool = True) -> DataFrame:
    """Two bucketed folders side by side (``inner`` or ``left``), merged bucket
    by bucket; columns of both are the left one's.

    Rows with a null key, pruned to their bucket, are paired in a small join of
    their own; ``null_keys=False`` leaves them out.
    """
    ours, theirs = bucket_layout(spark, left), bucket_layout(spark, right)
    if how not in ("inner", "left"):
        raise ValueError(f"{how}: inner or left")
    if any(ours[x] != theirs[x] for x in ("key", "buckets")):
        raise NotBucketed(f"{left} and {right} have other buckets: {ours['key']}, {ours['buckets']}; {theirs['key']}, {theirs['buckets']}")
    key, a, b = ours["key"], read_bucketed(spark, left), read_bucketed(spark, right)
    added = [c for c in b.columns if c not in a.columns]
    k, other = _quoted(key), f"_{key}_of_right"
    b = b.select(F.col(k).alias(other), *map(_quoted, added))

    def side_by_side(x: DataFrame, y: DataFrame, on) -> DataFrame:
        return x.join(y.hint("merge"), on, how).select(*[x[_quoted(c)] for c in a.columns], *[y[_quoted(c)] for c in added])

    named = a.where(F.col(k).isNotNull())
    keyed = side_by_side(named, b, named[k] == b[_quoted(other)])
    if not null_keys:
        return keyed
    blank, blank_b = a.where(F.col(k).isNull()), b.where(F.col(_quoted(other)).isNull())
    return keyed.unionByName(side_by_side(blank, blank_b, blank[k].eqNullSafe(blank_b[_quoted(other)])))
