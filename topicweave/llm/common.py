"""Shared helpers: tables in the shared folder, row wrapping, column choice."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicweave.session import ensure_checkpoint_dir

# The white space of every word and normalisation rule: space, \t \n \v \f \r.
WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Folders that operators make inside the block are removed at its end.

    Write the result inside the block: what is read later would find its
    tables gone.  Without a scope the folders stay until the shared checkpoint
    folder is cleaned.
    """
    mark = _SCOPE.set([])
    try:
        yield
    finally:
        paths = _SCOPE.get() or []
        _SCOPE.reset(mark)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for p in paths:
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(conf).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return path


def stage_table(df: DataFrame, name: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage: a lost executor re-reads the table instead of
    re-running what made it.  See ``scratch_scope`` for removing the folders.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with small_batches(spark):
        df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_PER_BATCH = 2000


@contextmanager
def small_batches(spark: SparkSession):
    """Jobs started in the block hand Python at most ``TEXTS_PER_BATCH`` rows at
    a time: rows are whole texts here, and each batch lies in memory twice."""
    before = spark.conf.get(ARROW_ROWS)
    if 0 < int(before) <= TEXTS_PER_BATCH:
        yield
        return
    spark.conf.set(ARROW_ROWS, str(TEXTS_PER_BATCH))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


HOT_ROWS = 1_000_000


def join_counted(rows: DataFrame, groups: DataFrame, key: str | list[str], count: str, how: str = "inner", hot: int = HOT_ROWS) -> DataFrame:
    """``rows`` joined with ``groups``, which holds each ``key`` (columns of
    both) once and, in its column ``count``, how many rows have it.

    Keys of more than ``hot`` rows are broadcast: there is at most one of them
    for every ``hot`` rows, and their rows stay where they are.  The others
    meet in a shuffle in which no key has more than ``hot`` rows.  ``how`` is
    inner or left; ``rows`` is read twice, so give a written table or a scan.
    """
    keys = [key] if isinstance(key, str) else key
    large = groups.where(F.col(count) > hot)
    first = rows.join(F.broadcast(large), keys)
    rest = rows.join(F.broadcast(large.select(*keys)), keys, "left_anti").join(groups.where(F.col(count) <= hot), keys, how)
    return first.select(*rest.columns).unionByName(rest)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)
