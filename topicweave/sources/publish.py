"""Staged commit of a run (S3-S9): write aside, then publish one manifest.

Every attempt of a run writes into a folder of its own, so nothing that a
reader may hold open is deleted or overwritten.  When all tables and models are
there, one small manifest file names the attempt; readers go through the
manifests, so they see finished attempts only.  A job that dies between two
sinks leaves an attempt that no manifest names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

MANIFESTS = "_manifests"


class NoPublishedRun(FileNotFoundError):
    """The folder holds no finished run."""


def hadoop_path(spark: SparkSession, path: str):
    """The file system and the path object of ``path``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def new_attempt(run_dir: str) -> str:
    """A fresh folder for one attempt of the run."""
    return f"{run_dir.rstrip('/')}/attempt={uuid.uuid4().hex}"


def _manifests(spark: SparkSession, run_dir: str) -> list[str]:
    fs, p = hadoop_path(spark, f"{run_dir.rstrip('/')}/{MANIFESTS}")
    if not fs.exists(p):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(p) if f.getPath().getName().endswith(".json"))


def publish(spark: SparkSession, run_dir: str, attempt: str, paths: Mapping[str, str]) -> str:
    """Make ``attempt`` the run's current one: its manifest is written under
    another name, then renamed, so it is there whole or not at all.  Manifests
    are numbered; the last one holds, earlier ones stay."""
    folder, names = f"{run_dir.rstrip('/')}/{MANIFESTS}", _manifests(spark, run_dir)
    number = int(names[-1].split("-")[0]) + 1 if names else 1
    name = f"{number:06d}-{uuid.uuid4().hex}.json"
    fs, aside = hadoop_path(spark, f"{folder}/_{name}.tmp")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(json.dumps({"attempt": attempt, "paths": dict(paths)}, sort_keys=True).encode()))
    finally:
        out.close()
    target = hadoop_path(spark, f"{folder}/{name}")[1]
    if not fs.rename(aside, target):
        raise OSError(f"cannot publish {attempt}: {folder}/{name} was not renamed")
    return f"{folder}/{name}"


def published(spark: SparkSession, run_dir: str) -> dict | None:
    """``{"attempt": folder, "paths": {output: path}}`` of the run's current
    attempt, or None while none is finished."""
    names = _manifests(spark, run_dir)
    if not names:
        return None
    # one small file
    text = "\n".join(r["value"] for r in spark.read.option("wholetext", True).text(f"{run_dir.rstrip('/')}/{MANIFESTS}/{names[-1]}").collect())
    return json.loads(text)


def resolve_run(spark: SparkSession, run_dir: str) -> str:
    """The folder to read: of a run the published attempt; an attempt's own
    folder as it is."""
    if run_dir.rstrip("/").rpartition("/")[2].startswith("attempt="):
        return run_dir.rstrip("/")
    current = published(spark, run_dir)
    if current is None:
        raise NoPublishedRun(f"{run_dir} holds no finished run")
    return current["attempt"]


def published_runs(spark: SparkSession, base: str) -> list[str]:
    """Run folders under ``base`` (``io.run_path``) with a finished attempt."""
    fs, pattern = hadoop_path(spark, f"{base.rstrip('/')}/run=*/k=*/iter=*/seed=*/{MANIFESTS}/*.json")
    found = fs.globStatus(pattern) or []
    return sorted({f.getPath().getParent().getParent().toString() for f in found})


def drop_unpublished(spark: SparkSession, run_dir: str) -> list[str]:
    """Remove attempts that no manifest names (dead jobs'); call it when no
    attempt of the run is being written.  Returns their names."""
    named = set()
    for name in _manifests(spark, run_dir):
        rows = spark.read.option("wholetext", True).text(f"{run_dir.rstrip('/')}/{MANIFESTS}/{name}").collect()
        named.add(json.loads("\n".join(r["value"] for r in rows))["attempt"].rpartition("/")[2])
    fs, p = hadoop_path(spark, run_dir)
    gone = []
    for f in fs.listStatus(p):
        name = f.getPath().getName()
        if name.startswith("attempt=") and name not in named:
            fs.delete(f.getPath(), True)
            gone.append(name)
    return gone
