"""Session helpers: local test sessions and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "topicweave",
    checkpoint_dir: str | None = None,
    driver_memory: str = "8g",
    input_partitions: int | None = None,
) -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on).

    On a cluster the session is built by whoever submits the job; nothing in
    the library depends on this function.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
    )
    if checkpoint_dir is None:
        checkpoint_dir = tempfile.mkdtemp(prefix="topicweave-ckpt-", dir="/tmp")
    builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if input_partitions:
        builder = builder.config(INPUT_PARTITIONS, str(input_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it if needed.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that value
    is always used.  Only a local-mode session without that setting (tests,
    benchmarks) gets a fresh folder under /tmp.  A cluster session without it
    is an error: a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
    elif _is_local(spark):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="topicweave-ckpt-", dir="/tmp"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder (HDFS/object "
            "store) so iterative stages can cut their lineage"
        )
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never a local one): the data is written to the
    shared checkpoint folder, so losing an executor does not re-run the
    upstream plan.  Partitioning and sort order are kept."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark's cleaner delete the shuffle files of plans that nothing refers
    to any more, such as those behind a checkpoint.  The cleaner acts when the
    driver's JVM collects its garbage, by itself every half an hour."""
    spark.sparkContext._jvm.System.gc()


INPUT_PARTITIONS = "spark.topicweave.inputPartitions"


def dealt(df: DataFrame) -> DataFrame:
    """Deal rows out to the number of partitions that the session names in
    ``spark.topicweave.inputPartitions``; unset (the default), ``df`` itself.

    For inputs that the scan cannot split, such as a test file of one row
    group.  Nothing is counted or executed to decide it.
    """
    n = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(n)) if n else df
