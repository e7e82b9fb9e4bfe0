"""Exact deduplication as a stateful stream (native: DataFrame operations only).

Every document is fingerprinted once; the narrow fingerprint table feeds a
Structured Streaming aggregation whose state (RocksDB on disk, no watermark,
never expired) keeps for each digest the stable identifier and the content
locator of the row that stays, and the group's size.  A locator is a file and
the row's number in it, so the text that it names can be read again.  The state
outlives the call: ``StreamingDeduplicator`` over the same folder goes on where
it ended, each call being a batch with a number of its own; a document that
comes again is one more copy of the row that stays.

Hits are checked on full bytes.  Rows of one batch that share a digest are
grouped by the normalised text itself; a digest that an earlier batch holds is
compared with the text that the locator names.  A digest with two texts is
resolved by text, over all batches.

Defined cases: null text counts as empty; equal texts are those identical
after deleting space and \\t \\n \\v \\f \\r; the row with the most code points
stays, then the smallest id (null ids last), then the earliest batch; of fully
equal rows with one id exactly one stays; an empty table gives no rows; other
columns are ignored.  Documents that come from no file (or from one without row
numbers) are landed in the folder, and the locators name the landed files.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicweave.llm.common import HOT_ROWS, WHITE, is_empty, join_counted, read_table, scratch_path, stage_table, text_or_empty

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Many small stores: no space set aside on disk for each of them.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # All stores of an executor share this much native memory.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
}
FINGERPRINT = "batch long, row_no long, doc_id long, n_cp int, file string, row_in_file long, digest binary"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE + "+", "")


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _order() -> Column:
    """What the row that stays is the smallest of."""
    return F.struct(
        (-F.col("n_cp")).alias("neg_cp"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "batch", "row_no", "file", "row_in_file"
    )


def _kept(best: Column) -> list[Column]:
    names = {"keep_id": "doc_id", "keep_batch": "batch", "keep_row": "row_no", "file": "file", "row_in_file": "row_in_file"}
    return [*[best[field].alias(name) for name, field in names.items()], (-best["neg_cp"]).alias("keep_cp")]


class StreamingDeduplicator:
    """Digest-keyed state under ``folder`` (a shared folder).

    ``files_per_batch`` bounds a micro-batch by landed files.
    """

    def __init__(self, spark: SparkSession, folder: str, digest: Callable[[Column], Column] = sha256_digest, files_per_batch: int = 1000):
        self.spark, self.folder, self.digest, self.files = spark, folder, digest, files_per_batch

    @property
    def landing(self) -> str:
        return f"{self.folder}/fingerprints"

    @property
    def collided(self) -> str:
        return f"{self.folder}/collisions"

    @property
    def checkpoint(self) -> str:
        return f"{self.folder}/state"

    def fingerprints(self) -> DataFrame:
        """Every row of every batch."""
        return self.spark.read.schema(FINGERPRINT).parquet(self.landing)

    def next_batch(self) -> int:
        """Batches are numbered from 0 by the fingerprints that are there."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(self.landing)
        if not path.getFileSystem(conf).exists(path):
            return 0
        last = self.fingerprints().agg(F.max("batch")).first()[0]
        return 0 if last is None else last + 1

    def _located(self, docs: DataFrame, batch: int) -> DataFrame:
        """``docs`` (doc_id, text) with file and row_in_file."""
        try:
            return docs.select("doc_id", "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_in_file"))
        except AnalysisException:
            landed = f"{self.folder}/texts/batch-{batch}"
            docs.write.mode("overwrite").option("compression", "zstd").parquet(landed)
            return self._located(self.spark.read.schema("doc_id long, text string").parquet(landed), batch)

    def ingest(self, docs: DataFrame) -> DataFrame:
        """Fingerprint ``docs`` (doc_id, text), run the stream over them, check
        its hits and return ``collisions``."""
        batch = self.next_batch()
        docs = self._located(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), batch)
        text = text_or_empty()
        rows = docs.select(
            F.lit(batch).cast("long").alias("batch"),
            F.monotonically_increasing_id().alias("row_no"),
            "doc_id",
            F.length(text).alias("n_cp"),
            "file",
            "row_in_file",
            self.digest(normalised(F.col("text"))).alias("digest"),
        )
        rows.write.mode("append").option("compression", "zstd").parquet(self.landing)
        before = {k: self.spark.conf.get(k, None) for k in STATE_CONF}
        for k, v in STATE_CONF.items():
            self.spark.conf.set(k, v)
        try:
            stream = (
                self.spark.readStream.schema(FINGERPRINT)
                .option("maxFilesPerTrigger", self.files)
                .parquet(self.landing)
            )
            (
                stream.groupBy("digest").agg(F.min(_order()).alias("best"), F.count("*").alias("group_size"))
                .writeStream.outputMode("update")
                .format("noop")
                .option("checkpointLocation", self.checkpoint)
                .trigger(availableNow=True)
                .start()
                .awaitTermination()
            )
        finally:
            for k, v in before.items():
                if v is None:
                    self.spark.conf.unset(k)
                else:
                    self.spark.conf.set(k, v)
        return self._check_hits(docs, batch)

    def collisions(self) -> DataFrame:
        """Digests that stand for more than one text, of all batches."""
        return self.spark.read.schema("digest binary").parquet(self.collided).distinct()

    def groups(self) -> DataFrame:
        """The state: digest, keep_id, keep_batch, keep_row, keep_cp, file,
        row_in_file, group_size."""
        state = self.spark.read.format("statestore").load(self.checkpoint)
        value = [f.name for f in state.schema["value"].dataType.fields]
        best, size = F.col("value")[value[0]], F.col("value")[value[1]]
        return state.select(F.col("key.digest").alias("digest"), *_kept(best), size.alias("group_size"))

    def texts_at(self, places: DataFrame) -> DataFrame:
        """``places`` (file, row_in_file, ...) with ``text``, read again from
        the files that they name.  File names alone reach the driver."""
        files = sorted(r["file"] for r in places.select("file").distinct().collect())
        if not files:
            return places.withColumn("text", F.lit(None).cast("string"))
        read = self.spark.read.schema("text string").parquet(*map(unquote, files))
        named = read.select("text", F.col("_metadata.file_path").alias("t_file"), F.col("_metadata.row_index").alias("t_row"))
        return places.join(named, (F.col("file") == F.col("t_file")) & (F.col("row_in_file") == F.col("t_row"))).drop("t_file", "t_row")

    def _check_hits(self, docs: DataFrame, batch: int) -> DataFrame:
        """Digests of the batch that stand for more than one text, by full bytes.

        Copies of one text collapse in the map tasks, so a large group of
        copies sends one row per task.  Of each digest that earlier batches
        hold, one earlier text (a batch's texts are one by then) is read.
        """
        texts = docs.select(normalised(F.col("text")).alias("norm")).select(self.digest(F.col("norm")).alias("digest"), "norm")
        if batch:
            own = texts.select("digest").distinct()
            places = self.fingerprints().where(F.col("batch") < batch).groupBy("digest").agg(F.min(F.struct("batch", "file", "row_in_file")).alias("at"))
            earlier = stage_table(places.join(own, "digest", "left_semi").select("digest", "at.file", "at.row_in_file"), "exact-earlier")
            texts = texts.unionByName(self.texts_at(earlier).select("digest", normalised(F.col("text")).alias("norm")))
        distinct = texts.groupBy("digest", "norm").agg(F.count("*").alias("n"))
        found = distinct.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1").select("digest")
        found.write.mode("append").parquet(self.collided)
        return self.collisions()

    def decisions(self, collided: DataFrame, hot: int = HOT_ROWS) -> DataFrame:
        """Every row of every batch: batch, doc_id, keep_id, group_size, kept,
        digest, file, row_in_file (of the text that stays)."""
        groups = stage_table(self.groups().select("digest", "keep_id", "keep_batch", "keep_row", F.struct("file", "row_in_file").alias("place"), "group_size"), "exact-groups")
        rows = self.fingerprints().select("batch", "row_no", "doc_id", "digest")
        kept = (F.col("batch") == F.col("keep_batch")) & (F.col("row_no") == F.col("keep_row"))
        plain = join_counted(rows, groups, "digest", "group_size", hot=hot).select("batch", "doc_id", "keep_id", "group_size", kept.alias("kept"), "digest", "place.*")
        if is_empty(collided):
            return plain
        return plain.join(collided, "digest", "left_anti").unionByName(self._by_text(collided))

    def _by_text(self, collided: DataFrame) -> DataFrame:
        """Rows of digests that stand for several texts, grouped by the text."""
        places = stage_table(self.fingerprints().join(collided, "digest", "left_semi"), "exact-collided-places")
        rows = stage_table(self.texts_at(places).select(*places.columns, normalised(F.col("text")).alias("norm")), "exact-collided-rows")
        best = rows.groupBy("digest", "norm").agg(F.min(_order()).alias("best"), F.count("*").alias("group_size")).select("digest", "norm", "group_size", *_kept(F.col("best")))
        kept = (F.col("batch") == F.col("keep_batch")) & (F.col("row_no") == F.col("keep_row"))
        return rows.drop("file", "row_in_file").join(best, ["digest", "norm"]).select(
            "batch", "doc_id", "keep_id", "group_size", kept.alias("kept"), "digest", "file", "row_in_file"
        )


def exact_dedup(
    spark: SparkSession, docs: DataFrame, folder: str | None = None, digest: Callable[[Column], Column] = sha256_digest, files_per_batch: int = 1000, hot: int = HOT_ROWS
) -> DataFrame:
    """One row per document (of every batch in ``folder``): batch, doc_id,
    keep_id, group_size, kept, digest, and where the kept text lies (file,
    row_in_file)."""
    state = StreamingDeduplicator(spark, folder or scratch_path(spark, "exact-dedup"), digest, files_per_batch)
    return state.decisions(state.ingest(docs), hot)


def op5_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup(spark, read_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_cp,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_cp DESC, doc_id NULLS LAST)
"""


def kept_documents(spark: SparkSession, docs: DataFrame, digest: Callable[[Column], Column] = sha256_digest) -> DataFrame:
    """The documents that stay, with all their columns.

    Rows find their group by (digest, id, size), so a large group of copies
    spreads over the tasks; of fully equal rows one stays.
    """
    state = StreamingDeduplicator(spark, scratch_path(spark, "exact-dedup"), digest)
    collided = state.ingest(docs)
    keepers = stage_table(
        state.groups().select(F.col("digest").alias("g_digest"), F.col("keep_id").alias("g_id"), F.col("keep_cp").alias("g_cp")),
        "exact-keepers",
    )
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col("doc_id").cast("long").alias("k_id"),
        F.length(text_or_empty()).alias("k_cp"),
        normalised(F.col("text")).alias("norm"),
    ).withColumn("digest", digest(F.col("norm")))
    found = (rows["digest"] == keepers["g_digest"]) & rows["k_id"].eqNullSafe(keepers["g_id"]) & (rows["k_cp"] == keepers["g_cp"])
    plain = rows.drop("norm").join(keepers, found, "left_semi").dropDuplicates(["digest", "k_id", "k_cp"])
    if is_empty(collided):
        return plain.select("row.*")
    best = F.struct((-F.col("k_cp")).alias("neg_cp"), F.col("k_id").isNull().alias("no_id"), "k_id")
    by_text = rows.join(collided, "digest", "left_semi").groupBy("digest", "norm").agg(F.min_by("row", best).alias("row"))
    return plain.join(collided, "digest", "left_anti").select("row.*").unionByName(by_text.select("row.*"))
