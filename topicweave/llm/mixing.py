"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target in words; a document of the source is to be taken
``target / source size`` times.  The whole part is taken for certain; the
fractions are rounded dependently: two documents at a time exchange mass at
random, keeping the words they stand for, until one fraction is 0 or 1.  Each
(source, leaf) group leaves one fraction; those meet in a reduction tree of
fixed shape, so a source of any size is spread over the leaves, every task
holds one open fraction, and the words taken miss the target by one
document's size at most.

Defined cases: null text has size 0 and is taken 0 times; null sources are one
source, the last; repeated rows are drawn each; sources without words have
target 0; an empty table gives no rows; other columns are ignored.  The draw
depends on the rows, the seed and the tree's shape only, not on partitioning.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicweave.llm.common import WORD, read_table, stage_table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
SEED = 17
LEAVES = 4096
FAN_IN = 64


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words)."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """source, source_size, target.

    Sources in code-point order (null last) weigh ``weights``, repeating.  A
    target stops at ``most`` times its source; the excess is shared again by
    weight until none is above.  Each round is one aggregation; only sums
    reach the driver.
    """
    spark = sizes.sparkSession
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).orderBy(F.col("source").asc_nulls_last())
    cycle = list(weights)
    numbered = spark.createDataFrame(
        per_source.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], float(cycle[x[1] % len(cycle)]))),
        "source string, source_size long, weight double",
    )
    table = stage_table(numbered, "source-weights").withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    level, stopped = 0.0, -1
    while True:
        above = F.col("cap") < F.lit(level) * F.col("weight")
        total, capped, weight, n = table.agg(
            F.sum("source_size"),
            F.sum(F.when(above, F.col("cap")).otherwise(0.0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
            F.sum(above.cast("long")),
        ).first()
        if n == stopped or not weight:
            break
        stopped, level = n, (share * total - capped) / weight
    return table.select(
        F.col("source").alias("t_source"),
        "source_size",
        F.least(F.col("cap"), F.lit(level) * F.col("weight")).alias("target"),
    )


ROUND_SCHEMA = "doc_id long, source string, size long, whole long, p double, leaf long"


def _exchange(p: float, a: int, q: float, b: int, u: float) -> tuple[float, float]:
    """Move mass between fractions p and q of sizes a and b, keeping a*p + b*q,
    until one is 0 or 1; each keeps its expected value."""
    up, down = min(a * (1 - p), b * q), min(a * p, b * (1 - q))
    if u * (up + down) < down:
        return (1.0, q - up / b) if a * (1 - p) <= b * q else (p + up / a, 0.0)
    return (0.0, q + down / b) if a * p <= b * (1 - q) else (p - down / a, 1.0)


def rounding_level(rows: DataFrame, span: int, level: int, seed: int, last: bool = False) -> DataFrame:
    """Round the fractions of each (source, leaf // span) group until one is left."""
    names = [c.split()[0] for c in ROUND_SCHEMA.split(", ")]
    group = F.floor(F.col("leaf") / span).cast("long")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.withColumn("grp", group).repartition(n, "source", "grp").sortWithinPartitions(
        "source", "grp", "leaf", F.xxhash64("doc_id", F.lit(seed)), "doc_id", "size"
    )

    def run(batches):
        key, open_row, draw = None, None, None
        for batch in batches:
            cols = {c: batch.column(c).to_pylist() for c in [*names, "grp"]}
            out = []
            for row in zip(*(cols[c] for c in names), cols["grp"], strict=True):
                row, grp = list(row[:-1]), row[-1]
                if (row[1], grp) != key:
                    if open_row is not None:
                        out.append(open_row)
                    key, open_row = (row[1], grp), None
                    draw = random.Random(f"{seed}|{level}|{grp}|{row[1]}")
                if not 0 < row[4] < 1:
                    out.append(row)
                elif open_row is None:
                    open_row = row
                else:
                    open_row[4], row[4] = _exchange(open_row[4], open_row[2], row[4], row[2], draw.random())
                    if 0 < row[4] < 1:
                        out.append(open_row)
                        open_row = row
                    else:
                        out.append(row)
                        if not 0 < open_row[4] < 1:
                            out.append(open_row)
                            open_row = None
            yield frame(out, last, draw)
        if open_row is not None:
            yield frame([open_row], last, draw)

    def frame(out, closing, draw):
        if closing:  # what is left of a whole source is drawn by itself
            for row in out:
                if 0 < row[4] < 1:
                    row[4] = float(random.Random(f"{seed}|last|{row[0]}|{row[1]}").random() < row[4])
        columns = list(zip(*out, strict=True)) or [[]] * len(names)
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return ordered.mapInArrow(run, ROUND_SCHEMA)


def mix_sources(spark: SparkSession, docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES, seed: int = SEED, leaves: int = LEAVES, fan_in: int = FAN_IN) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    sizes = stage_table(document_sizes(docs), "mix-sizes")
    targets = stage_table(source_targets(sizes, weights, share, most), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = sizes.join(targets, sizes["source"].eqNullSafe(targets["t_source"]))
    wanted = F.when(F.col("size") > 0, ratio).otherwise(0.0)
    rows = joined.select(
        "doc_id",
        "source",
        "size",
        F.floor(wanted).cast("long").alias("whole"),
        (wanted - F.floor(wanted)).alias("p"),
        F.pmod(F.xxhash64("doc_id"), F.lit(leaves)).alias("leaf"),
    )
    parts, span, level = [], 1, 0
    while True:
        last = span >= leaves
        done = stage_table(rounding_level(rows, span, level, seed, last), f"mix-round-{level}")
        open_ = (F.col("p") > 0) & (F.col("p") < 1)
        parts.append(done.where(~open_))
        if last:
            break
        rows, span, level = done.where(open_), span * fan_in, level + 1
    decided = parts[0]
    for part in parts[1:]:
        decided = decided.unionByName(part)
    copies = F.col("whole") + F.round("p").cast("long")
    return decided.join(targets, decided["source"].eqNullSafe(targets["t_source"])).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mixed_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, all its columns."""
    from pyspark.sql import Window

    keys = ["m_id", "m_source", "m_size"]
    drawn = mix_sources(spark, docs, **options).groupBy(
        F.col("doc_id").alias("m_id"), F.col("source").alias("m_source"), F.col("size").alias("m_size")
    ).agg(F.sort_array(F.collect_list("copies")).alias("copies"))
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col("doc_id").cast("long").alias("d_id"),
        F.col("source").cast("string").alias("d_source"),
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("d_size"),
    )
    same = rows["d_id"].eqNullSafe(drawn["m_id"]) & rows["d_source"].eqNullSafe(drawn["m_source"]) & (rows["d_size"] == drawn["m_size"])
    joined = rows.join(drawn, same)
    # Rows that agree in id, source and size take the drawn numbers in turn.
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("row.text")))
    taken = joined.withColumn("n", F.element_at("copies", turn)).where("n > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("row.*")


def op2_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(spark, read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )
