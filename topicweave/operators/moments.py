"""Count, mean and spread that runs can merge and no layout changes.

A column's state is (n, mean, m2, least, most), m2 the sum of squared
deviations.  States are merged in a fixed tree: rows fall into leaves by a hash
of their content, each leaf and each node adds up its parts in a fixed order,
so the result has the same bits for every partitioning, and a leaf never holds
more than a bounded share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.operators.rollup import DESCRIBE_COLUMNS
from topicweave.session import cut_lineage

LEAF_ROWS = 1000  # distinct values of a leaf, about
FAN_IN = 64

STATE = "struct<n:bigint,mean:double,m2:double,least:double,most:double>"


def _empty() -> Column:
    return F.lit(None).cast(STATE)


def merged_pair(a: Column, b: Column) -> Column:
    """Two states as one (pairwise update of mean and squared deviations)."""
    n = a["n"] + b["n"]
    gap = b["mean"] - a["mean"]
    both = F.struct(
        n.alias("n"),
        (a["mean"] + gap * (b["n"] / n)).alias("mean"),
        (a["m2"] + b["m2"] + gap * gap * (a["n"] * (b["n"] / n))).alias("m2"),
        F.least(a["least"], b["least"]).alias("least"),
        F.greatest(a["most"], b["most"]).alias("most"),
    )
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(both)


def _folded(states: Column) -> Column:
    return F.aggregate(states, _empty(), merged_pair)


def moments(df: DataFrame, cols: Sequence[str] = DESCRIBE_COLUMNS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``column_name, state`` for each of ``cols``; nulls are not counted.

    Equal values are counted first (partial sums), so a value that most rows
    hold is one entry; what remains is dealt out to leaves by hash.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in cols])
    rows = df.select(F.explode(pairs).alias("p")).select("p.column_name", "p.x").where(F.col("x").isNotNull())
    counted = cut_lineage(rows.groupBy("column_name", "x").agg(F.count(F.lit(1)).alias("n")))
    most = counted.groupBy("column_name").count().agg(F.max("count")).first()[0] or 0
    leaves = 1
    while leaves * leaf_rows < most:
        leaves *= FAN_IN
    own = F.struct(F.col("n").alias("n"), F.col("x").alias("mean"), F.lit(0.0).alias("m2"), F.col("x").alias("least"), F.col("x").alias("most"))
    level = counted.select("column_name", F.pmod(F.xxhash64("x"), F.lit(leaves)).alias("at"), F.struct(F.col("x").alias("by"), own.alias("state")).alias("part"))
    while True:
        parts = level.groupBy("column_name", "at").agg(F.array_sort(F.collect_list("part")).alias("parts"))
        nodes = parts.select("column_name", "at", _folded(F.transform("parts", lambda p: p["state"])).alias("state"))
        if leaves == 1:
            return nodes.select("column_name", "state")
        leaves //= FAN_IN
        level = nodes.select("column_name", F.expr(f"at div {FAN_IN}").alias("at"), F.struct(F.col("at").alias("by"), "state").alias("part"))


def merge_moments(runs: DataFrame, order: str) -> DataFrame:
    """``column_name, state`` over several runs' states, merged in the order of
    the column ``order`` (a run's number); as many rows a group as runs."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("by"), F.col("state"))))
    return runs.groupBy("column_name").agg(parts.alias("parts")).select("column_name", _folded(F.transform("parts", lambda p: p["state"])).alias("state"))


def moment_stats(states: DataFrame) -> DataFrame:
    """``column_name, count, mean, stddev, min, max`` (sample deviation; null
    for a single value)."""
    s = F.col("state")
    spread = F.when(s["n"] > 1, F.sqrt(s["m2"] / (s["n"] - 1)))
    return states.select("column_name", s["n"].alias("count"), s["mean"].alias("mean"), spread.alias("stddev"), s["least"].alias("min"), s["most"].alias("max"))
