"""Exact distinct counts that runs can merge.

Values get dense numbers once, in a dictionary that only grows; a run's
distinct values are then bitmaps over those numbers, one of 4 KB for every
32,768 numbers that occur.  The union of any runs is the bitwise or of their
bitmaps, so counts over several runs read neither offers nor values again.
The values come from ``rollup.offer_values``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.operators.termtable import dense_ids
from topicweave.session import cut_lineage

def _same(a: DataFrame, b: DataFrame) -> Column:
    return (a["kind"] == b["d_kind"]) & a["value"].eqNullSafe(b["d_value"])


def extend_dictionary(values: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """``kind, value, id``: the dictionary with the new ones of ``values``
    (kind, value) numbered behind it, from 1 without gaps in each kind.

    Numbers never change, so bitmaps of earlier runs stay valid.  New values
    are numbered by a range sort; what is broadcast has a row a kind.
    """
    fresh = values.select("kind", "value").distinct()
    if dictionary is not None:
        known = dictionary.select(F.col("kind").alias("d_kind"), F.col("value").alias("d_value"))
        fresh = fresh.join(known, _same(fresh, known), "left_anti")
    placed = cut_lineage(dense_ids(fresh, [F.col("kind").asc(), F.col("value").asc_nulls_first()], "at"))
    first = placed.groupBy("kind").agg(F.min("at").alias("first"))
    if dictionary is not None:
        before = dictionary.groupBy("kind").agg(F.max("id").alias("most"))
        first = first.join(before, "kind", "left")
    else:
        first = first.withColumn("most", F.lit(0).cast("long"))
    starts = first.select(F.col("kind").alias("s_kind"), (F.coalesce("most", F.lit(0)) + 1 - F.col("first")).alias("shift"))
    numbered = placed.join(F.broadcast(starts), F.col("kind") == F.col("s_kind")).select("kind", "value", (F.col("at") + F.col("shift")).alias("id"))
    return numbered if dictionary is None else dictionary.select("kind", "value", "id").unionByName(numbered)


def run_bitmaps(values: DataFrame, dictionary: DataFrame, *by: str) -> DataFrame:
    """``by, kind, bucket, bitmap``: the numbers of ``values`` that occur, for
    each ``by`` (a run, a day, a topic).

    Values are made distinct before the join, so a value that a third of all
    rows hold meets the dictionary once a ``by``.
    """
    known = dictionary.select(F.col("kind").alias("d_kind"), F.col("value").alias("d_value"), "id")
    held = values.select(*by, "kind", "value").distinct()
    numbered = held.join(known, _same(held, known))
    return numbered.groupBy(*by, "kind", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap")
    )


def merge_bitmaps(runs: Iterable[DataFrame] | DataFrame, *by: str) -> DataFrame:
    """``by, kind, bucket, bitmap`` of the runs' union."""
    if isinstance(runs, DataFrame):
        rows = runs
    else:
        first, *rest = [r.select(*by, "kind", "bucket", "bitmap") for r in runs]
        rows = first
        for r in rest:
            rows = rows.unionByName(r)
    return rows.groupBy(*by, "kind", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(bitmaps: DataFrame, *by: str) -> DataFrame:
    """``by, kind, n_distinct``: exact numbers of distinct values."""
    return bitmaps.groupBy(*by, "kind").agg(F.sum(F.bitmap_count("bitmap")).alias("n_distinct"))
