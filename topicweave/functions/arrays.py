"""Array and distribution expressions.

These replace the reference's Python UDFs with native expressions.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def merge_sets(nested: str | Column) -> Column:
    """Distinct union of an ``array<array<T>>``, sorted.

    Null sub-lists are skipped; a null *element* is kept once (it is a value
    of the union), and sorts first.
    """
    present = F.filter(_col(nested), lambda x: x.isNotNull())
    return F.sort_array(F.array_distinct(F.flatten(present)))


def dist_array(vec: str | Column) -> Column:
    """ML vector -> ``array<double>`` (JVM-side conversion)."""
    return vector_to_array(_col(vec))


def top_score(dist: str | Column) -> Column:
    """largest probability, narrowed to float like the reference."""
    return F.array_max(_col(dist)).cast("float")


def top_index(dist: str | Column) -> Column:
    """zero-based index of the first maximum (first one wins a tie)."""
    d = _col(dist)
    return (F.array_position(d, F.array_max(d)) - F.lit(1)).cast("int")


def score_topic(dist: str | Column) -> Column:
    """``struct<score float, topic int>`` of an ``array<double>``.

    An all-zero distribution gives score 0.0 and topic 0.
    """
    d = _col(dist)
    return F.struct(top_score(d).alias("score"), top_index(d).alias("topic"))


def dist_sum(dist: str | Column) -> Column:
    """sum of a distribution."""
    return F.aggregate(_col(dist), F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def is_complete(dist: str | Column, tol: float = 1e-9, exact: bool = False) -> Column:
    """The distribution sums to one (exactly, or within ``tol``)."""
    s = dist_sum(dist)
    if exact:
        return s == F.lit(1.0)
    return F.abs(s - F.lit(1.0)) <= F.lit(tol)


def vector_entries(vec: str | Column) -> Column:
    """Non-zero entries of an ML vector as ``array<struct<idx int, value double>>``.

    Sparse vectors keep their own indices, so a 262k-term vocabulary costs
    only the stored entries per row, never a dense array.
    """
    parsed = F.unwrap_udt(_col(vec))
    dense_idx = F.sequence(F.lit(0), F.size(parsed["values"]) - F.lit(1))
    idx = F.when(parsed["type"] == 0, parsed["indices"]).otherwise(dense_idx)
    zipped = F.arrays_zip(idx.alias("idx"), parsed["values"].alias("value"))
    entries = F.transform(
        zipped, lambda e: F.struct(e["idx"].alias("idx"), e["value"].alias("value"))
    )
    return F.filter(entries, lambda e: e["value"] != F.lit(0.0))


def sorted_join(arr: str | Column, sep: str = ",") -> Column:
    """Order-free text form of a set column (nulls skipped)."""
    return F.array_join(F.sort_array(_col(arr)), sep)
