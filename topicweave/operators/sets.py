"""Per-key distinct sets that stay balanced when one key is hot.

``collect_set`` pre-aggregates per map task, but each task still sends its
own partial set: a key holding a third of all rows makes one reducer receive
(tasks x distinct values), far more than the result.  Here the members are
first de-duplicated as ``(key, kind, value)`` rows -- that exchange is keyed
by the value too, so a hot key's members spread over every reducer -- and only
then gathered per key, where the hot key's reducer receives each distinct
value once: exactly the output it has to produce.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _empty() -> Column:
    return F.array().cast("array<string>")


def member_structs(sets: Mapping[str, Column]) -> Column:
    """All members of a row's sets as ``array<struct<kind, value>>``.

    ``sets`` maps a set name to an ``array<string>`` expression (a scalar
    column ``c`` is passed as ``F.array(c)``); a null array has no members.
    """

    def tagged(name: str, expr: Column) -> Column:
        # (one-argument lambda: transform() reads a second one as the index)
        return F.transform(
            F.coalesce(expr.cast("array<string>"), _empty()),
            lambda v: F.struct(F.lit(name).alias("kind"), v.alias("value")),
        )

    return F.concat(*[tagged(name, expr) for name, expr in sets.items()])


def distinct_members(
    df: DataFrame,
    key: str,
    sets: Mapping[str, Column],
    keep_null: Iterable[str] = (),
) -> DataFrame:
    """``key, kind, value``: one row per distinct member of each named set.

    Null members are dropped except for the sets named in ``keep_null``, where
    one null is a value.
    """
    keep_null = list(keep_null)
    pairs = (
        df.select(key, F.explode_outer(member_structs(sets)).alias("m"))
        .where(F.col("m").isNotNull())
        .select(key, "m.kind", "m.value")
    )
    keep = F.col("value").isNotNull()
    if keep_null:
        keep = keep | F.col("kind").isin(keep_null)
    return pairs.where(keep).distinct()


def gather_sets(
    members: DataFrame,
    key: str,
    names: Iterable[str],
    keep_null: Iterable[str] = (),
    rows: DataFrame | None = None,
    aggs: Sequence[Column] = (),
) -> DataFrame:
    """One row per key: a sorted array per set name (null first when kept).

    ``rows`` (other columns keyed by ``key``) and their ``aggs`` are merged in
    the same aggregation -- no join, and their partial aggregates are built
    map-side before the exchange like any aggregation.
    """
    keep_null = set(keep_null)
    data = members if rows is None else members.unionByName(rows, allowMissingColumns=True)
    out = []
    for name in names:
        values = F.sort_array(F.collect_list(F.when(F.col("kind") == name, F.col("value"))))
        if name in keep_null:
            has_null = F.max((F.col("kind") == name) & F.col("value").isNull())
            values = F.when(
                F.coalesce(has_null, F.lit(False)),
                F.concat(F.array(F.lit(None).cast("string")), values),
            ).otherwise(values)
        out.append(values.alias(name))
    return data.groupBy(key).agg(*out, *aggs)
