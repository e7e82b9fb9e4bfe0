"""Item rollup and item-level descriptive queries.

The rollup never sends a hot product's rows, or its per-task partial sets,
to one reducer: see ``to_items``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.operators.sets import gather_sets, member_structs

CATEGORY_COL = "e_matched_tokens_categories_formatted"

# A price that this type holds with at least nine digits after the point is
# summed exactly, so the mean does not depend on row order or partitioning.
EXACT = "decimal(38,18)"
EXACT_MOST, EXACT_LEAST = 1e15, 1e-9


def is_plain_price(c: Column) -> Column:
    """Prices that sum exactly; false for NaN, infinities and extreme sizes."""
    size = F.abs(c)
    return ~F.isnan(c) & (size <= EXACT_MOST) & ((c == 0) | (size >= EXACT_LEAST))


def mean_parts(price: Column) -> list[Column]:
    """A5: aggregates that ``mean_of`` combines; partial ones can be merged."""
    return [
        F.try_sum(F.when(is_plain_price(price), price).cast(EXACT)).alias("exact_sum"),
        F.sum(price).alias("double_sum"),
        F.count(price).alias("n_prices"),
        F.bool_and(is_plain_price(price)).alias("all_plain"),
    ]


def mean_of(exact_sum: Column, double_sum: Column, n: Column, all_plain: Column) -> Column:
    """Mean of the non-null prices, from the exact sum where all of them sum
    exactly, from the double sum otherwise (NaN and infinities pass through;
    nothing is dropped).  Null without a price."""
    total = F.coalesce(F.when(all_plain, exact_sum.cast("double")), double_sum)
    return F.when(n > 0, total / n)


SET_NAMES = ("codes", "brands", "retailers", "categories")
ROW = "row"  # the kind that carries the scalar measures
DESCRIPTION = "description"
ROW_SALTS = 256


def to_items(
    offers: DataFrame, sets: Sequence[str] = SET_NAMES, described: bool = True, measured: bool = True
) -> DataFrame:
    """A1: one row per ``product_name`` (null names form their own group).

    * codes / brands / retailers: distinct non-null values (A2), sorted.
    * categories: distinct union of the offers' category lists (A3); a null
      element counts as a value, like the union of Python sets would.
    * description: the smallest non-null description (A4: any member is a
      valid representative; the minimum is deterministic and null-safe).
    * price: mean of non-null prices (A5, see ``mean_of``); purchase_count:
      non-null item codes (A6, it counts offers); sizes of the sets (A7).

    One pass over the offers, two exchanges, no join.  An offer becomes its
    set members, its description and one ``row`` entry with the scalar measures.  The first
    aggregation is keyed by (product, kind, value), the ``row`` entries by a
    salt in place of the value, so a hot product spreads over all reducers;
    the second gathers each product's distinct members and merges at most
    ``ROW_SALTS`` partial measures.

    A caller that needs a part names it: ``sets``, the description, the
    measures (price, purchase_count).  What is not named is not read.
    """
    held = {
        "codes": F.array("item_code"),
        "brands": F.array("e_brand_formatted_slug"),
        "retailers": F.array("retailer_code"),
        "categories": F.col(CATEGORY_COL),
    }
    held = {name: held[name] for name in SET_NAMES if name in sets}
    if described:
        held[DESCRIPTION] = F.array("long_description")
    members = member_structs(held)
    null = F.lit(None)
    if not measured:
        return _gathered_sets(offers, members, list(held), described)
    salt = F.pmod(F.xxhash64("item_code", "retailer_code", "e_price"), F.lit(ROW_SALTS)).cast("string")
    blank = [null.cast("string").alias("code"), null.cast("double").alias("price")]
    wide = F.transform(members, lambda m: F.struct(m["kind"].alias("kind"), m["value"].alias("value"), *blank))
    row = F.array(
        F.struct(
            F.lit(ROW).alias("kind"), salt.alias("value"),
            F.col("item_code").alias("code"), F.col("e_price").cast("double").alias("price"),
        )
    )
    # the description is a member of its own, so equal ones collapse in the map
    # tasks and every partial measure has a fixed size (hash aggregation)
    entries = offers.select("product_name", F.explode(F.concat(row, wide)).alias("m")).select("product_name", "m.*")
    partial = (
        entries.where(F.col("value").isNotNull() | (F.col("kind") == "categories"))
        .groupBy("product_name", "kind", "value")
        .agg(
            F.count("code").alias("purchase_count"),
            *mean_parts(F.col("price")),
        )
    )
    names = [name for name in held if name != DESCRIPTION]
    merged = gather_sets(
        partial,
        "product_name",
        names,
        ("categories",),
        aggs=[
            *_description(described),
            F.sum("purchase_count").alias("purchase_count"),
            F.try_sum("exact_sum").alias("exact_sum"),
            F.count(F.when(F.col("n_prices") > 0, F.col("exact_sum"))).alias("exact_parts"),
            F.count(F.when(F.col("n_prices") > 0, 1)).alias("parts"),
            F.sum("double_sum").alias("double_sum"),
            F.sum("n_prices").alias("n_prices"),
            F.bool_and("all_plain").alias("all_plain"),
        ],
    )
    # a partial sum beyond the exact type is null: then the double mean holds
    exact = F.when(F.col("exact_parts") == F.col("parts"), F.col("exact_sum"))
    return merged.select(
        "product_name",
        *names,
        *(["description"] if described else []),
        mean_of(exact, F.col("double_sum"), F.col("n_prices"), F.col("all_plain")).alias("price"),
        "purchase_count",
        *_sizes(names),
    )


# fixed values: the published names of the set sizes, in their order
SIZE_NAMES = (("retailers", "retrailer_count"), ("categories", "category_count"), ("brands", "brand_count"), ("codes", "code_count"))


def _sizes(names: Sequence[str]) -> list[Column]:
    return [F.size(name).alias(size) for name, size in SIZE_NAMES if name in names]


def _description(described: bool) -> list[Column]:
    return [F.min(F.when(F.col("kind") == DESCRIPTION, F.col("value"))).alias("description")] if described else []


def _gathered_sets(offers: DataFrame, members: Column, names: list[str], described: bool) -> DataFrame:
    """The rollup without measures: distinct members only, and one entry that
    stands for a product without any."""
    row = F.array(F.struct(F.lit(ROW).alias("kind"), F.lit("").alias("value")))
    entries = offers.select("product_name", F.explode(F.concat(row, members)).alias("m")).select("product_name", "m.*")
    distinct = entries.where(F.col("value").isNotNull() | (F.col("kind") == "categories")).distinct()
    names = [name for name in names if name != DESCRIPTION]
    merged = gather_sets(distinct, "product_name", names, ("categories",), aggs=_description(described))
    return merged.select("product_name", *names, *(["description"] if described else []), *_sizes(names))


def offer_values(offers: DataFrame, *keep: str) -> DataFrame:
    """``kind, value`` (and ``keep``): what the overview counts, as it stands in
    the offers.  Nulls are left out except among the categories, where a null
    is a value.  No other column is read."""
    sets = {
        "product": F.array("product_name"), "retailers": F.array("retailer_code"),
        "categories": F.col(CATEGORY_COL), "brands": F.array("e_brand_formatted_slug"),
    }
    rows = offers.select(*keep, F.explode(member_structs(sets)).alias("m")).select(*keep, "m.kind", "m.value")
    return rows.where(F.col("value").isNotNull() | (F.col("kind") == "categories"))


def offers_overview(offers: DataFrame) -> DataFrame:
    """A9 / A10 straight from the offers: the counts of ``item_overview``
    without rolling anything up.  Values are made distinct map-side and by one
    exchange keyed by (kind, value)."""
    counts = offer_values(offers).distinct().groupBy("kind").agg(F.count(F.lit(1)).alias("n"))

    def pick(kind: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).cast("long").alias(f"{kind}_distinct")

    return counts.agg(*[pick(kind) for kind in ("product", "retailers", "categories", "brands")])


def item_overview(items: DataFrame) -> DataFrame:
    """Distinct products, retailers, categories and brands.

    All four distinct counts run through one exchange keyed by
    ``(kind, value)``: values are spread over all reducers, and nothing is
    collected into a single task.  A null category element counts once,
    like the union of sets it replaces; a null set column has no members.
    """
    sets = {"product": F.array("product_name"), **{c: F.col(c) for c in ("retailers", "categories", "brands")}}
    pairs = items.select(F.explode(member_structs(sets)).alias("kv")).select("kv.kind", "kv.value")
    per_kind = pairs.groupBy("kind").agg(
        F.count_distinct("value").alias("n"),
        F.max(F.col("value").isNull().cast("int")).alias("has_null"),
    )

    def pick(kind: str, with_null: bool) -> F.Column:
        n = F.col("n") + (F.col("has_null") if with_null else F.lit(0))
        return F.coalesce(F.max(F.when(F.col("kind") == kind, n)), F.lit(0)).cast("long")

    return per_kind.agg(
        pick("product", False).alias("product_distinct"),
        pick("retailers", False).alias("retailers_distinct"),
        pick("categories", True).alias("categories_distinct"),
        pick("brands", False).alias("brands_distinct"),
    )


DESCRIBE_COLUMNS = ("price", "code_count", "category_count", "retrailer_count", "brand_count")


def describe_items(items: DataFrame, cols: Sequence[str] = DESCRIBE_COLUMNS) -> DataFrame:
    """Spark's ``describe`` (count, mean, stddev, min, max as strings)."""
    return items.describe(list(cols))


def summary_stats(items: DataFrame, cols: Sequence[str] = DESCRIBE_COLUMNS) -> DataFrame:
    """A11, typed: one row per column with count, mean, stddev, min, max.

    One aggregation computes every statistic of every column; the result is
    unpivoted with ``stack`` (no per-column jobs).
    """
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"{c}__count"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__stddev"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
        ]
    wide = items.agg(*aggs)
    parts = ", ".join(
        f"'{c}', `{c}__count`, `{c}__mean`, `{c}__stddev`, `{c}__min`, `{c}__max`" for c in cols
    )
    return wide.selectExpr(
        f"stack({len(cols)}, {parts}) as (column_name, count, mean, stddev, min, max)"
    )
