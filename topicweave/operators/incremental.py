"""The item rollup kept up to date by changes.

A state is a table of counted members: for each product, kind and value the
number of offers that hold it, and for each product its offers and the exact
sum of its prices.  A state is dealt out by product, kind and value, and changes
dealt alike are added without another exchange.  New offers add to the counts
and withdrawn ones subtract, so a day's changes touch no old offer; items are
read off the state by the same gathering step as the full rollup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.operators.rollup import CATEGORY_COL, DESCRIPTION, EXACT, ROW, SET_NAMES, is_plain_price
from topicweave.operators.sets import gather_sets

ODD_PRICE = "odd_price"  # a price that does not sum exactly is a member of its own
KEYS = ("product_name", "kind", "value")
MEASURES = ("n", "codes_n", "n_prices", "exact_sum")


def _entries(offers: DataFrame) -> DataFrame:
    """An offer as its members and one ``row`` entry with the measures."""
    price = F.col("e_price").cast("double")
    odd = F.when(price.isNotNull() & ~is_plain_price(price), price.cast("string"))

    def entry(kind, value, code=F.lit(None).cast("string"), price=F.lit(None).cast("double")):
        return F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"), code.alias("code"), price.alias("price"))

    # single members are plain structs: only the categories need a lambda
    single = F.array(
        entry(ROW, F.lit(None), F.col("item_code"), price), entry("codes", F.col("item_code")), entry("brands", F.col("e_brand_formatted_slug")),
        entry("retailers", F.col("retailer_code")), entry(DESCRIPTION, F.col("long_description")), entry(ODD_PRICE, odd),
    )
    # an offer holds a category once
    categories = F.transform(F.coalesce(F.array_distinct(CATEGORY_COL), F.array().cast("array<string>")), lambda v: entry("categories", v))
    opened = offers.select("product_name", F.explode(F.concat(single, categories)).alias("m")).select("product_name", "m.*")
    return opened.where(F.col("value").isNotNull() | F.col("kind").isin("categories", ROW))


def member_counts(offers: DataFrame, sign: int = 1) -> DataFrame:
    """The state of ``offers`` alone (``sign`` -1: of their withdrawal).

    One aggregation, so a member (a description is a whole text) is exchanged
    once.  A hot product's ``row`` entries become one row in each map task.
    """
    exact = F.sum(F.when(is_plain_price(F.col("price")), F.col("price")).cast(EXACT))
    return _entries(offers).groupBy(*KEYS).agg(
        (F.count(F.lit(1)) * sign).alias("n"), (F.count("code") * sign).alias("codes_n"), (F.count("price") * sign).alias("n_prices"),
        (F.coalesce(exact, F.lit(0).cast(EXACT)) * sign).cast(EXACT).alias("exact_sum"),
    )


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(*[F.sum(c).cast(EXACT if c == "exact_sum" else "long").alias(c) for c in MEASURES])


def apply_changes(state: DataFrame, added: DataFrame | None = None, withdrawn: DataFrame | None = None) -> DataFrame:
    """The state after new and withdrawn offers: one aggregation of the state
    with the changes' own counts.  Members that no offer holds any more go.

    All parts are dealt out by the members, so the sums need no exchange of
    their own; a state that is dealt so already is not moved."""
    rows = state.select(*KEYS, *MEASURES).repartition(*KEYS)
    for offers, sign in ((added, 1), (withdrawn, -1)):
        if offers is not None:
            rows = rows.unionByName(member_counts(offers, sign))
    return _summed(rows).where("n != 0")


def unmatched(state: DataFrame) -> DataFrame:
    """Members withdrawn more often than offered: ``product_name, kind, value,
    n`` with n below 0.  A state without such rows is consistent."""
    return state.where("n < 0").select(*KEYS, "n")


def items_of(state: DataFrame) -> DataFrame:
    """The item table (the columns of ``rollup.to_items``) of a state.

    A product's row gathers its distinct members, which is what it returns.
    """
    held = state.where("n > 0")
    row, odd = F.col("kind") == ROW, F.col("kind") == ODD_PRICE
    merged = gather_sets(
        held,
        "product_name",
        SET_NAMES,
        ("categories",),
        aggs=[
            F.min(F.when(F.col("kind") == DESCRIPTION, F.col("value"))).alias("description"),
            _only(row, "codes_n").alias("purchase_count"),
            _only(row, "n_prices").alias("n_prices"),
            F.sum(F.when(row, F.col("exact_sum"))).alias("exact_sum"),
            F.sum(F.when(odd, F.col("value").cast("double") * F.col("n"))).alias("odd_sum"),
        ],
    )
    total = F.col("exact_sum").cast("double") + F.coalesce("odd_sum", F.lit(0.0))
    return merged.select(
        "product_name", "codes", "brands", "retailers", "categories", "description",
        F.when(F.col("n_prices") > 0, total / F.col("n_prices")).alias("price"),
        "purchase_count",
        F.size("retailers").alias("retrailer_count"),
        F.size("categories").alias("category_count"),
        F.size("brands").alias("brand_count"),
        F.size("codes").alias("code_count"),
    )


def _only(which: Column, measure: str) -> Column:
    return F.coalesce(F.sum(F.when(which, F.col(measure))), F.lit(0).cast("long"))
