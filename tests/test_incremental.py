"""The rollup kept up to date by changes, against full rollups."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tests.test_rollup import CAT, _offers
from topicweave.operators.incremental import apply_changes, items_of, member_counts, unmatched
from topicweave.operators.rollup import offers_overview, item_overview, to_items
from topicweave.plans import catalog
from topicweave.plans.catalog import _together


def random_offers(seed, n=400):
    rnd = random.Random(seed)
    pick = lambda *xs: rnd.choice(xs)
    rows = []
    for i in range(n):
        rows.append(
            dict(
                product_name=pick("hot", "hot", "hot", "p1", "p2", None, f"q{i % 20}"), item_code=pick(None, f"c{i % 7}", f"c{i}"),
                e_brand_formatted_slug=pick(None, "b1", "b2"), retailer_code=pick("r1", "r2", None),
                long_description=pick(None, "text a", "text b", "z"), e_price=pick(None, 1.5, 0.1, 19.99, float(i)),
                **{CAT: pick(None, [], ["x"], ["x", "x", None], ["y", "z"])},
            )
        )
    return rows


def table(items):
    return sorted((tuple(map(str, r)) for r in items.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_halves_equal_one_pass(spark, seed):
    rows = random_offers(seed)
    whole, a, b = _offers(spark, rows), _offers(spark, rows[:150]), _offers(spark, rows[150:])
    state = apply_changes(member_counts(a), added=b)
    assert items_of(state).columns == to_items(whole).columns
    assert table(items_of(state)) == table(to_items(whole)) == table(items_of(member_counts(whole)))
    assert unmatched(state).count() == 0


@pytest.mark.parametrize("seed", [3, 4])
def test_withdrawal_equals_a_rollup_without_the_rows(spark, seed):
    rows = random_offers(seed)
    gone, kept = rows[::3], [r for i, r in enumerate(rows) if i % 3]
    state = apply_changes(member_counts(_offers(spark, rows)), withdrawn=_offers(spark, gone))
    assert table(items_of(state)) == table(to_items(_offers(spark, kept)))
    both = apply_changes(member_counts(_offers(spark, gone)), added=_offers(spark, kept), withdrawn=_offers(spark, gone))
    assert table(items_of(both)) == table(items_of(state))


def test_everything_withdrawn_and_unknown_offers(spark):
    rows = random_offers(5, 60)
    state = apply_changes(member_counts(_offers(spark, rows)), withdrawn=_offers(spark, rows))
    assert state.count() == 0 and items_of(state).count() == 0
    wrong = apply_changes(member_counts(_offers(spark, rows[:1])), withdrawn=_offers(spark, [dict(product_name="never", item_code="x")]))
    assert {(r.kind, r.n) for r in unmatched(wrong).where("product_name = 'never'").collect()} == {("codes", -1), ("row", -1)}


def test_prices_that_do_not_sum_exactly(spark):
    rows = [dict(product_name="p", item_code="a", e_price=float("nan")), dict(product_name="p", item_code="b", e_price=2.0), dict(product_name="q", item_code="c", e_price=1e300)]
    state = member_counts(_offers(spark, rows))
    got = {r.product_name: r.price for r in items_of(state).collect()}
    assert math.isnan(got["p"]) and got["q"] == 1e300
    after = {r.product_name: r.price for r in items_of(apply_changes(state, withdrawn=_offers(spark, rows[:1]))).collect()}
    assert after == {"p": 2.0, "q": 1e300}


def test_state_keeps_one_row_a_hot_product(spark):
    rows = random_offers(6, 600)
    state = member_counts(_offers(spark, rows))
    assert state.where("kind = 'row'").groupBy("product_name").count().where("count > 1").count() == 0


def test_parts_of_the_rollup_equal_the_whole(spark):
    offers = _offers(spark, random_offers(7))
    whole = to_items(offers)
    for sets, described, measured in ((("categories",), False, False), (("codes", "brands"), True, False), ((), True, True), (("retailers",), False, True)):
        part = to_items(offers, sets, described, measured)
        assert table(part) == table(whole.select(*part.columns))
    assert offers_overview(offers).first() == item_overview(whole).first()


def test_unneeded_text_is_not_read(spark):
    offers = _offers(spark, random_offers(8, 20))
    for df in (offers_overview(offers), to_items(offers, ("categories",), False, False)):
        assert "long_description" not in df._jdf.queryExecution().optimizedPlan().toString().split("LogicalRDD")[0]


def test_empty(spark):
    none = _offers(spark, random_offers(9, 5)).where(F.lit(False))
    assert items_of(member_counts(none)).count() == 0
    assert tuple(offers_overview(none).first()) == (0, 0, 0, 0)


def test_single_members_are_not_made_by_lambdas(spark):
    plan = member_counts(_offers(spark, random_offers(9, 20)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lambdafunction(") == 1


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(")


def test_members_are_exchanged_once(spark):
    """Offers' members (whole texts among them) go through one exchange, and a
    state that is dealt out by its members is not moved again."""
    a, b = _offers(spark, random_offers(10, 40)), _offers(spark, random_offers(11, 40))
    assert exchanges(member_counts(a)) == 1
    state = apply_changes(member_counts(a), added=b)
    assert exchanges(state) == 2 and exchanges(apply_changes(state, withdrawn=b)) == 3
    assert exchanges(apply_changes(state.checkpoint(), withdrawn=b)) == 2


def test_together_is_the_union(spark):
    rows = random_offers(12, 80) * 2
    offers = _offers(spark, rows)
    of = [F.coalesce(F.col("e_price") > 2, F.lit(False)), F.coalesce(F.col("retailer_code") == "r1", F.lit(False))]
    got = _together(offers, *of)
    assert got.columns == offers.columns and table(got) == table(offers.where(of[0]).unionByName(offers.where(of[1])))


@pytest.fixture()
def odd_tables(spark, scratch):
    """Offers with repeated and null keys, and one document of two parts."""
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{scratch}/{name}.parquet")

    parts = [(1, "p", "b", "t", 5), (1, "p", "b", "t", 5), (2, "p", None, "t", 6), (None, "q", "b", "t", 7), (3, None, "b", None, None)]
    put("lineitem", [(k, s, x) for k in (1, 2, 3, 4, None) for s in (10, 13, None, 99) for x in (2.5, 3.25, None)] * 2, "l_partkey long, l_suppkey long, l_extendedprice double")
    put("part", parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int")
    put("supplier", [(10, "s0"), (10, "s0"), (13, "s4"), (None, "s9"), (12, None)], "s_suppkey long, s_name string")
    put("documents", [(1, "text b"), (1, "text a"), (2, None), (5, "none")], "doc_id long, text string")
    return scratch


def test_offers_carry_no_text_through_the_supplier_join(spark, odd_tables):
    rows = catalog.offers(spark, odd_tables)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "l_partkey" in plan[plan.index("Join Inner"):].splitlines()[0]
    # part 1 twice with two texts, part 2 and 3 once; supplier 10 twice, 13 once; three prices, all rows twice
    assert rows.count() == (2 * 2 + 1 + 1) * 3 * 3 * 2


def test_rollup_queries_on_odd_rows(spark, odd_tables):
    whole = catalog._rollup_text(to_items(catalog.offers(spark, odd_tables)))
    assert table(catalog.q_item_rollup_merged(spark, odd_tables)) == table(whole)
    kept = catalog.offers(spark, odd_tables).where(~F.col("retailer_code").rlike("[0369]$"))
    names = ["product_name", "retailers", "price", "purchase_count"]
    want = to_items(kept).withColumn("retailers", catalog.sorted_join("retailers")).withColumn("price", F.round("price", catalog.ROUND))
    assert table(catalog.q_item_rollup_withdrawn(spark, odd_tables)) == table(want.select(*names))
