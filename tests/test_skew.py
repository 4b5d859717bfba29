"""Hot keys: a basket holding a third of all rows, a line copied many times."""

import itertools

from tests.conftest import line, order_lines
from tillroll import plans
from tillroll.operators.cooccurrence import basket_arrays, blocked, distinct_items, heavy_baskets, pair_counts

def _executed_plan(df) -> str:
    df._jdf.queryExecution().toRdd().count()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_basket_is_cut_into_blocks(spark):
    # one basket holds a third of all rows; session defaults, no lowered thresholds
    hot = [line("#hot", f"P{i:04d}") for i in range(1000)]
    small = [line(f"#{o}", f"P{(o * 7) % 1000:04d}") for o in range(1000)]
    small += [line(f"#{o}", f"P{(o * 11 + 1) % 1000:04d}") for o in range(1000)]
    lines = order_lines(spark, hot + small)
    df = pair_counts(lines, ["order_id"], "product", block=100)
    dedup = distinct_items(lines, ["order_id"], "product")
    heavy = heavy_baskets(dedup, ["order_id"], 100)
    assert [tuple(r) for r in heavy.collect()] == [("#hot", 10)]
    for side in blocked(dedup, heavy, ["order_id"], "product", "a", "b"):  # each item once per part of its basket, in groups of its own
        held = side.groupBy("order_id", "left_part", "right_part").count()
        assert held.count() == 100 and side.count() == 10_000
        assert held.agg({"count": "max"}).first()[0] < 200
    assert basket_arrays(dedup, heavy, ["order_id"], "product").selectExpr("max(size(items))").first()[0] <= 100

    baskets = {}
    for r in hot + small:
        baskets.setdefault(r[0], set()).add(r[5])
    expect = {}
    for items in baskets.values():
        for a, b in itertools.combinations(sorted(items), 2):
            expect[(a, b)] = expect.get((a, b), 0) + 1
    got = {(r.product_1, r.product_2): r.n_orders for r in df.collect()}
    assert got == expect


def test_items_of_heavy_and_light_baskets_and_null_keys(spark):
    rows = [(b, f"P{i:02d}", m) for b, n in (("a", 7), ("b", 3), ("c", 1), (None, 5)) for i in range(n) for m in (1, 2)]
    rows += [("b", None, 1), ("a", "P00", 1), ("d", "", 1), ("d", "P01", 1)]
    df = spark.createDataFrame(rows, "order_id string, product string, month int")
    expect = {}
    for b, m in itertools.product("abcd", (1, 2)):
        items = sorted({p for o, p, k in rows if (o, k) == (b, m) and p is not None})
        for x, y in itertools.combinations(items, 2):
            expect[m, x, y] = expect.get((m, x, y), 0) + 1
    for block in (1, 2, 3, 256):
        got = pair_counts(df, ["order_id", "month"], "product", group_keys=["month"], block=block).collect()
        assert {tuple(r)[:3]: r.n_orders for r in got} == expect and len(got) == len(expect), block
    assert pair_counts(df.limit(0), ["order_id"], "product").count() == 0


def test_copied_lines_collapse_before_the_shuffle(spark):
    copies = [line("#1", "A")] * 3000 + [line("#1", "B"), line("#2", "A"), line("#2", "B")]
    df = plans.bought_together(order_lines(spark, copies), sort=False)
    plan = _executed_plan(df)
    # map-side dedupe: a partial HashAggregate runs below the first exchange
    first_exchange = plan.index("Exchange hashpartitioning(order_id")
    assert "HashAggregate(keys=[order_id" in plan[first_exchange:]
    assert [tuple(r) for r in df.collect()] == [("A", "B", 2)]
