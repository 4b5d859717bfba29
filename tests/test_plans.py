"""Physical-plan properties: no cartesian products, no Python UDFs, pruned scans."""

import pytest

from tillroll import catalog

SMOKE = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cartesian_or_python(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SMOKE))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


@pytest.mark.parametrize("name", ["bought_together", "bought_together_monthly"])
def test_light_baskets_are_paired_without_a_self_join(spark, name):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        df = catalog.QUERIES[name](spark, SMOKE)
        assert _scans(df) == 1
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set(key, before)
    # distinct rows, basket sizes, rows by basket, pairs, sort; the joins that shape the lines come below
    assert plan.count(" Exchange ") - plan.count("p_partkey") - plan.count("l_partkey") <= 5
    assert plan.count("LeftAnti") == 1 and "Union" not in plan


def test_scans_are_pruned(spark):
    df = catalog.QUERIES["unfulfilled_by_month"](spark, SMOKE)
    plan = _plan(df)
    # lineitem is read for its join keys only; no price, discount, comment columns.
    li = [s for s in plan.split("FileScan") if "lineitem" in s][0]
    schema = li[li.index("ReadSchema"):].split("\n")[0]
    assert "l_extendedprice" not in schema and "l_discount" not in schema


def _summary(spark, df):
    from checks.plan_summary import summarise
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return summarise(qe.explainString(mode))


def test_report_lines_meet_before_their_cells(spark):
    plan = _plan(catalog.QUERIES["revenue_by_type_long"](spark, SMOKE)).split("Generate inline")
    # the cells are spread above the join of the two reports, never below an exchange
    assert len(plan) == 2 and "Join" in plan[1] and "Exchange" not in plan[0]


def _without_broadcasts(spark, make):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        df = make()
        df._jdf.queryExecution().toRdd().count()
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set(key, before)


def test_stored_buckets_need_no_shuffle(spark, tmp_dir):
    from tillroll import plans
    from tillroll.operators.cooccurrence import basket_arrays, distinct_items, heavy_baskets
    from tillroll.sources import sinks
    lines = catalog.TestDataInputs(spark, SMOKE).lines()
    by_email = sinks.store_bucketed_lines(lines, "email", tmp_dir + "/e", 4)
    assert "Exchange" not in _without_broadcasts(spark, lambda: plans.order_gap(by_email))
    assert "Exchange" not in _without_broadcasts(spark, lambda: plans.order_gap(by_email).join(plans.recency(by_email, "2001-08-01"), "email"))
    assert sorted(map(str, plans.order_gap(by_email).collect())) == sorted(map(str, plans.order_gap(lines).collect()))
    by_order = sinks.store_bucketed_lines(lines, "order_id", tmp_dir + "/o", 4)

    def arrays():
        dedup = distinct_items(by_order, ["order_id"], "product")
        return basket_arrays(dedup, heavy_baskets(dedup, ["order_id"], 256), ["order_id"], "product")
    assert "Exchange" not in _without_broadcasts(spark, arrays)


def test_a_hot_key_is_not_stored_in_buckets(spark, tmp_dir):
    from tillroll.sources import sinks
    lines = spark.range(9000).selectExpr("if(id % 3 = 0, 'hot', concat('c', id)) AS email", "id")
    stored = sinks.store_bucketed_lines(lines, "email", tmp_dir + "/h", 16)
    assert stored.count() == 9000 and "spread" in stored.inputFiles()[0]
    even = sinks.store_bucketed_lines(lines.where("email != 'hot'"), "email", tmp_dir + "/v", 16)
    assert even.count() == 6000 and "buckets" in even.inputFiles()[0]


def test_product_rollups_share_one_partitioning(spark):
    s = _summary(spark, catalog.QUERIES["product_week_revenue"](spark, SMOKE))
    shuffles, reused, bhj, smj, shj = s["main"]
    # line dedupe, daily rollup, (product, sku) repartition; the growth branch
    # reads the same exchange and is hash-joined without sorting
    assert shuffles == 3
    assert reused >= 1
    assert smj == 0


def test_weekly_views_share_the_distinct_lines(spark):
    s = _summary(spark, catalog.QUERIES["customer_week_profile"](spark, SMOKE))
    assert s["main"][1] + s["sub"][1] >= 1


def _scans(df, table="lineitem") -> int:
    """Scans of a table that really ran: those outside the initial plans and reused subqueries."""
    df._jdf.queryExecution().toRdd().count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    found, skip = 0, None
    for text in plan.split("\n"):
        depth = len(text) - len(text.lstrip(" :+-"))
        if skip is not None and depth >= skip:
            continue
        skip = depth if "== Initial Plan ==" in text else None
        found += "FileScan" in text and f"{table}.parquet" in text
    return found


@pytest.mark.parametrize("name", ["product_month_revenue", "product_month_dense", "product_cmgr", "product_series",
                                  "product_week_revenue", "global_averages", "customer_value_segment", "customer_week_profile", "customer_profile"])
def test_the_lines_are_scanned_once(spark, name):
    assert _scans(catalog.QUERIES[name](spark, SMOKE)) == 1


@pytest.mark.parametrize("name", ["unfulfilled_by_day", "unfulfilled_by_month", "customer_retention"])
def test_date_bounds_reach_the_scan_of_stored_lines(spark, tmp_dir, name):
    from tillroll.sources import sinks
    inp = catalog.TestDataInputs(spark, SMOKE)
    sinks.store_order_lines(inp.lines(), tmp_dir + "/lines", 4)
    stored = spark.read.parquet(tmp_dir + "/lines")
    inp.lines = lambda: stored
    plan = _plan(catalog.VIEWS[name](inp))
    pushed = plan[plan.index("PushedFilters: "):].split("ReadSchema")[0]
    assert "GreaterThan" in pushed and "order_date" in pushed, pushed


def test_export_text_is_written_once_a_line(spark):
    """The filter on the text stays above it: moved into the join it would write every line a second time."""
    df = catalog.QUERIES["csv_order_lines"](spark, SMOKE)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert sum("concat_ws(" in line for line in plan.split("\n")) == 1
    assert not any("concat_ws(" in line for line in plan.split("\n") if "Join" in line)
