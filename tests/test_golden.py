"""Hand-computed mini-cases for the views' semantics."""

import datetime as dt

import pytest

from tests.conftest import line, order_lines, report_df, rows_of
from tillroll import plans
from tillroll.functions import calendar as cal

D = dt.date


def test_g1_pairs(spark):
    lines = order_lines(spark, [line("#1", "A"), line("#1", "B"), line("#1", "A"), line("#2", "A"),
                                line("#2", "B"), line("#2", "C"), line("#3", "C")])
    out = plans.bought_together(lines)
    assert [tuple(r) for r in out.collect()] == [("A", "B", 2), ("A", "C", 1), ("B", "C", 1)]


def test_g2_monthly_pairs(spark):
    lines = order_lines(spark, [
        line("#1", "A", "2015-01-03"), line("#1", "B", "2015-01-03"), line("#1", "A", "2015-01-03"),
        line("#2", "A", "2015-02-03"), line("#2", "B", "2015-02-03"), line("#2", "C", "2015-02-03"),
        line("#3", "C", "2015-02-04")])
    got = rows_of(plans.bought_together_monthly(lines))
    assert got == [(D(2015, 1, 1), "A", "B", 1), (D(2015, 2, 1), "A", "B", 1),
                   (D(2015, 2, 1), "A", "C", 1), (D(2015, 2, 1), "B", "C", 1)]


def _g3(spark):
    return order_lines(spark, [
        line("#1", email="x", created="2015-01-01"), line("#2", email="x", created="2015-01-11"),
        line("#3", email="x", created="2015-01-11"), line("#4", email="x", created="2015-01-31"),
        line("#5", email="y", created="2015-01-05"),
        line("#6", email="z", created="2015-01-01"), line("#7", email="z", created="2015-01-09")])


def test_g3_gaps(spark):
    assert rows_of(plans.order_gap(_g3(spark))) == [("x", 3, 10.0), ("y", 1, 0.0), ("z", 2, 4.0)]


def test_g4_histogram_keeps_empty_ranges(spark):
    got = [tuple(r) for r in plans.order_frequency_histogram(_g3(spark)).collect()]
    assert got == [("0 to 4", 0), ("4 to 7", 1), ("7 to 15", 1), ("15 to 30", 0),
                   ("30 to 60", 0), ("60 to 100", 0), ("100+", 0)]


def test_g5_recency(spark):
    got = rows_of(plans.recency(_g3(spark), "2015-02-10").where("email = 'x'"))
    assert got == [("x", 40, 10)]


def test_g6_thursday_week(spark):
    df = spark.createDataFrame([(D(2015, 1, 7),), (D(2015, 1, 8),), (D(2015, 1, 14),)], "d date")
    got = [r[0] for r in df.select(cal.week_start_thursday("d")).collect()]
    assert got == [D(2015, 1, 1), D(2015, 1, 8), D(2015, 1, 8)]


def test_g7_slot_and_wall_clock_date(spark):
    texts = ["2015-01-01 23:59:59 -0500", "2015-01-01 01:59:59 -0500", "2015-01-01 02:00:00 -0500"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(cal.two_hour_slot(cal.created_hour("t")).alias("s"),
                    cal.created_date("t").alias("d"),
                    cal.weekday_name(cal.created_date("t")).alias("w")).collect()
    assert [r.s for r in got] == [22, 0, 2]
    assert {r.d for r in got} == {D(2015, 1, 1)}
    assert got[0].w == "Thursday"


def test_g8_growth(spark):
    lines = order_lines(spark, [
        line("#1", "P", "2015-02-02", qty=1, price="100.00"),
        line("#2", "P", "2015-03-02", qty=1, price="44.00"),
        line("#3", "Q", "2015-01-02", qty=-1, price="5.00"),
        line("#4", "Q", "2015-03-02", qty=1, price="10.00"),
        line("#5", "R", "2015-02-05", qty=0, price="3.00"),
        line("#6", "S", "2015-01-09", qty=1, price="7.00"),
    ])
    got = {r.product: (None if r.cmgr is None else round(r.cmgr, 6), r.n_periods)
           for r in plans.product_cmgr(lines).collect()}
    assert got == {"P": (20.0, 2), "Q": (-50.0, 1), "R": (None, 1), "S": (0.0, 3)}


def _g9(spark):
    return order_lines(spark, [
        line("#1", status="unfulfilled", created="2015-01-01"),
        line("#1", status="", created="2015-01-01"),
        line("#2", status="fulfilled", created="2015-01-01"),
        line("#3", status="unfulfilled", created="2015-01-02")])


def test_g9_fulfilment(spark):
    by_day = rows_of(plans.unfulfilled_by_day(_g9(spark), "2015-06-30"))
    assert by_day == [(D(2015, 1, 1), 0.5), (D(2015, 1, 2), 1.0)]
    by_month = rows_of(plans.unfulfilled_by_month(_g9(spark), "2015-12-31", start="2015-01-01"))
    assert by_month == [("2015-01", pytest.approx(2 / 3))]


def test_g9_day_window_is_strict(spark):
    # as_of - 300 days is excluded, the day after is kept.
    out = rows_of(plans.unfulfilled_by_day(_g9(spark), "2015-10-28"))
    assert out == [(D(2015, 1, 2), 1.0)]


def test_g10_retention(spark):
    lines = order_lines(spark, [
        line("#1", email="a", created="2015-04-10"), line("#2", email="a", created="2015-05-01"),
        line("#3", email="b", created="2015-04-20"), line("#4", email="c", created="2014-06-15"),
        line("#5", email="d", created="2013-01-15"), line("#6", email="e", created="2015-06-15")])
    r = plans.customer_retention(lines, "2015-05-01").collect()[0]
    assert (r.n_repeat_30, r.n_active_20, r.n_active_365) == (1, 1, 3)
    assert r.ratio_30 == pytest.approx(1 / 3) and r.ratio_20 == pytest.approx(1 / 3)


def test_g11_equal_lines_merge(spark):
    lines = order_lines(spark, [line("#1", "P", "2015-01-08", qty=2, price="5.00"),
                                line("#2", "P", "2015-01-08", qty=1, price="10.00")])
    got = rows_of(plans.product_week_revenue(lines), "product", "week", "revenue", "pct_total")
    assert got == [("P", D(2015, 1, 8), 10.0, 100.0)]


def test_g12_value_segment(spark):
    lines = order_lines(spark, [line("#1", email="a", qty=2, price="5.00"),
                                line("#1", email="a", qty=2, price="5.00"),
                                line("#2", email="a", qty=1, price="10.00")])
    customers = spark.createDataFrame(
        [("Ann", "Lee", "a", "1 Road", "Town", "State", "x12")],
        "first_name string, last_name string, email string, address1 string, city string, "
        "province string, attr12 string")
    segments = spark.createDataFrame([("b", "gold")], "email string, segment string")
    r = plans.customer_value_segment(lines, customers, segments).collect()[0]
    assert (r.revenue, r.basket_value, r.segment) == (30.0, 15.0, None)
    assert (r.name, r.location, r.attr12) == ("Ann Lee", "1 Road Town State", "x12")
    # The customer-week view merges the two equal #1 lines (same timestamp).
    wk = plans.customer_week_profile(lines, customers).collect()[0]
    assert (wk.n_visits, wk.revenue) == (1, 20.0)


FOOTER = ["", "f1", "f2", "f3", "f4", "f5"]


def test_g13_type_report(spark):
    rev = report_df(spark, ["type,Jan 2015,Feb 2015,a,b,c,d,e", "A,1,2,3,4,5,6,7"] + FOOTER)
    gp = report_df(spark, ["type,Jan 2015,Feb 2015,a,b,c,d,e", "A,0.5,1,3,4,5,6,7"] + FOOTER)
    got = rows_of(plans.revenue_by_type_long(rev, gp))
    assert got == [(D(2015, 1, 1), 1.0, 0.5, "A"), (D(2015, 2, 1), 2.0, 1.0, "A")]


def test_g14_daily_report(spark):
    rep = report_df(spark, ["Day,Thu 1st Jan 2015,Fri 2nd Jan 2015,a,b,c,d,e", "x,1,1", "y,1,1",
                            "Revenue,10,20", "Cost,4,8", "Profit,6,12", "Margin,60,60", ""])
    got = rows_of(plans.daily_sales_summary(rep))
    assert got == [(D(2015, 1, 1), 10.0, 4.0, 6.0, 60.0), (D(2015, 1, 2), 20.0, 8.0, 12.0, 60.0)]


def test_g15_variant_report(spark):
    rep = report_df(spark, [
        "h0,h1,h2,h3,h4,h5,h6,Jan,Feb,Mar,i,r,c,g,m,n",
        '"r1, red",b,c,sku1,e,brand1,g,0,100,44,9,144,0,50,0,x',
        "r2,b,c,sku2,e,brand2,g,10,0,0,9,10,0,30,0,x"] + FOOTER)
    got = {r.label_0: r for r in plans.product_growth_report(rep).collect()}
    r1, r2 = got["r1, red"], got["r2"]
    assert (r1.label_3, r1.label_5) == ("sku1", "brand1")
    assert round(r1.cmgr, 6) == 20.0 and r1.n_periods == 2
    assert round(r1.pct_revenue, 6) == 93.506494 and round(r1.pct_dev_from_avg, 6) == 87.012987
    assert r1.pct_gross_profit == 62.5
    assert round(r2.cmgr, 6) == 0.0 and r2.n_periods == 3
    assert round(r2.pct_revenue, 6) == 6.493506 and round(r2.pct_dev_from_avg, 6) == -87.012987
    assert r2.pct_gross_profit == 37.5
    assert (r1.avg_revenue, r1.avg_gross_profit) == (77.0, 40.0)


def test_g16_csv_export(spark):
    from tillroll.sources.exports import parse_order_export
    tail = "," * 18
    text = spark.createDataFrame([
        ("Name,Email,Notes" + tail,),
        ('#1,a@x,"say ""hi"", ok",x,unfulfilled' + "," * 11 + "2015-01-01 10:00:00 -0500,2,P,1.50,,S",),
        ("#2,,",),
        ("zzz,1,2",)], "value string")
    got = parse_order_export(text).collect()
    assert [r.order_id for r in got] == ["#1", "#2"]
    assert (got[0].status, got[0].qty, float(got[0].price), got[0].sku) == ("unfulfilled", 2, 1.5, "S")
    assert (got[1].email, got[1].status, got[1].product) == ("", "", "")


def test_profile_columns_and_averages(spark):
    lines = order_lines(spark, [line("#1", email="a", qty=2, price="5.00", created="2015-01-01"),
                                line("#2", email="a", qty=1, price="10.00", created="2015-01-03"),
                                line("#3", email="b", qty=4, price="1.00", created="2015-01-04")])
    customers = spark.createDataFrame(
        [("A", "A", "a", "r", "t", "s", "1"), ("B", "B", "b", "r", "t", "s", "2")],
        "first_name string, last_name string, email string, address1 string, city string, "
        "province string, attr12 string")
    scores = spark.createDataFrame([("a", ["1", "2"])], "email string, scores array<string>")
    seg = spark.createDataFrame([("a", "gold")], "email string, segment string")
    out = plans.customer_profile(lines, customers, seg, scores, "2015-01-10")
    r = out.collect()
    assert len(r) == 1 and len(out.columns) == 33
    r = r[0]
    assert (r.email, r.revenue, r.basket_value, r.segment, r.n_dates, r.avg_gap) == (
        "a", 20.0, 10.0, "gold", 2, 1.0)
    assert (r.days_since_first_order, r.days_since_last_order) == (9, 7)
    assert r.thursday == 1 and r.saturday == 1 and r.h00 == 2
    # totals over all lines, divided by the two known customers
    assert (r.avg_revenue, r.avg_quantity) == (12.0, 3.5)
    assert r.scores == ["1", "2"]


def test_histogram_range_bounds(spark):
    from tillroll.operators.histogram import fixed_range_histogram
    from tillroll.plans.customers import ORDER_GAP_RANGES
    values = [0.0, 0.5, 3.999, 4.0, 6.99, 7.0, 14.9, 15.0, 29.0, 30.0, 59.9, 60.0, 99.99, 100.0, 1000.0]
    df = spark.createDataFrame([(v,) for v in values], "g double")
    got = [tuple(r) for r in fixed_range_histogram(df, "g", ORDER_GAP_RANGES, "range_label", "n")
           .select("range_label", "n").collect()]
    # 0.0 is in no range (the first range excludes its lower bound)
    assert got == [("0 to 4", 2), ("4 to 7", 2), ("7 to 15", 2), ("15 to 30", 2),
                   ("30 to 60", 2), ("60 to 100", 2), ("100+", 2)]


def test_fractions_are_exact_in_sums_and_text(spark):
    lines = order_lines(spark, [line("#1", "P", "2015-01-05", qty="1.5", price="1.005"),
                                line("#2", "P", "2015-02-05", qty="2.0", price="12345678901.00"),
                                line("#3", "P", "2015-03-05", qty="2", price="2.50")])
    assert plans.product_series(lines).first().series == "1.5075,24691357802.00,5.00"
    month = {r.month.month: r.revenue for r in plans.product_month_revenue(lines).collect()}
    assert month == {1: 1.5075, 2: 24691357802.0, 3: 5.0}
    assert plans.population_averages(lines).first().avg_quantity == 5.5


def test_large_amounts_round_once(spark):
    from decimal import Decimal
    from pyspark.sql import functions as F
    from tillroll.plans._common import money, total_of
    units = [2**53 + 1, 9_007_199_254_740_993_777, -(2**60 + 7), 5]
    df = spark.createDataFrame([(u,) for u in units], "u long")
    assert [r[0] for r in df.select(money(F.col("u"))).collect()] == [float(Decimal(u) / 10**6) for u in units]
    many = df.crossJoin(spark.range(10)).agg(total_of(F.col("u"))).first()[0]
    assert int(many) == 10 * sum(units)  # beyond a long


def test_a_line_without_a_date_stops_every_dated_view(spark):
    with pytest.raises(Exception, match="holds no date"):
        order_lines(spark, [line("#1", created="01/02/2015 9h")]).collect()
    blank = order_lines(spark, [line("#1", created=""), line("#2")])
    assert blank.count() == 2
    views = [plans.bought_together_monthly, plans.customer_retention, plans.order_gap, plans.recency, plans.day_hour_profile,
             plans.weekly_visits, plans.product_month_revenue, plans.product_week_revenue, plans.product_series,
             plans.unfulfilled_by_day, plans.unfulfilled_by_month]
    for view in views:
        with pytest.raises(Exception, match="has no date"):
            view(blank).collect()


def test_daily_dedupe_and_retention_grain_are_options(spark):
    twice = order_lines(spark, [line("#1", qty=1, price="5.00"), line("#2", qty=1, price="5.00")])
    assert plans.product_month_revenue(twice).first().revenue == 5.0
    assert plans.product_month_revenue(twice, dedupe=False).first().revenue == 10.0
    days = order_lines(spark, [line("#1", email="a", created="2015-04-20"), line("#2", email="a", created="2015-04-25")])
    assert plans.customer_retention(days, "2015-05-01").first().n_repeat_30 == 0
    assert plans.customer_retention(days, "2015-05-01", grain="day").first().n_repeat_30 == 1
