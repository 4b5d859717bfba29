"""Product revenue views: daily, weekly and monthly rollups and growth.

Grain: order lines that agree on (product, sku, date, qty x price) count once
(product and sku upper-cased).  That dedupe and the daily rollup are one
aggregation (``sum`` of distinct line revenues per product-day), after which a
product has at most one row per calendar day, whatever its share of the lines
(``dedupe=False`` sums every line instead).  The daily table is hash-partitioned by (product, sku) once; the weekly, monthly
and growth aggregations and their join all reuse that partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.calendar import month_start, week_start_thursday
from tillroll.functions.text import upper_label
from tillroll.operators.growth import cmgr, dense_months, month_series
from tillroll.operators.scalars import scalar_struct
from tillroll.plans._common import line_units, money, money_text, purchase_date, total_of

KEYS = ["product", "sku"]


def product_daily(lines: DataFrame, dedupe: bool = True, partition: bool = True) -> DataFrame:
    """product, sku, order_date, revenue (millionths); hash-partitioned by
    (product, sku) with ``partition``, for views that use it more than once."""
    # Keys are non-null by construction (an empty export field is ''), which
    # also keeps Catalyst from adding join-key null filters to one branch only:
    # every consumer of this table then shares one scan and one set of shuffles.
    rows = lines.select(upper_label(F.coalesce("product", F.lit(""))).alias("product"),
                        upper_label(F.coalesce("sku", F.lit(""))).alias("sku"),
                        purchase_date(lines).alias("order_date"),
                        line_units().alias("revenue"))
    total = F.sum_distinct("revenue") if dedupe else F.sum("revenue")
    daily = rows.groupBy(*KEYS, "order_date").agg(total.alias("revenue"))
    return daily.repartition(*KEYS) if partition else daily


def daily_month_axis(daily: DataFrame):
    """Sorted distinct months of all order lines, as one array value.

    Read from the daily table that the view needs anyway; each task keeps a set
    of at most two entries per calendar month.  The entries say whether a
    revenue is known, although only their months are used: so the subquery
    needs the same columns as the view, and both share one scan and its shuffles.
    """
    seen = F.collect_set(F.struct(month_start("order_date").alias("month"), F.col("revenue").isNull().alias("unknown")))
    months = F.array_distinct(F.transform("seen", lambda x: x["month"]))
    return daily.agg(seen.alias("seen")).select(F.array_sort(months)).scalar()


def _monthly(daily: DataFrame) -> DataFrame:
    return daily.groupBy(*KEYS, month_start("order_date").alias("month")).agg(
        F.sum("revenue").alias("revenue"))


def _weekly(daily: DataFrame) -> DataFrame:
    return daily.groupBy(*KEYS, week_start_thursday("order_date").alias("week")).agg(
        F.sum("revenue").alias("revenue"))


def product_month_revenue(lines: DataFrame, dedupe: bool = True) -> DataFrame:
    """product, sku, month, revenue."""
    m = _monthly(product_daily(lines, dedupe, partition=False))
    return m.select(*KEYS, "month", money(F.col("revenue")).alias("revenue"))


def product_month_dense(lines: DataFrame, dedupe: bool = True) -> DataFrame:
    """Every product x every month seen anywhere; missing or non-positive -> 0."""
    daily = product_daily(lines, dedupe)
    d = dense_months(_monthly(daily), KEYS, axis=daily_month_axis(daily))
    return d.select(*KEYS, "month", money(F.col("revenue")).alias("revenue"))


def product_cmgr(lines: DataFrame, dedupe: bool = True) -> DataFrame:
    """product, sku, cmgr, n_periods (see ``tillroll.operators.growth``)."""
    daily = product_daily(lines, dedupe)
    g = cmgr(_monthly(daily), KEYS, axis=daily_month_axis(daily))
    return g.select(*KEYS, "cmgr", "n_periods")


def product_series(lines: DataFrame, dedupe: bool = True) -> DataFrame:
    """product, sku, series: comma-joined dense monthly revenues in month order."""
    daily = product_daily(lines, dedupe)
    s = month_series(_monthly(daily), KEYS, axis=daily_month_axis(daily))
    return s.select(*KEYS, F.array_join(F.transform("series", money_text), ",").alias("series"))


def product_week_revenue(lines: DataFrame, dedupe: bool = True) -> DataFrame:
    """product, sku, week, revenue, cmgr, n_periods, pct_total, avg_revenue.

    pct_total is the week's share of all weekly revenue (percent); avg_revenue
    is total revenue over the number of product-week rows.
    """
    daily = product_daily(lines, dedupe)
    monthly = _monthly(daily)
    growth = cmgr(monthly, KEYS, axis=daily_month_axis(daily))
    weekly = _weekly(daily)
    totals = scalar_struct(weekly, total=money(total_of(F.col("revenue"))), rows=F.count(F.lit(1)))
    total = totals.getField("total")
    # Both sides are already partitioned by (product, sku).
    out = weekly.join(growth.select(*KEYS, "cmgr", "n_periods"), KEYS, "left")
    return out.select(
        *KEYS, "week", money(F.col("revenue")).alias("revenue"), "cmgr", "n_periods",
        F.try_divide(money(F.col("revenue")) * 100, total).alias("pct_total"),
        F.try_divide(total, totals.getField("rows")).alias("avg_revenue"),
    )
