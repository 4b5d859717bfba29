"""Customer-week views (weeks start on Thursday)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.calendar import (
    created_date, created_hour, two_hour_slot, week_start_thursday, weekday_number,
)
from tillroll.operators.indicators import INDICATOR_COLUMNS, weekday_slot_aggs
from tillroll.plans._common import line_units, money, pieces, quantity, required_date, total_of
from tillroll.sources.exports import customer_details

def _distinct_lines(lines: DataFrame) -> DataFrame:
    """Lines that agree on (order, email, created_at, qty, price) count once.

    Text keys are non-null by construction ('' for an empty field); saying so
    keeps Catalyst from adding a join-key null filter to one consumer only, so
    the visit rollups and the population averages share this shuffle.
    """
    keys = [F.coalesce(c, F.lit("")).alias(c) for c in ("order_id", "email", "created_at")]
    return lines.select(*keys, "qty", "price").distinct()


def _visits(lines: DataFrame) -> DataFrame:
    """One row per distinct (email, created_at) with the revenue of its lines."""
    return _distinct_lines(lines).groupBy("email", "created_at").agg(
        F.sum(line_units()).alias("units"))


def _weekly(lines: DataFrame) -> DataFrame:
    v = _visits(lines)
    d = required_date(created_date("created_at"))
    v = v.select("email", "units", week_start_thursday(d).alias("week"),
                 weekday_number(d).alias("weekday"),
                 two_hour_slot(created_hour("created_at")).alias("slot"))
    return v.groupBy("email", "week").agg(
        F.count(F.lit(1)).alias("n_visits"),
        F.sum("units").alias("units"),
        *weekday_slot_aggs("weekday", "slot"))


def weekly_visits(lines: DataFrame) -> DataFrame:
    """email, week, n_visits (distinct order timestamps in the week)."""
    return _weekly(lines).select("email", "week", "n_visits")


def weekly_basket(lines: DataFrame) -> DataFrame:
    """email, week, revenue, basket_value (revenue / visits)."""
    w = _weekly(lines)
    return w.select("email", "week", money(F.col("units")).alias("revenue"),
                    F.try_divide(money(F.col("units")), F.col("n_visits"))
                     .alias("basket_value"))


def _population(lines: DataFrame) -> DataFrame:
    return _distinct_lines(lines).agg(
        total_of(quantity()).alias("qty"), total_of(line_units()).alias("revenue"),
        F.count_distinct("email").alias("n_customers"))


def population_averages(lines: DataFrame) -> DataFrame:
    """One row: avg_quantity, avg_revenue per distinct customer email."""
    p = _population(lines)
    return p.select(
        F.try_divide(pieces(F.col("qty")), F.col("n_customers")).alias("avg_quantity"),
        F.try_divide(money(F.col("revenue")), F.col("n_customers")).alias("avg_revenue"))


def customer_week_profile(lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Per known customer and week: visits, revenue, basket value, 19 habit
    counts, customer details and the population averages."""
    w = _weekly(lines)
    details = customer_details(customers)
    averages = population_averages(lines).select(F.struct("avg_quantity", "avg_revenue")).scalar()
    out = details.join(w, "email")
    return out.select(
        "name", "location", "attr12", "email", "week", "n_visits",
        money(F.col("units")).alias("revenue"),
        F.try_divide(money(F.col("units")), F.col("n_visits")).alias("basket_value"),
        *INDICATOR_COLUMNS,
        averages.getField("avg_quantity").alias("avg_quantity"), averages.getField("avg_revenue").alias("avg_revenue"),
    )
