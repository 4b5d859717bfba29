"""Customer views: gaps, frequency histogram, recency, habits, value, profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.calendar import created_hour, two_hour_slot, weekday_number
from tillroll.operators import bitsets
from tillroll.operators.gaps import gap_summary, next_dates
from tillroll.operators.histogram import fixed_range_histogram
from tillroll.operators.indicators import INDICATOR_COLUMNS, weekday_slot_aggs
from tillroll.plans._common import (
    as_of_col, line_units, money, pieces, purchase_date, quantity, total_of,
)
from tillroll.sources.exports import customer_details

# The order-gap histogram ranges (label, low, high, low inclusive);
# high bounds are exclusive and the first range excludes 0.
ORDER_GAP_RANGES = [
    ("0 to 4", 0, 4, False),
    ("4 to 7", 4, 7, True),
    ("7 to 15", 7, 15, True),
    ("15 to 30", 15, 30, True),
    ("30 to 60", 30, 60, True),
    ("60 to 100", 60, 100, True),
    ("100+", 100, None, True),
]


def _purchase_dates(lines: DataFrame) -> DataFrame:
    return lines.select("email", purchase_date(lines).alias("order_date"))


def _date_summary(lines: DataFrame) -> DataFrame:
    return gap_summary(_purchase_dates(lines), "email", "order_date")


def order_gap(lines: DataFrame) -> DataFrame:
    """email, n_dates (distinct purchase dates), avg_gap (sum of gaps / n_dates)."""
    return _date_summary(lines).select("email", "n_dates", "avg_gap")


def order_gap_rows(lines: DataFrame) -> DataFrame:
    """email, order_date, next_date, days: every distinct purchase date with the days to the customer's next one."""
    return next_dates(_purchase_dates(lines), "email", "order_date")


def order_frequency_histogram(lines: DataFrame) -> DataFrame:
    """range_label, n_customers over customers with a non-zero average gap.

    All seven ranges are always present, in range order.
    """
    gaps = order_gap(lines).where(F.col("avg_gap") != 0)
    hist = fixed_range_histogram(gaps, "avg_gap", ORDER_GAP_RANGES, "range_label", "n_customers")
    return hist.select("range_label", "n_customers")


def recency(lines: DataFrame, as_of=None) -> DataFrame:
    """email, days_since_first_order, days_since_last_order (relative to as_of)."""
    ref = as_of_col(as_of)
    s = _date_summary(lines)
    return s.select("email",
                    F.datediff(ref, "first_date").alias("days_since_first_order"),
                    F.datediff(ref, "last_date").alias("days_since_last_order"))


def day_hour_profile(lines: DataFrame) -> DataFrame:
    """email, sunday..saturday, h00..h22.

    Counts distinct (order, weekday, two-hour slot) per customer, using the
    wall-clock date and hour of the created-at text.
    """
    stamped = lines.select(
        "order_id", "email",
        weekday_number(purchase_date(lines)).alias("weekday"),
        two_hour_slot(created_hour("created_at")).alias("slot"),
    ).distinct()
    return stamped.groupBy("email").agg(*weekday_slot_aggs("weekday", "slot"))


def _customer_value(lines: DataFrame) -> DataFrame:
    agg = lines.groupBy("email").agg(F.sum(line_units()).alias("units"),
                                     F.count_distinct("order_id").alias("n_orders"))
    return agg.select("email", money(F.col("units")).alias("revenue"), "n_orders")


def customer_value_segment(lines: DataFrame, customers: DataFrame,
                           segments: DataFrame) -> DataFrame:
    """email, revenue, basket_value, segment, name, location, attr12.

    Revenue sums every order line; basket value divides it by the customer's
    distinct orders.  Customers missing from the customer export are dropped;
    a missing segment is null.
    """
    value = _customer_value(lines)
    details = customer_details(customers)
    out = (value.join(details, "email")
                .join(segments.select("email", "segment"), "email", "left"))
    return out.select(
        "email", "revenue",
        F.try_divide(F.col("revenue"), F.col("n_orders")).alias("basket_value"),
        "segment", "name", "location", "attr12",
    )


def known_customers(lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct emails that have order lines and appear in the customer export."""
    ordered = lines.select("email").distinct()
    return ordered.join(customers.select("email"), "email", "left_semi")


def customer_score_attach(keys: DataFrame, scores: DataFrame) -> DataFrame:
    """Inner join of the score list onto customer keys: email, scores."""
    return keys.select("email").join(scores.select("email", "scores"), "email")


def _totals(lines: DataFrame, customers: DataFrame) -> DataFrame:
    """One row: revenue (millionths) and qty (thousandths) of every order line, and n_known, the
    customers that both ordered and appear in the customer export.  The lines are read once."""
    spent = lines.groupBy("email").agg(total_of(line_units()).alias("units"), total_of(quantity()).alias("qty"))
    known = customers.select("email", F.lit(True).alias("known")).distinct()
    return spent.join(known, "email", "left").agg(
        F.sum("units").cast("decimal(31,0)").alias("revenue"), F.sum("qty").cast("decimal(31,0)").alias("qty"),
        F.count_if("known").alias("n_known"))


def global_averages(lines: DataFrame, customers: DataFrame) -> DataFrame:
    """One row: avg_revenue, avg_quantity.

    Totals run over every order line; the divisor is the number of customers
    that both ordered and appear in the customer export.
    """
    return _totals(lines, customers).select(
        F.try_divide(money(F.col("revenue")), F.col("n_known")).alias("avg_revenue"),
        F.try_divide(pieces(F.col("qty")), F.col("n_known")).alias("avg_quantity"))


def customer_rollup(lines: DataFrame) -> DataFrame:
    """Everything the profile knows of a customer from the order lines, in one pass: email, units, qty,
    n_orders, n_dates, first_date, last_date and the 19 habit counts.

    A line counts for two distinct keys of its customer: its order, with the (weekday, slot) of its lines as a bit
    set, and 64 days of the calendar, with the dates as a bit set.  Each becomes a tagged row; rows of one key are
    merged (map-side first, so copies and hot customers shrink to their distinct keys) and then counted
    per customer.
    """
    date = purchase_date(lines)
    # a null email is an empty one, as in the exports; a key that cannot be null keeps both readers' plans alike
    rows = lines.select(F.coalesce("email", F.lit("")).alias("email"), "order_id", date.alias("order_date"), two_hour_slot(created_hour("created_at")).alias("slot"),
                        line_units().alias("units"), quantity().alias("qty"))
    rows = rows.select("*", bitsets.day_number(F.col("order_date")).alias("day"), weekday_number("order_date").alias("weekday"))
    tagged = rows.select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("of_order"))
    of_order = F.col("of_order")
    keyed = tagged.select(
        "email", F.when(of_order, F.col("order_id")).alias("order_id"), F.when(~of_order, bitsets.word_of(F.col("day"))).alias("word"),
        F.when(~of_order, bitsets.bit_of(F.col("day"))).alias("days"), F.when(~of_order, F.col("order_date")).alias("order_date"),
        *[F.when(of_order, c).alias(name) for name, c in zip(bitsets.HABIT_COLUMNS, bitsets.habit_words(F.col("weekday"), F.col("slot")))],
        *[F.when(of_order, F.col(c)).alias(c) for c in ("units", "qty")], "of_order")
    merged = keyed.groupBy("email", "of_order", "order_id", "word").agg(
        F.bit_or("days").alias("days"), F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"),
        *[F.bit_or(c).alias(c) for c in bitsets.HABIT_COLUMNS], F.sum("units").alias("units"), F.sum("qty").alias("qty"))
    return merged.groupBy("email").agg(
        F.sum("units").alias("units"), F.sum("qty").alias("qty"), F.count_if("of_order").alias("n_orders"),
        F.sum(F.bit_count("days")).alias("n_dates"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
        *bitsets.habit_counts())


def _population(rollup: DataFrame, details: DataFrame) -> DataFrame:
    """One row: the total of every figure of the rollup over all customers, and n_known, the customers that are also
    in the customer export.  It uses all of the rollup, so its plan below is the profile's own and runs once."""
    known = details.select("email", F.lit(True).alias("known")).distinct()
    figures = [F.sum(F.col(c).cast("decimal(31,0)")).alias(c) for c in ("units", "qty", "n_orders", "n_dates", *INDICATOR_COLUMNS)]
    return rollup.join(known, "email", "left").agg(
        *figures, F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"), F.count_if("known").alias("n_known"))


def customer_profile(lines: DataFrame, customers: DataFrame, segments: DataFrame,
                     scores: DataFrame, as_of=None) -> DataFrame:
    """Wide row per customer: identity, value, segment, recency, frequency,
    weekday/slot habits, population averages and the score list.

    The order lines are read once: the customers and the population totals share ``customer_rollup``.
    """
    ref = as_of_col(as_of)
    # the filter is always true: it makes both readers use every figure, so that they share one shuffle of the rollup
    rollup, details = customer_rollup(lines).where("n_orders > 0 or qty is not null"), customer_details(customers)
    total = _population(rollup, details).select(F.struct("*")).scalar()
    revenue = money(F.col("units"))
    gap = F.datediff("last_date", "first_date").cast("double")
    out = (rollup.join(details, "email")
           .join(segments.select("email", "segment"), "email", "left")
           .join(scores.select("email", "scores"), "email"))
    return out.select(
        "name", revenue.alias("revenue"), F.try_divide(revenue, F.col("n_orders")).alias("basket_value"),
        "segment", "location", "attr12", "n_dates", F.try_divide(gap, F.col("n_dates")).alias("avg_gap"), "email",
        F.datediff(ref, "first_date").alias("days_since_first_order"),
        F.datediff(ref, "last_date").alias("days_since_last_order"),
        *INDICATOR_COLUMNS,
        F.try_divide(money(total.getField("units")), total.getField("n_known")).alias("avg_revenue"),
        F.try_divide(pieces(total.getField("qty")), total.getField("n_known")).alias("avg_quantity"),
        "scores",
    )
