"""Customer retention counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.calendar import month_start
from tillroll.plans._common import as_of_col, purchase_date, within


def customer_retention(lines: DataFrame, as_of=None, *, repeat_days: int = 30,
                       recent_days: int = 20, year_days: int = 365, grain: str = "month") -> DataFrame:
    """One row: n_repeat_30, n_active_20, n_active_365, ratio_30, ratio_20.

    Activity is a customer's (email, month start) of any order line dated on or
    before ``as_of``; a window of N days admits month starts on or after
    ``as_of - N``.  Repeat customers have more than one month start inside the
    repeat window.  With ``grain="day"`` the order dates themselves take the
    place of month starts.  Ratios divide by the 365-day count (null when it is 0).
    """
    ref = as_of_col(as_of)
    if grain not in ("month", "day"):
        raise ValueError("grain must be month or day")
    # earlier dates can change no counter
    oldest = F.date_sub(ref, max(repeat_days, recent_days, year_days))
    dated = within(lines, lambda d: d.between(oldest, ref)).select("email", purchase_date(lines).alias("order_date"))
    unit = month_start("order_date") if grain == "month" else F.col("order_date")
    active = dated.select("email", unit.alias("month")).where(F.col("month") >= oldest).distinct()
    per_customer = active.groupBy("email").agg(
        F.count_if(F.col("month") >= F.date_sub(ref, repeat_days)).alias("months_repeat"),
        F.max(F.col("month") >= F.date_sub(ref, recent_days)).alias("recent"),
        F.max(F.col("month") >= F.date_sub(ref, year_days)).alias("in_year"),
    )
    counts = per_customer.agg(
        F.count_if(F.col("months_repeat") > 1).alias("n_repeat_30"),
        F.count_if("recent").alias("n_active_20"),
        F.count_if("in_year").alias("n_active_365"),
    )
    return counts.select(
        "n_repeat_30", "n_active_20", "n_active_365",
        F.try_divide(F.col("n_repeat_30").cast("double"), F.col("n_active_365")).alias("ratio_30"),
        F.try_divide(F.col("n_active_20").cast("double"), F.col("n_active_365")).alias("ratio_20"),
    )
