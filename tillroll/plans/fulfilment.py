"""Share of unfulfilled orders per day and per month."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.calendar import year_month
from tillroll.plans._common import as_of_col, purchase_date, within

# Fixed value: the status text that marks an unfulfilled order.
UNFULFILLED = "unfulfilled"


def _status_rows(lines: DataFrame, keep) -> DataFrame:
    """Distinct (order, status, date) with a non-blank status and a date that meets ``keep``."""
    rows = within(lines.where(F.col("status") != ""), keep)
    return rows.select("order_id", "status", purchase_date(lines).alias("order_date")).distinct()


def _ratio():
    return F.try_divide(F.count_if(F.col("status") == UNFULFILLED).cast("double"),
                        F.count(F.lit(1))).alias("unfulfilled_ratio")


def unfulfilled_by_day(lines: DataFrame, as_of=None, days: int = 300) -> DataFrame:
    """order_date, unfulfilled_ratio for dates after ``as_of - days``."""
    ref = as_of_col(as_of)
    rows = _status_rows(lines, lambda d: d > F.date_sub(ref, days))
    return rows.groupBy("order_date").agg(_ratio())


def unfulfilled_by_month(lines: DataFrame, as_of=None,
                         start: str | dt.date = "2015-01-01") -> DataFrame:
    """month (yyyy-MM), unfulfilled_ratio for dates in [start, as_of]."""
    ref = as_of_col(as_of)
    rows = _status_rows(lines, lambda d: d.between(F.lit(str(start)).cast("date"), ref))
    return rows.groupBy(year_month("order_date").alias("month")).agg(_ratio())
