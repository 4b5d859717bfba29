"""Compound monthly growth rate (CMGR) and dense month series.

For an item with monthly revenues over the global month axis m_1..m_M:

* base month = first month whose revenue is positive (non-positive months count
  as zero in the series);
* n = number of axis months from the base month to m_M, inclusive;
* cmgr = ((total / base revenue) ** (1 / n) - 1) * 100, with ``total`` the sum of
  all the item's revenue (negative months included).

No positive month: n = 1 and cmgr is null.  A negative total with n > 1 has no
real root and gives null.

The month axis is the set of distinct months present in the data; it is bounded
by the calendar span (twelve per year), so it travels as one small array value
produced by a scalar subquery, and ``n`` comes from the base month's position
in that array, not from a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_axis(monthly: DataFrame, month: str = "month") -> Column:
    """Sorted array of every distinct month in ``monthly`` (scalar subquery)."""
    return monthly.select(F.array_sort(F.collect_set(month))).scalar()


def cmgr_expr(total: Column, base: Column, n: Column) -> Column:
    ratio = F.try_divide(total.cast("double"), base.cast("double"))
    rate = (F.pow(ratio, F.lit(1.0) / n) - F.lit(1.0)) * F.lit(100.0)
    # nanvl references ``rate`` once: no duplicated pow per row.
    return F.nanvl(rate, F.lit(None).cast("double"))


def cmgr(monthly: DataFrame, keys: Sequence[str], month: str = "month",
         revenue: str = "revenue", axis: Column | None = None) -> DataFrame:
    """keys..., total, cmgr, n_periods from one row per (keys, month)."""
    axis = month_axis(monthly, month) if axis is None else axis
    positive = F.col(revenue) > 0
    # min_by skips rows whose ordering is null, i.e. non-positive months; both
    # aggregates are hash-aggregatable (no sort-based aggregation).
    per_item = monthly.groupBy(*keys).agg(
        F.sum(revenue).alias("total"),
        F.min(F.when(positive, F.col(month))).alias("base_month"),
        F.min_by(F.when(positive, F.col(revenue)), F.when(positive, F.col(month))).alias("base"))
    # The base month is itself on the sorted axis, so the months from it to the
    # end are counted from its position.
    n = (F.size(axis) - F.array_position(axis, F.col("base_month")) + 1).cast("int")
    return per_item.select(
        *keys, "total",
        cmgr_expr(F.col("total"), F.col("base"), n).alias("cmgr"),
        F.when(F.col("base_month").isNull(), F.lit(1)).otherwise(n).alias("n_periods"),
    )


def _by_month(monthly: DataFrame, keys: Sequence[str], month: str, revenue: str) -> DataFrame:
    """keys..., by_month: each key's observed months (at most one entry per axis month) as a map."""
    entry = F.when(F.col(month).isNotNull(), F.struct(F.col(month), F.col(revenue)))
    return monthly.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("by_month"))


def _filled(at: Column, monthly: DataFrame, revenue: str) -> Column:
    value = F.try_element_at(F.col("by_month"), at)
    return F.when(value > 0, value).otherwise(F.lit(0).cast(monthly.schema[revenue].dataType))


def dense_months(monthly: DataFrame, keys: Sequence[str], month: str = "month",
                 revenue: str = "revenue", axis: Column | None = None) -> DataFrame:
    """Every key x every axis month; missing or non-positive revenue becomes 0.

    The axis array is exploded per key and looked up in the key's month map:
    output-sized work with no cartesian product and no join, and when
    ``monthly`` is already partitioned by ``keys`` there is no shuffle either.
    """
    axis = month_axis(monthly, month) if axis is None else axis
    grid = _by_month(monthly, keys, month, revenue).select(*keys, "by_month", F.explode(axis).alias(month))
    return grid.select(*keys, month, _filled(F.col(month), monthly, revenue).alias(revenue))


def month_series(monthly: DataFrame, keys: Sequence[str], month: str = "month",
                 revenue: str = "revenue", axis: Column | None = None) -> DataFrame:
    """keys..., series: the dense revenues as one array, a value per axis month in month order.
    The axis is mapped through the key's month map; nothing is exploded or sorted."""
    axis = month_axis(monthly, month) if axis is None else axis
    per_key = _by_month(monthly, keys, month, revenue).select("*", axis.alias("axis"))
    return per_key.select(
        *keys, F.transform("axis", lambda m: _filled(m, monthly, revenue)).alias("series"))
