from __future__ import annotations

import datetime as dt

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.calendar import created_date


def as_of_col(as_of: str | dt.date | Column | None) -> Column:
    """The reference date: a literal date, a Column, or today when None."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


# One unit of an amount: a millionth (three decimals of quantity times three of price).
UNITS = 1_000_000


def purchase_date(lines: DataFrame) -> Column:
    """The date of an order line; a line without one stops the query.  Lines from the library's readers
    carry it typed (``order_date``); others have it read from ``created_at``."""
    return required_date(F.col("order_date") if "order_date" in lines.columns else created_date("created_at"))


def required_date(date: Column) -> Column:
    return F.coalesce(date, F.raise_error(F.lit("an order line has no date")).cast("date"))


def within(lines: DataFrame, keep) -> DataFrame:
    """Lines whose date meets ``keep``, as a filter that a scan of stored lines can use.  Lines without a
    date stay for ``purchase_date`` to stop at."""
    date = F.col("order_date") if "order_date" in lines.columns else created_date("created_at")
    return lines.where(date.isNull() | keep(date))


def quantity() -> Column:
    """Quantity in thousandths, as a long."""
    return (F.col("qty") * F.lit(1000).cast("decimal(4,0)")).cast("long")


def line_units() -> Column:
    """qty x price in millionths: exact, and summed with primitive longs.  A sum
    beyond 9.2e12 currency units raises (ANSI mode); totals over all lines use
    ``total_of``, which has no such bound."""
    return quantity() * (F.col("price") * F.lit(1000).cast("decimal(4,0)")).cast("long")


def total_of(units: Column) -> Column:
    """Sum over any number of rows: whole units and remainders are summed as two longs."""
    whole, rest = F.call_function("div", units, F.lit(UNITS)), units % F.lit(UNITS)
    return F.sum(whole).cast("decimal(25,0)") * F.lit(UNITS).cast("decimal(7,0)") + F.sum(rest).cast("decimal(25,0)")


def money(units: Column) -> Column:
    """Millionths to currency units as a double, once at the end of a view: the double nearest to the
    exact amount.  Below 2^53 that is one division; above, the exact decimal is converted."""
    exact = units.cast("decimal(31,0)") * F.lit(Decimal("0.000001"))
    return F.when(F.abs(units) < F.lit(1 << 53), units.cast("double") / F.lit(float(UNITS))).otherwise(exact.cast("double"))


def pieces(thousandths: Column) -> Column:
    """A sum of ``quantity`` as a double."""
    return thousandths.cast("double") / F.lit(1000.0)


def money_text(units: Column) -> Column:
    """Millionths as exact decimal text with at least two places (``-5.00``, ``1.005``)."""
    cents = (F.call_function("div", units, F.lit(10_000)).cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("string")
    exact = (units.cast("decimal(31,0)") * F.lit(Decimal("0.000001"))).cast("string")
    return F.when(units % 10_000 == 0, cents).otherwise(F.regexp_replace(exact, "0{1,4}$", ""))
