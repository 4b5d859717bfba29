"""Calendar expressions over the export's created-at text.

The exports carry times as text such as ``2015-01-01 23:59:59 -0500``.  Views
use the wall-clock date and hour as written and ignore the offset, exactly as a
substring/regex parse of that text does (converting through a zoned timestamp
would move late-evening orders to the next day).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names in the order the profiles emit them (Sunday first,
# matching Spark's dayofweek 1..7) and the start hour of each two-hour slot.
WEEKDAY_NAMES = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]
SLOT_HOURS = [0, 2, 4, 6, 8, 10, 12, 14, 16, 18, 20, 22]



def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def created_date(created_at) -> Column:
    """First ten characters of the created-at text as a date (``yyyy-MM-dd``).

    A plain cast (null when malformed) uses Spark's fast date parser instead of
    a pattern formatter.
    """
    return F.substring(_col(created_at), 1, 10).try_cast("date")


def created_hour(created_at) -> Column:
    """Hour of the clock time in the created-at text (offset ignored)."""
    tokens = F.split(_col(created_at), " ")
    clock = F.when(F.size(tokens) >= 3, F.try_element_at(tokens, F.lit(-2)))
    return F.split(clock, ":").getItem(0).try_cast("int")


def two_hour_slot(hour) -> Column:
    """Start hour of the two-hour slot: 0, 2, ..., 22."""
    h = _col(hour)
    return (F.floor(h / 2) * 2).cast("int")


def month_start(d) -> Column:
    return F.trunc(_col(d), "MM")


def year_month(d) -> Column:
    return F.date_format(_col(d), "yyyy-MM")


def week_start_thursday(d) -> Column:
    """The Thursday on or before ``d`` (weeks run Thursday to Wednesday)."""
    return F.date_sub(F.next_day(_col(d), "THU"), 7)


def weekday_number(d) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_col(d))


def weekday_name(d) -> Column:
    return F.date_format(_col(d), "EEEE")


def days_between(later, earlier) -> Column:
    return F.datediff(_col(later), _col(earlier))


def parse_month_header(text) -> Column:
    """Report month header such as ``Jan 2015`` to the first day of that month."""
    return F.try_to_date(F.trim(_col(text)), "MMM yyyy")


def parse_day_header(text) -> Column:
    """Report day header such as ``Thu 1st Jan 2015`` to a date.

    The second token loses its two-letter ordinal suffix, then day, month and
    year are parsed together.
    """
    tokens = F.split(F.trim(_col(text)), " ")
    day = tokens.getItem(1)
    day = F.substring(day, F.lit(1), F.length(day) - 2)
    return F.try_to_date(F.concat_ws(" ", day, tokens.getItem(2), tokens.getItem(3)),
                         "d MMM yyyy")
