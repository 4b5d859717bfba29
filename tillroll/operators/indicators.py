"""Indicator counts: one count per weekday and per two-hour slot.

All nineteen counts come from one grouped aggregation (partial + final), which
replaces one aggregation and one join per indicator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.functions.calendar import SLOT_HOURS, WEEKDAY_NAMES


def slot_name(hour: int) -> str:
    return f"h{hour:02d}"


WEEKDAY_COLUMNS = list(WEEKDAY_NAMES)
SLOT_COLUMNS = [slot_name(h) for h in SLOT_HOURS]
INDICATOR_COLUMNS = WEEKDAY_COLUMNS + SLOT_COLUMNS


def weekday_slot_aggs(weekday_num: str | Column, slot: str | Column) -> list[Column]:
    """Aggregates counting rows per weekday (1 = Sunday) and per slot start hour."""
    wd = F.col(weekday_num) if isinstance(weekday_num, str) else weekday_num
    sl = F.col(slot) if isinstance(slot, str) else slot
    aggs = [F.count_if(wd == i + 1).alias(name) for i, name in enumerate(WEEKDAY_COLUMNS)]
    aggs += [F.count_if(sl == h).alias(slot_name(h)) for h in SLOT_HOURS]
    return aggs
