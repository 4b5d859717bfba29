"""Sets of small integers packed into 64-bit words, merged by ``bit_or`` and counted by ``bit_count``.

A distinct count over a key of its own usually costs rows of its own (one per key and value).  Packed, 64
neighbouring values share one row, merge map-side like a sum, and several such sets travel as columns of the same row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.calendar import SLOT_HOURS, WEEKDAY_NAMES


def word_of(number: Column) -> Column:
    """The word of a whole number (64 numbers each, also below zero)."""
    return F.shiftright(number.cast("long"), 6)


def bit_of(number: Column) -> Column:
    """The number's bit inside its word."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), number.cast("long").bitwiseAND(63).cast("int"))


def day_number(date: Column) -> Column:
    return F.unix_date(date)


# Weekday and slot of an order line as one of 7 x 13 bits (the last slot: no hour), in two words.
_PER_DAY = len(SLOT_HOURS) + 1
_FIRST_DAYS = 4  # weekdays in the first word
HABIT_COLUMNS = ("habits_1", "habits_2")


def habit_words(weekday: Column, slot: Column) -> list[Column]:
    """The bit of (weekday 1 = Sunday, slot start hour) in the two words ``HABIT_COLUMNS``."""
    at = F.coalesce((slot / 2).cast("int"), F.lit(len(SLOT_HOURS)))
    first = weekday <= _FIRST_DAYS
    place = (weekday - 1 - F.when(first, 0).otherwise(_FIRST_DAYS)) * _PER_DAY + at
    return [F.when(mine, bit_of(place)).otherwise(F.lit(0).cast("long")).alias(name) for name, mine in zip(HABIT_COLUMNS, (first, ~first))]


def habit_counts() -> list[Column]:
    """Aggregates over rows with ``HABIT_COLUMNS``: how many distinct (row, weekday, slot) fall on each
    weekday and in each slot, named as the indicator counts are."""
    from tillroll.operators.indicators import slot_name

    def total(places: list[tuple[int, int]]) -> Column:
        """Set bits at (weekday, slot) places."""
        masks = [0, 0]
        for day, slot in places:
            word = int(day >= _FIRST_DAYS)
            masks[word] |= 1 << ((day - word * _FIRST_DAYS) * _PER_DAY + slot)
        bits = [F.bit_count(F.col(name).bitwiseAND(F.lit(mask).cast("long"))) for name, mask in zip(HABIT_COLUMNS, masks) if mask]
        return F.sum(sum(bits[1:], bits[0]))

    days, slots = range(len(WEEKDAY_NAMES)), range(len(SLOT_HOURS))
    return ([total([(d, s) for s in range(_PER_DAY)]).alias(name) for d, name in enumerate(WEEKDAY_NAMES)]
            + [total([(d, s) for d in days]).alias(slot_name(SLOT_HOURS[s])) for s in slots])


def packed(rows: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """(keys..., word, bits): the set of ``number`` of each key, one row per 64 numbers that it touches."""
    return (rows.select(*keys, word_of(F.col(number)).alias("word"), bit_of(F.col(number)).alias("bits"))
            .groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits")))


def intersection_sizes(sets: DataFrame, pairs: DataFrame, key: str, first: str, second: str, size: str) -> DataFrame:
    """(first, second, size) of the ``pairs`` (distinct rows) whose packed sets share a number.  ``sets``: (key, word,
    bits).  A pair's words meet on (key, word), so the work follows the words of the first set of each pair."""
    left = sets.select(F.col(key).alias(first), "word", F.col("bits").alias("left_bits"))
    right = sets.select(F.col(key).alias(second), "word", F.col("bits").alias("right_bits"))
    both = F.bit_count(F.col("left_bits").bitwiseAND(F.col("right_bits")))
    met = left.join(pairs.select(first, second), first).join(right, [second, "word"])
    return met.groupBy(first, second).agg(F.sum(both).alias(size)).where(F.col(size) > 0)
