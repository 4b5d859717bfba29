"""Purchase-date gaps per customer.

The sum of gaps between consecutive distinct purchase dates telescopes to
``last - first``, so the average gap (divided by the number of dates, as the
views define it) needs only min, max and a distinct count: one grouped
aggregation, no sort of a customer's history and no window over a possibly
huge customer partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators import bitsets


def gap_summary(dated: DataFrame, key: str, date_col: str) -> DataFrame:
    """key, n_dates, first_date, last_date, avg_gap (days / n_dates)."""
    agg = dated.groupBy(key).agg(
        F.count_distinct(date_col).alias("n_dates"),
        F.min(date_col).alias("first_date"),
        F.max(date_col).alias("last_date"),
    )
    return agg.withColumn(
        "avg_gap",
        F.try_divide(F.datediff("last_date", "first_date").cast("double"), F.col("n_dates")))


def next_dates(dated: DataFrame, key: str, date_col: str, next_col: str = "next_date", days_col: str = "days") -> DataFrame:
    """(key, date_col, next_col, days_col): one row per distinct date of a key, with the key's next date and the
    days to it (null and 0 for the last one).  Rows without a date are in no history.

    A key's dates are a bit set of 64 days a word, merged map-side, so a key that holds a third of all rows
    crosses the shuffle as its words; its history is the array of those words, bounded by the calendar (six
    a year), and next dates are neighbours in it: no sort of a customer's rows and no window.
    """
    days = dated.where(F.col(date_col).isNotNull()).select(key, bitsets.day_number(F.col(date_col)).alias("day"))
    words = bitsets.packed(days, [key], "day").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words"))
    listed = words.select(key, F.expr(
        "flatten(transform(words, w -> transform(filter(sequence(0, 63), b -> bit_get(w.bits, b) = 1), b -> cast(w.word * 64 + b as int))))").alias("days"))
    rows = listed.select(key, F.explode(F.expr("arrays_zip(days, slice(days, 2, size(days)))")).alias("at")).select(key, "at.*").toDF(key, "day", "next")
    return rows.select(key, F.expr("date_from_unix_date(day)").alias(date_col), F.expr("date_from_unix_date(next)").alias(next_col),
                       F.coalesce(F.col("next") - F.col("day"), F.lit(0)).alias(days_col))
