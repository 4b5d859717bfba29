"""Fixed-range histograms that always emit every range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fixed_range_histogram(df: DataFrame, value: str,
                          ranges: Sequence[tuple[str, float | None, float | None, bool]],
                          label_col: str = "range_label", count_col: str = "n") -> DataFrame:
    """Count rows per range; ranges are (label, low, high, low_inclusive).

    ``high`` is exclusive; None means unbounded.  One global aggregation with a
    conditional count per range (partial + final), then the single row is
    unpivoted so that empty ranges still appear with 0.
    """
    v = F.col(value)
    aggs = []
    for i, (label, low, high, low_incl) in enumerate(ranges):
        cond = F.lit(True)
        if low is not None:
            cond = cond & ((v >= low) if low_incl else (v > low))
        if high is not None:
            cond = cond & (v < high)
        aggs.append(F.count_if(cond).alias(f"r{i}"))
    row = df.agg(*aggs)
    stacked = F.inline(F.array(*[
        F.struct(F.lit(i).alias("range_index"), F.lit(label).alias(label_col),
                 F.col(f"r{i}").alias(count_col))
        for i, (label, *_rest) in enumerate(ranges)]))
    return row.select(stacked)
