"""Attaching global aggregates to every row.

A global aggregate returns exactly one row, so it is attached as a scalar
subquery: Spark runs it once, then uses the value as a constant in the outer
plan.  No join and nothing collected by user code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalar_struct(df: DataFrame, **aggs: Column) -> Column:
    """One scalar subquery holding several aggregates; read with ``getField``."""
    return df.select(F.struct(*[a.alias(k) for k, a in aggs.items()])).scalar()
