"""Consecutive row numbers in a global order, without a single-partition window.

The rows are range-partitioned and sorted by Spark (a distributed sort).  Each
row gets a per-task sequence id; a per-partition table (one row per partition)
turns those into offsets, so ``row_no`` is consecutive across partitions.

Rows and ids are written once to the shared folder, and both the rows and the
per-partition table are read from there.  Two reads of the sort itself need not
agree: range bounds come from samples, column pruning makes two exchanges of one,
and adaptive execution may coalesce them differently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import run_folder


def number_rows(df: DataFrame, order_by: Sequence[str], row_col: str = "row_no",
                start: int = 0, count_col: str | None = None) -> DataFrame:
    """``df`` plus ``row_col``: start, start + 1, ... in ``order_by`` order.

    With ``count_col``, also the total number of rows (from the same
    per-partition table).  The rows are sorted and written when this is called;
    ties get their numbers in any order.
    """
    path = run_folder(df.sparkSession, "numbered-rows", allow_local_default=True)
    marked = df.orderBy(*order_by).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_seq"))
    marked.write.parquet(path)
    ordered = df.sparkSession.read.schema(marked.schema).parquet(path)
    parts = ordered.groupBy(F.col("_part").alias("_pid")).agg(
        F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a bounded table.  The key gets its own name so the
    # join with the table it was derived from stays an unambiguous equi-join.
    parts = parts.select("_pid", "_first",
                         F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
                         F.sum("_n").over(Window.partitionBy()).alias("_total"))
    numbered = ordered.join(parts, F.col("_part") == F.col("_pid"))
    extra = [F.col("_total").alias(count_col)] if count_col else []
    return numbered.select(
        *df.columns,
        (F.col("_before") + F.col("_seq") - F.col("_first") + F.lit(start)).alias(row_col),
        *extra)
