"""Places of rows in a total order, without a task that sees a whole group.

Rows are sorted over range partitions and written with a sequence number that rises in that order (partition,
then place inside it).  One row per (group, partition) then says where the partition's share of the
group starts; a row's place is its distance from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import written


def numbered(rows: DataFrame, groups: list[str], order: list[Column | str], purpose: str) -> DataFrame:
    """``rows`` with ``idx`` (long, from 0: the place in its group) and ``n`` (long: the rows of its
    group).  ``groups``: columns without nulls; ``order``: what decides inside a group.  Rows equal in all of it
    get places in any order, and a range of them may be cut anywhere, so copies do not meet in one task.
    ``rows`` is read twice (bounds are sampled first): pass a written table."""
    by = [*groups, *order]
    spread = rows.withColumn("seq_", F.monotonically_increasing_id())
    table = written(spread.repartitionByRange(*by, "seq_").sortWithinPartitions(*by, "seq_")
                    .withColumn("seq_", F.monotonically_increasing_id()), purpose)
    part = F.shiftright("seq_", 33).alias("part_")
    sizes = table.groupBy(*groups, part).agg(F.min("seq_").alias("first_"), F.count(F.lit(1)).alias("rows_"))
    # one row per (group, partition that holds some of it)
    of_group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    before = F.sum("rows_").over(of_group.orderBy("part_").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("rows_")
    starts = sizes.select(*groups, "part_", "first_", before.alias("before_"), F.sum("rows_").over(of_group).alias("n"))
    return (table.withColumn("part_", part).join(starts, [*groups, "part_"])
            .withColumn("idx", F.col("seq_") - F.col("first_") + F.col("before_")).drop("seq_", "part_", "first_", "before_"))
