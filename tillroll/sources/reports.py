"""Line-numbered text files: wide reports and other header/footer framed files.

Wide reports put the time axis in a header line and drop a fixed number of
summary lines at the end, so a reader must know each line's position within its
file.  ``read_numbered_lines`` numbers lines without sending a file through one
task: every file block is read by its own task, each row gets a per-task
sequence id, and a small per-block table (one row per block) turns block-local
offsets into file line numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s) -> (file, line_no, line, n_lines).

    line_no is 0-based within each file; n_lines is the file's line count.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
        F.col("value").alias("line"),
    )
    # Ids are consecutive inside one task, and a block is read by one task, so
    # (id - first id of the block) is the row's offset inside its block.
    blocks = raw.groupBy("file", "block_start").agg(
        F.min("row_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file").orderBy("block_start").rowsBetween(
        Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block_start", "first_id",
                           F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("lines_before"),
                           F.sum("n").over(Window.partitionBy("file")).alias("n_lines"))
    numbered = raw.join(blocks, ["file", "block_start"])
    return numbered.select(
        "file",
        (F.col("lines_before") + F.col("row_id") - F.col("first_id")).alias("line_no"),
        "line", "n_lines",
    )


def with_line_counts(lines: DataFrame) -> DataFrame:
    """Add ``n_lines`` (lines in the row's file) unless already present.

    Tables from ``read_numbered_lines`` already carry it; otherwise a per-file
    count is joined back on ``file``.
    """
    if "n_lines" in lines.columns:
        return lines
    counts = lines.groupBy("file").agg((F.max("line_no") + 1).alias("n_lines"))
    return lines.join(counts, "file")


def body_lines(lines: DataFrame, header: int = 1, footer: int = 6) -> DataFrame:
    """Drop ``header`` leading and ``footer`` trailing lines of every file."""
    counted = with_line_counts(lines) if footer else lines
    keep = F.col("line_no") >= header
    if footer:
        keep = keep & (F.col("line_no") < F.col("n_lines") - footer)
    return counted.where(keep).select("file", "line_no", "line")


def line_at(lines: DataFrame, k: int) -> DataFrame:
    """Line ``k`` (0-based) of every file."""
    return lines.where(F.col("line_no") == k).select("file", "line_no", "line")
