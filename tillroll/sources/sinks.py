"""Writing views out."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def store_order_lines(lines: DataFrame, path: str, n_files: int) -> None:
    """Order lines as parquet in ``n_files`` ranges of ``order_date``: a filter on the date skips whole
    files and row groups.  Lines of one date may spread over files by their order."""
    lines.repartitionByRange(n_files, "order_date", "order_id").sortWithinPartitions("order_date").write.parquet(path)


def store_bucketed_lines(lines: DataFrame, by: str, path: str, n_buckets: int, max_share: float = 4.0) -> DataFrame:
    """Parsed order lines stored once as a table of ``n_buckets`` hash buckets of ``by`` (``order_id`` or ``email``), sorted
    by it; returns the table.  Views that group or join by that column read it without a shuffle, so several
    views share one parse and one exchange.

    A bucket is read by one task.  If one holds more than ``max_share`` times the average (a hot key), the
    stored rows are written again without buckets, and views then shuffle them with their map-side combine.
    """
    spark = lines.sparkSession
    name = f"lines_by_{by}_{uuid.uuid4().hex}"
    (lines.repartition(n_buckets, by).write.bucketBy(n_buckets, by).sortBy(by).option("path", f"{path.rstrip('/')}/buckets").saveAsTable(name))
    table = spark.table(name)
    sizes = table.groupBy(F.pmod(F.hash(by), F.lit(n_buckets)).alias("bucket")).count().agg(F.max("count"), F.sum("count")).first()
    if sizes[1] and sizes[0] * n_buckets > max_share * sizes[1]:
        spread = f"{path.rstrip('/')}/spread"
        table.repartition(n_buckets).write.parquet(spread)
        return spark.read.schema(table.schema).parquet(spread)
    return table


def write_view(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
               partition_by: list[str] | None = None) -> None:
    """Write a view as parquet (default) or CSV with a header for BI tools.

    Quotes inside CSV fields are doubled, as the library's readers expect.
    Arrays are joined into ``|``-separated text for CSV, which has no list type.
    """
    writer_df = df
    if fmt == "csv":
        writer_df = df.select(*[
            F.array_join(F.col(f.name), "|").alias(f.name) if isinstance(f.dataType, T.ArrayType)
            else F.col(f.name) for f in df.schema.fields])
    writer = writer_df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    else:
        writer.format(fmt).save(path)


_EMPTY = "\x01"


def publish_view(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Write a view so that ``path`` appears only when it holds all of it; returns the number of rows.

    The view is written to a staged folder beside ``path`` while its rows are counted and hashed in the same
    pass.  The staged folder is read back, and only if count and hash agree does it get its final name.  A
    job that fails or loses rows leaves no ``path``, only the staged folder.  Sorted views keep
    their order: their files are numbered ranges of it.  An existing ``path`` is an error.

    CSV cells are text (arrays joined by ``|``); a null cell is left empty and an empty text is quoted.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    final, staged = jvm.Path(path), jvm.Path(f"{path.rstrip('/')}-staged-{uuid.uuid4().hex}")
    files = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(final):
        raise FileExistsError(path)
    rows = _as_text(df) if fmt == "csv" else df
    seen = Observation()
    write_view(rows.observe(seen, *_contents(rows)), staged.toString(), fmt)
    reader = spark.read.schema(rows.schema)
    if fmt == "csv":  # a quoted empty cell is read as a mark, else it could not be told from a null
        back = reader.csv(staged.toString(), header=True, escape='"', multiLine=True, emptyValue=_EMPTY)
        back = back.select(*[F.when(F.col(c) != _EMPTY, F.col(c)).when(F.col(c) == _EMPTY, "").alias(c) for c in back.columns])
    else:
        back = reader.format(fmt).load(staged.toString())
    want, got = seen.get, back.agg(*_contents(back)).first().asDict()
    if want != got:
        raise RuntimeError(f"{staged.toString()} holds {got}, the view {want}; nothing was published as {path}")
    if not files.rename(staged, final):
        raise RuntimeError(f"{staged.toString()} could not be renamed to {path}")
    return got["rows"]


def _contents(df: DataFrame) -> list[Column]:
    """Row count and an order-free hash of all cells."""
    cells = F.xxhash64(*df.columns)
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.bit_xor(cells), F.lit(0)).alias("hash"),
            F.coalesce(F.sum(cells.bitwiseAND(0xFFFFFFFF)), F.lit(0)).alias("sum")]


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[(F.array_join(F.col(f.name), "|") if isinstance(f.dataType, T.ArrayType) else F.col(f.name).cast("string")).alias(f.name)
                       for f in df.schema.fields])
