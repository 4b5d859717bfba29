"""Helpers shared by the operators: shared folder, written tables, bounded Arrow slices,
connected components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# One slice of texts handled at a time by a Python task (bytes of UTF-8).
SLICE_BYTES = 2 << 20
# Bytes of one Arrow batch between Spark and a Python task, where the session allows more.
BATCH_BYTES = 4 << 20
# Keys with more than 1 / HEAVY of all uses are joined by a broadcast: there are fewer than HEAVY of them.
HEAVY = 4096


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared ``spark.checkpoint.dir`` of the session.  Only where that
    is unset and all of Spark runs on this machine (local tests) a scratch folder stands in."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        root = tempfile.mkdtemp(prefix="tillroll-llm-")
    return f"{root.rstrip('/')}/llm-{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, so a lost executor costs a
    reread and never a recomputation of what came before."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def looked_up(rows: DataFrame, table: DataFrame, by: list[str], value: list[str]) -> DataFrame:
    """``rows`` (a written table) with the columns ``value`` of ``table``, whose ``n`` says how many rows have the key."""
    uses = table.agg(F.sum("n")).first()[0] or 0
    many = F.col("n") * HEAVY > uses  # less than HEAVY keys can be above this share
    cols = table.select(*by, *value, F.lit(True).alias("found_"))
    tried = rows.join(F.broadcast(cols.where(many)), by, "left")
    rest = tried.where("found_ is null").drop("found_", *value).join(cols.where(~many).drop("found_"), by)
    return tried.where("found_").drop("found_").unionByName(rest)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session's Arrow batches bounded by ``BATCH_BYTES``: texts differ in length by
    orders of magnitude, so a number of rows does not bound what a task holds."""
    key, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    try:
        now = int(re.sub(r"\D", "", conf.get(key)))
    except ValueError:
        now = 0
    if not 0 < now <= BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id long, text string) of ``docs``, whatever other columns it has."""
    return small_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))


def held_out(id_col: str, modulus: int, remainder: int):
    """crc32 of the id's decimal text, modulo ``modulus``, equals ``remainder`` (a null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in pieces whose texts hold at most ``limit`` bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(text)), 0).cast(pa.int64()))
        ends = ends.to_numpy(zero_copy_only=False)
        lo, base = 0, 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(ends.searchsorted(base + limit, side="right")))
            yield batch.slice(lo, hi - lo)
            lo, base = hi, int(ends[hi - 1])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long): component is the smallest
    node reachable.  Alternating large-star and small-star steps; every round is a written table
    and only its edge count and checksum reach the driver."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            hood = e.union(e.select("b", "a")).toDF("u", "v")
        else:
            hood = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = hood.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        joined = hood.join(low, "u")
        if large:
            out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
                low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a != b").distinct()

    def mark(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())

    now = written(edges.where("a != b").select("a", "b"), "edges")
    seen = None
    for _ in range(max_rounds):
        now = written(star(star(now, True), False), "edges")
        sign = mark(now)
        if sign == seen or not sign[0]:
            break
        seen = sign
    else:
        raise RuntimeError("components did not settle")
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.union(now.select("b", "b")).distinct()
