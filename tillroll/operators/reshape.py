"""Reshaping wide report rows into long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_positions(df: DataFrame, fields: Column, keep: Sequence[str],
                      first_pos: int = 1, pos_col: str = "pos", value_col: str = "value") -> DataFrame:
    """One row per array element at 0-based position >= ``first_pos``."""
    exploded = df.select(*keep, F.posexplode(fields).alias(pos_col, value_col))
    return exploded.where(F.col(pos_col) >= first_pos)


def zip_positions(arrays: dict[str, Column]) -> Column:
    """Arrays matched by position, as one array of structs that ends with the shortest of them."""
    n = F.least(*[F.size(a) for a in arrays.values()])
    return F.arrays_zip(*[F.slice(a, F.lit(1), n).alias(name) for name, a in arrays.items()])


def header_axis(header_fields: Column, header: DataFrame, parse, first_pos: int = 1,
                trailing: int = 5, key_col: str = "key") -> DataFrame:
    """(file, pos, key) for header fields ``[first_pos : -trailing]``, parsed by ``parse``."""
    cells = header.select("file", F.posexplode(header_fields).alias("pos", "text"),
                          F.size(header_fields).alias("width"))
    cells = cells.where((F.col("pos") >= first_pos) & (F.col("pos") < F.col("width") - trailing))
    return cells.select("file", "pos", parse(F.col("text")).alias(key_col))


def rows_to_columns(long: DataFrame, keys: Sequence[str], row_col: str, value_col: str,
                    rows: dict[int, str]) -> DataFrame:
    """Pivot selected row numbers into named columns (one conditional max each)."""
    aggs = [F.max(F.when(F.col(row_col) == r, F.col(value_col))).alias(name)
            for r, name in rows.items()]
    return long.where(F.col(row_col).isin(list(rows))).groupBy(*keys).agg(*aggs)
