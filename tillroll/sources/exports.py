"""Store exports: order lines, customers, segments and customer scores.

The order export is a CSV file with one row per order line.  Only rows whose raw
text starts with ``#`` (the order number) are order lines; this also drops the
header.  Fields are parsed with a quote-aware CSV parser and empty fields are
kept as empty strings (they group and compare as a value).

Every reader returns the canonical column names used by the views:

  order lines  order_id, email, status, created_at, qty, product, price, sku, order_date
  customers    first_name, last_name, email, address1, city, province, attr12
  segments     email, segment
  scores       email, scores (array<string>)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.calendar import created_date
from tillroll.functions.text import csv_fields, joined_with_blank
from tillroll.sources.reports import body_lines, read_numbered_lines

# The 0-based positions of the export columns the views read.
ORDER_EXPORT_POSITIONS = {
    "order_id": 0, "email": 1, "status": 4, "created_at": 15,
    "qty": 16, "product": 17, "price": 18, "sku": 20,
}
CUSTOMER_EXPORT_POSITIONS = {
    "first_name": 0, "last_name": 1, "email": 2, "address1": 4, "city": 5,
    "province": 6, "attr12": 12,
}
ORDER_LINE_COLUMNS = ["order_id", "email", "status", "created_at", "qty", "product", "price", "sku", "order_date"]
# Exact types with three decimals each, so that qty x price is a whole number of millionths.
QTY_TYPE = T.DecimalType(12, 3)
PRICE_TYPE = T.DecimalType(15, 3)


def positional_schema(width: int, names: dict[str, int]) -> T.StructType:
    """All-string schema of ``width`` columns; named positions get their name."""
    by_pos = {pos: name for name, pos in names.items()}
    return T.StructType([T.StructField(by_pos.get(i, f"_c{i}"), T.StringType(), True)
                         for i in range(width)])


ORDER_EXPORT_SCHEMA = positional_schema(max(ORDER_EXPORT_POSITIONS.values()) + 1,
                                        ORDER_EXPORT_POSITIONS)
CUSTOMER_EXPORT_SCHEMA = positional_schema(max(CUSTOMER_EXPORT_POSITIONS.values()) + 1,
                                           CUSTOMER_EXPORT_POSITIONS)

_CSV_OPTIONS = {"escape": '"', "mode": "PERMISSIVE"}


def typed_order_lines(df: DataFrame) -> DataFrame:
    """String export columns to canonical types; empty text stays ``''``.

    An absent quantity, price or date is null.  A quantity or price that its
    type cannot hold exactly (text, more than three decimals, more than nine or
    twelve digits before the point) and a created-at text that does not start
    with a date stop the query: a silent null or a rounded price would change
    every sum.  ``order_date`` is the date of ``created_at``, parsed once here so
    that stored lines can be pruned by it.
    """
    text_cols = ["order_id", "email", "status", "created_at", "product", "sku"]
    out = df.select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in text_cols],
        _exact("qty", QTY_TYPE),
        _exact("price", PRICE_TYPE),
        _order_date(),
    )
    return out.select(*ORDER_LINE_COLUMNS)


def _number(name: str, to: T.DataType) -> tuple[Column, Column, Column]:
    """Text, value and whether the value is exactly the text's number."""
    text = F.trim(F.col(name).cast("string"))
    wide, out = text.try_cast("decimal(38,10)"), text.try_cast("decimal(38,10)").try_cast(to)
    return text, out, out.isNotNull() & (out.cast("decimal(38,10)") == wide) & text.rlike(r"^[^.]*(\.\d{0,10})?$")


def _is_kept(name: str, to: T.DataType) -> Column:
    text, _, kept = _number(name, to)
    return text.isNull() | (text == "") | F.coalesce(kept, F.lit(False))


def _exact(name: str, to: T.DataType) -> Column:
    text, out, kept = _number(name, to)
    return (F.when(text.isNull() | (text == ""), F.lit(None).cast(to)).when(kept, out)
            .otherwise(F.raise_error(F.concat(F.lit(f"{name} cannot be kept exactly: "), text)).cast(to)).alias(name))


def _order_date() -> Column:
    text, date = F.col("created_at").cast("string"), created_date("created_at")
    return (F.when(date.isNotNull() | text.isNull() | (text == ""), date)
            .otherwise(F.raise_error(F.concat(F.lit("created_at holds no date: "), text)).cast("date")).alias("order_date"))


def parse_order_export(text: DataFrame, line_col: str = "value") -> DataFrame:
    """Raw export lines -> typed order lines (quote-aware, header dropped)."""
    rows = text.where(F.col(line_col).startswith("#"))
    parsed = rows.select(F.from_csv(F.col(line_col), ORDER_EXPORT_SCHEMA.simpleString(),
                                    _CSV_OPTIONS).alias("r"))
    return typed_order_lines(parsed.select(*[F.col("r." + c).alias(c) for c in ORDER_EXPORT_POSITIONS]))


def split_order_export(text: DataFrame, line_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(order lines, rejects): the lines that ``parse_order_export`` would accept, and the others as they
    stand, (line, reason).  The reason names the first field that cannot be kept: ``qty``, ``price`` or ``created_at``.
    Both read the same parse; lines that are no order lines (header, notes) are in neither."""
    rows = text.where(F.col(line_col).startswith("#"))
    # the fields come out of a generator, so that filters on them do not repeat the parse
    parse = F.from_csv(F.col(line_col), ORDER_EXPORT_SCHEMA.simpleString(), _CSV_OPTIONS)
    fields = rows.select(F.col(line_col).alias("line"), F.inline(F.array(parse))).select("line", *ORDER_EXPORT_POSITIONS)
    date = F.col("created_at").cast("string")
    reason = (F.when(~_is_kept("qty", QTY_TYPE), "qty").when(~_is_kept("price", PRICE_TYPE), "price")
              .when(created_date("created_at").isNull() & (F.coalesce(date, F.lit("")) != ""), "created_at"))
    judged = fields.withColumn("reason", reason)
    return typed_order_lines(judged.where("reason is null")), judged.where("reason is not null").select("line", "reason")


def read_order_export(spark: SparkSession, path: str) -> DataFrame:
    """Order export CSV file(s); splittable, one task per file block."""
    return parse_order_export(spark.read.text(path))


def read_customers_export(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.csv(path, schema=CUSTOMER_EXPORT_SCHEMA, header=True, **_CSV_OPTIONS)
    return raw.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in CUSTOMER_EXPORT_POSITIONS])


def customer_details(customers: DataFrame) -> DataFrame:
    """email, name (first + last), location (address, city, province), attr12."""
    return customers.select(
        "email",
        joined_with_blank("first_name", "last_name").alias("name"),
        joined_with_blank("address1", "city", "province").alias("location"),
        "attr12",
    )


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    schema = "email string, segment string"
    raw = spark.read.csv(path, schema=schema, header=True, **_CSV_OPTIONS)
    return raw.select(F.coalesce("email", F.lit("")).alias("email"),
                      F.coalesce("segment", F.lit("")).alias("segment"))


def parse_score_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Variable-width score lines: first field is the email, the rest a list."""
    fields = csv_fields(F.col(line_col))
    return lines.select(fields.getItem(0).alias("email"),
                        _tail(fields).alias("scores"))


def _tail(arr: Column) -> Column:
    return F.slice(arr, 2, F.greatest(F.size(arr) - 1, F.lit(0)))


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """Score file(s) with a header line; rows may have any number of fields."""
    return parse_score_lines(body_lines(read_numbered_lines(spark, path), header=1, footer=0))
