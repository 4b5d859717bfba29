"""Render wide text reports from the test tables, in the layouts the report
views read.  These build inputs only; the parsing, reshaping and arithmetic are
done by ``tillroll.plans.reports`` on the rendered text.

Money is rendered from exact decimal sums, so text values are exact.

Each report's size is set by the calendar span and the number of types or
products, not by the number of order lines.  Its lines are numbered with a
distributed sort (``operators.numbering``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.growth import dense_months, month_axis
from tillroll.operators.numbering import number_rows
from tillroll.sources.testdata import table

REVENUE = "decimal(12,2)"
DISCOUNT = "decimal(4,2)"
_TRAILING_HEADER = ["Total", "Average", "Minimum", "Maximum", "Share"]


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice",
                                                  "l_discount", "l_shipdate")
    rev = F.col("l_extendedprice").cast(REVENUE)
    return li.select(
        "l_partkey", F.col("l_quantity").cast("int").alias("qty"),
        F.to_date("l_shipdate").alias("day"),
        rev.alias("revenue"), (rev * F.col("l_discount").cast(DISCOUNT)).alias("gross_profit"))


def _number(lines: DataFrame, order_cols: list[str], file_name: str) -> DataFrame:
    numbered = number_rows(lines, order_cols, "line_no", count_col="n_lines")
    return numbered.select(F.lit(file_name).alias("file"), "line_no", "line", "n_lines")


def _footer(first_field: Column | None = None) -> list[Column]:
    return [F.lit(""), F.lit("Totals exclude tax"), F.lit("Report generated from sales"),
            F.lit("All amounts in store currency"), F.lit(""), F.lit("End of report")]


def _join_values(arr: Column, field: str) -> Column:
    return F.array_join(F.transform(arr, lambda x: x[field].cast("string")), ",")


def _month_header(cells: DataFrame, lead: str, trailing: list[str]) -> DataFrame:
    """Header line: ``lead``, one ``MMM yyyy`` per distinct month, trailing names."""
    axis = cells.agg(F.array_sort(F.collect_set("month")).alias("axis"))
    months = F.array_join(F.transform("axis", lambda m: F.date_format(m, "MMM yyyy")), ",")
    return axis.select(F.concat_ws(",", F.lit(lead), months, *[F.lit(x) for x in trailing])
                       .alias("line"))


def _framed(header: DataFrame, body: DataFrame, file_name: str) -> DataFrame:
    """header (line), body (sort_key, line) -> numbered lines with 6 footer lines."""
    footer = header.select(F.posexplode(F.array(*_footer())).alias("i", "line"))
    parts = (header.select(F.lit(0).alias("section"), F.lit("").alias("k"), F.lit(0).alias("i"), "line")
             .unionByName(body.select(F.lit(1).alias("section"), F.col("sort_key").alias("k"),
                                      F.lit(0).alias("i"), "line"))
             .unionByName(footer.select(F.lit(2).alias("section"), F.lit("").alias("k"), "i", "line")))
    return _number(parts, ["section", "k", "i"], file_name)


def type_month_reports(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(revenue report, gross profit report): one row per part type, one column
    per ship month (``MMM yyyy``), five trailing summary columns, six footer
    lines.  The two reports list types in the same order."""
    sales = _sales(spark, sf_dir)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    cells = (sales.join(part, sales.l_partkey == part.p_partkey)
                  .groupBy(F.col("p_type").alias("type"), F.trunc("day", "MM").alias("month"))
                  .agg(F.sum("revenue").alias("revenue"), F.sum("gross_profit").alias("gross_profit")))
    axis = month_axis(cells)
    rev = dense_months(cells.select("type", "month", "revenue"), ["type"], axis=axis)
    gp = dense_months(cells.select("type", "month", F.col("gross_profit").alias("revenue")),
                      ["type"], axis=axis)
    header = _month_header(cells, "Type", _TRAILING_HEADER)

    def body(dense: DataFrame) -> DataFrame:
        rows = dense.groupBy("type").agg(
            F.array_sort(F.collect_list(F.struct("month", "revenue"))).alias("s"),
            F.sum("revenue").alias("total"), F.avg("revenue").alias("average"),
            F.min("revenue").alias("minimum"), F.max("revenue").alias("maximum"))
        return rows.select(F.col("type").alias("sort_key"), F.concat_ws(
            ",", "type", _join_values(F.col("s"), "revenue"),
            *[F.col(c).cast("string") for c in ["total", "average", "minimum", "maximum"]],
            F.lit("100")).alias("line"))

    return (_framed(header, body(rev), "revenue_by_type.csv"),
            _framed(header, body(gp), "gross_profit_by_type.csv"))


def variant_month_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sold part: seven label columns (name quoted), one revenue
    column per ship month, then items, revenue, cost, gross profit, margin and
    a note; header line and six footer lines."""
    sales = _sales(spark, sf_dir)
    cells = sales.groupBy(F.col("l_partkey").alias("partkey"), F.trunc("day", "MM").alias("month")) \
                 .agg(F.sum("revenue").alias("revenue"))
    axis = month_axis(cells)
    dense = dense_months(cells, ["partkey"], axis=axis)
    series = dense.groupBy("partkey").agg(
        F.array_sort(F.collect_list(F.struct("month", "revenue"))).alias("s"))
    totals = sales.groupBy(F.col("l_partkey").alias("partkey")).agg(
        F.sum("qty").alias("items"), F.sum("revenue").alias("revenue"),
        F.sum("gross_profit").alias("gross_profit"))
    part = table(spark, sf_dir, "part")
    rows = series.join(totals, "partkey").join(part, F.col("partkey") == part.p_partkey)
    quoted_name = F.concat(F.lit('"'), F.replace(F.col("p_name"), F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(
        ",", quoted_name, F.col("p_type"), F.col("p_size").cast("string"),
        F.concat(F.lit("sku"), F.col("partkey").cast("string")), F.lit("Default"),
        F.col("p_brand"), F.col("p_retailprice").cast(REVENUE).cast("string"),
        _join_values(F.col("s"), "revenue"),
        F.col("items").cast("string"), F.col("revenue").cast("string"),
        (F.col("revenue") - F.col("gross_profit")).cast("string"),
        F.col("gross_profit").cast("string"),
        F.coalesce(F.try_divide(F.col("gross_profit") * 100, F.col("revenue")).cast("string"), F.lit("")),
        F.lit("ok"))
    body = rows.select(F.lpad(F.col("partkey").cast("string"), 20, "0").alias("sort_key"),
                       line.alias("line"))
    header = _month_header(cells, "Product,Type,Size,SKU,Variant,Brand,Price",
                           ["Items", "Revenue", "Cost", "Gross Profit", "Margin", "Note"])
    return _framed(header, body, "revenue_by_variant.csv")


def _ordinal(day: Column) -> Column:
    suffix = (F.when((day % 100).isin(11, 12, 13), F.lit("th"))
               .when(day % 10 == 1, F.lit("st")).when(day % 10 == 2, F.lit("nd"))
               .when(day % 10 == 3, F.lit("rd")).otherwise(F.lit("th")))
    return F.concat(day.cast("string"), suffix)


def daily_summary_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line 0: ``Day`` and one ``Thu 1st Jan 2015`` column per ship day plus five
    summary columns; lines 1-6: sales count, items, revenue, cost of goods,
    gross profit, margin (percent); then two footer lines."""
    sales = _sales(spark, sf_dir)
    daily = sales.groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.sum("qty").alias("items"),
        F.sum("revenue").alias("revenue"), F.sum("gross_profit").alias("gross_profit"))
    margin = F.try_divide(F.col("gross_profit").cast("double") * 100, F.col("revenue").cast("double"))
    entries = daily.select(F.struct(
        F.col("day").alias("d"),
        F.concat_ws(" ", F.date_format("day", "EEE"), _ordinal(F.dayofmonth("day")),
                    F.date_format("day", "MMM"), F.year("day").cast("string")).alias("label"),
        F.col("n").cast("string").alias("n"), F.col("items").cast("string").alias("items"),
        F.col("revenue").cast("string").alias("revenue"),
        (F.col("revenue") - F.col("gross_profit")).cast("string").alias("cogs"),
        F.col("gross_profit").cast("string").alias("gp"),
        F.coalesce(margin.cast("string"), F.lit("")).alias("margin")).alias("e"))
    one = entries.agg(F.array_sort(F.collect_list("e")).alias("s"))
    lines = F.array(
        F.concat_ws(",", F.lit("Day"), _join_values(F.col("s"), "label"), *[F.lit(x) for x in _TRAILING_HEADER]),
        F.concat_ws(",", F.lit("Sales count"), _join_values(F.col("s"), "n")),
        F.concat_ws(",", F.lit("Items sold"), _join_values(F.col("s"), "items")),
        F.concat_ws(",", F.lit("Revenue"), _join_values(F.col("s"), "revenue")),
        F.concat_ws(",", F.lit("Cost of goods"), _join_values(F.col("s"), "cogs")),
        F.concat_ws(",", F.lit("Gross profit"), _join_values(F.col("s"), "gp")),
        F.concat_ws(",", F.lit("Margin"), _join_values(F.col("s"), "margin")),
        F.lit(""), F.lit("End of report"))
    return one.select(F.lit("sales_summary_by_day.csv").alias("file"),
                      F.posexplode(lines).alias("line_no", "line"),
                      F.size(lines).alias("n_lines"))
