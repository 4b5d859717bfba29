"""Views over wide text reports (months or days as columns).

Report inputs are (file, line_no, line) tables, e.g. from
``tillroll.sources.reports.read_numbered_lines``; each input holds one report.
Cells are matched by their position in the line, the time axis comes from the
header line, and only the positions the header names are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.calendar import parse_day_header, parse_month_header
from tillroll.functions.text import csv_fields, naive_fields
from tillroll.operators.growth import cmgr_expr
from tillroll.operators.reshape import explode_positions, header_axis, rows_to_columns, zip_positions
from tillroll.operators.scalars import scalar_struct
from tillroll.sources.reports import body_lines, line_at

# Report framing.  One header line, six trailing summary lines,
# five trailing summary columns in the header of the type and daily reports.
HEADER_LINES = 1
FOOTER_LINES = 6
HEADER_TRAILING_COLUMNS = 5
# Daily summary rows read, by 0-based line number.
DAILY_ROWS = {3: "revenue", 4: "cost_of_goods", 5: "gross_profit", 6: "margin"}
# Variant report layout: label columns kept, first month column, trailing
# columns after the months, and the revenue / gross profit columns from the end.
VARIANT_LABELS = {0: "label_0", 3: "label_3", 5: "label_5"}
VARIANT_FIRST_MONTH = 7
VARIANT_TRAILING = 6
VARIANT_REVENUE_FROM_END = 5
VARIANT_PROFIT_FROM_END = 3
MONEY_TEXT = "decimal(38,6)"


def _cells(report: DataFrame, fields_fn, first_pos: int = 1) -> DataFrame:
    body = body_lines(report, HEADER_LINES, FOOTER_LINES)
    body = body.select("line_no", fields_fn(F.col("line")).alias("fields"))
    body = body.select("line_no", F.col("fields").getItem(0).alias("label"), "fields")
    return explode_positions(body, F.col("fields"), ["line_no", "label"], first_pos)


def one_report(lines: DataFrame) -> DataFrame:
    """``lines``, if they are of one file: rows of several would match by position."""
    files = lines.select(F.count_distinct("file")).scalar()
    stop = F.raise_error(F.lit("a positional report must be one file")).cast("boolean")
    return lines.where(F.when(files > 1, stop).otherwise(F.lit(True)))


def revenue_by_type_long(revenue_report: DataFrame, profit_report: DataFrame) -> DataFrame:
    """month, revenue, gross_profit, type from two type-by-month reports.

    The two reports are matched by row and column position, so each is one file;
    more than one stops the query.
    """
    revenue_report, profit_report = one_report(revenue_report), one_report(profit_report)
    named = naive_fields(F.col("line"))
    months = F.transform(F.slice(named, F.lit(2), F.greatest(F.size(named) - 1 - HEADER_TRAILING_COLUMNS, F.lit(0))), parse_month_header)
    axis = line_at(revenue_report, 0).select(months).scalar()
    rev, gp = _body_fields(revenue_report, "rev"), _body_fields(profit_report, "gp")
    # lines meet on their number, and only then are their cells matched by position and spread into rows
    cells = zip_positions({"month": axis, "rev_text": _after_label("rev"), "gp_text": _after_label("gp")})
    out = rev.join(gp, "line_no").select(F.col("rev").getItem(0).alias("type"), F.inline(cells))
    return out.select("month", F.col("rev_text").try_cast("double").alias("revenue"),
                      F.col("gp_text").try_cast("double").alias("gross_profit"), "type")


def _body_fields(report: DataFrame, name: str) -> DataFrame:
    return body_lines(report, HEADER_LINES, FOOTER_LINES).select("line_no", naive_fields(F.col("line")).alias(name))


def _after_label(fields: str) -> Column:
    return F.slice(F.col(fields), F.lit(2), F.greatest(F.size(fields) - 1, F.lit(0)))


def daily_sales_summary(report: DataFrame) -> DataFrame:
    """date, revenue, cost_of_goods, gross_profit, margin from the daily report
    (one file; more than one stops the query)."""
    report = one_report(report)
    header = line_at(report, 0)
    days = header_axis(naive_fields(F.col("line")), header, parse_day_header,
                       trailing=HEADER_TRAILING_COLUMNS, key_col="date").select("pos", "date")
    rows = report.where(F.col("line_no").isin(list(DAILY_ROWS)))
    cells = explode_positions(rows.select("line_no", naive_fields(F.col("line")).alias("f")),
                              F.col("f"), ["line_no"], first_pos=1)
    cells = cells.select("line_no", "pos", F.col("value").try_cast("double").alias("value"))
    wide = rows_to_columns(cells, ["pos"], "line_no", "value", DAILY_ROWS)
    out = wide.join(days, "pos")
    return out.select("date", *DAILY_ROWS.values())


def product_growth_report(report: DataFrame) -> DataFrame:
    """Per variant row: labels, revenue, gross profit, growth and shares.

    Columns: label_0, label_3, label_5, revenue, gross_profit, cmgr, n_periods,
    pct_revenue, avg_revenue, avg_gross_profit, pct_dev_from_avg,
    pct_gross_profit.  The growth base is the first non-zero month; with no
    such month n_periods is 1 and cmgr null.
    """
    # The field array is computed once and reused by every column below.
    body = body_lines(report, HEADER_LINES, FOOTER_LINES).select(
        csv_fields(F.col("line")).alias("fields"))
    f = F.col("fields")
    parsed = body.select(
        *[f.getItem(pos).alias(name) for pos, name in VARIANT_LABELS.items()],
        F.slice(f, VARIANT_FIRST_MONTH + 1,
                F.size(f) - VARIANT_FIRST_MONTH - VARIANT_TRAILING).alias("months"),
        F.element_at(f, -VARIANT_REVENUE_FROM_END).try_cast(MONEY_TEXT).alias("revenue_exact"),
        F.element_at(f, -VARIANT_PROFIT_FROM_END).try_cast(MONEY_TEXT).alias("gp_exact"),
    )
    # Each step is its own projection so that array work is done once per row
    # (expressions inside higher-order functions are not shared otherwise).
    labels = list(VARIANT_LABELS.values())
    keep = [*labels, "revenue_exact", "gp_exact"]
    step = parsed.select(*keep, F.transform("months", lambda v: v.try_cast("double")).alias("values"))
    step = step.select(*keep, "values",
                       F.array_position(F.transform("values", lambda v: v != 0), True)
                       .cast("int").alias("first_nz"))
    step = step.select(
        *keep,
        F.when(F.col("first_nz") > 0, F.size("values") - F.col("first_nz") + 1)
         .otherwise(F.lit(1)).cast("int").alias("n_periods"),
        F.when(F.col("first_nz") > 0, F.element_at("values", F.col("first_nz"))).alias("base"))
    rows = step.select(
        *labels,
        F.col("revenue_exact").cast("double").alias("revenue"),
        F.col("gp_exact").cast("double").alias("gross_profit"),
        cmgr_expr(F.col("revenue_exact"), F.col("base"), F.col("n_periods")).alias("cmgr"),
        "n_periods", "revenue_exact", "gp_exact",
    )
    t = scalar_struct(parsed, revenue=F.sum("revenue_exact"), gp=F.sum("gp_exact"),
                      rows=F.count(F.lit(1)))
    tot_rev = t.getField("revenue").cast("double")
    tot_gp = t.getField("gp").cast("double")
    avg_rev = F.try_divide(tot_rev, t.getField("rows"))
    avg_gp = F.try_divide(tot_gp, t.getField("rows"))
    return rows.select(
        *VARIANT_LABELS.values(), "revenue", "gross_profit", "cmgr", "n_periods",
        F.try_divide(F.col("revenue") * 100, tot_rev).alias("pct_revenue"),
        avg_rev.alias("avg_revenue"), avg_gp.alias("avg_gross_profit"),
        F.try_divide((F.col("revenue") - avg_rev) * 100, avg_rev).alias("pct_dev_from_avg"),
        F.try_divide(F.col("gross_profit") * 100, tot_gp).alias("pct_gross_profit"),
    )
