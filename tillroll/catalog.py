"""Named queries: each view bound to inputs derived from a test-data folder.

``QUERIES[name](spark, sf_dir)`` returns the view's DataFrame.  Float results
that pass through ``pow`` are rounded to 6 places so that independent engines
agree; everything else is exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import plans
from tillroll.functions import calendar as cal
from tillroll.functions.text import upper_label
from tillroll.session import run_folder
from tillroll.sources import exports, report_fixtures, sinks, testdata
from tillroll.sources import reports as report_lines

# Fixed parameters of the bound queries.
RETENTION_AS_OF = "2001-05-01"
AS_OF = "2001-08-01"
YEAR_START = "1995-01-01"
ROUND_PLACES = 6

Query = Callable[[SparkSession, str], DataFrame]
View = Callable[[object], DataFrame]


class TestDataInputs:
    """Inputs shaped from the raw test tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def lines(self) -> DataFrame:
        return testdata.order_lines(self.spark, self.sf_dir)

    def customers(self) -> DataFrame:
        return testdata.customers_export(self.spark, self.sf_dir)

    def segments(self) -> DataFrame:
        return testdata.segments(self.spark, self.sf_dir)

    def scores(self) -> DataFrame:
        return exports.parse_score_lines(testdata.score_lines(self.spark, self.sf_dir))

    def events(self) -> DataFrame:
        return testdata.event_lines(self.spark, self.sf_dir)

    def export_text(self) -> DataFrame:
        return testdata.order_export_text(self.spark, self.sf_dir)

    def type_reports(self) -> tuple[DataFrame, DataFrame]:
        return report_fixtures.type_month_reports(self.spark, self.sf_dir)

    def daily_report(self) -> DataFrame:
        return report_fixtures.daily_summary_report(self.spark, self.sf_dir)

    def variant_report(self) -> DataFrame:
        return report_fixtures.variant_month_report(self.spark, self.sf_dir)


class StagedInputs:
    """The same inputs read back from files written once by ``stage``: parquet
    tables for the exports, text files for the export CSV and the reports."""

    TABLES = ["lines", "customers", "segments", "scores", "events"]

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @classmethod
    def stage(cls, source: TestDataInputs, root: str, n_files: int | None = None) -> "StagedInputs":
        """Write every input once.  Tables and the export text are spread over
        ``n_files`` files (default: twice the default parallelism), as a large
        export would be; each report stays one file."""
        root = root.rstrip("/")
        n_files = n_files or 2 * source.spark.sparkContext.defaultParallelism
        sinks.store_order_lines(source.lines(), f"{root}/lines", n_files)
        for name in cls.TABLES:
            if name == "lines":
                continue
            getattr(source, name)().repartition(n_files).write.mode("errorifexists").parquet(
                f"{root}/{name}")
        source.export_text().repartition(n_files).write.mode("errorifexists").text(
            f"{root}/export_text")
        rev, gp = source.type_reports()
        for name, df in [("revenue_report", rev), ("profit_report", gp),
                         ("daily_report", source.daily_report()),
                         ("variant_report", source.variant_report())]:
            # A report is one file with its lines in order.
            df.orderBy("line_no").select("line").coalesce(1).write.mode("errorifexists").text(
                f"{root}/{name}")
        return cls(source.spark, root)

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def lines(self):
        return self._table("lines")

    def customers(self):
        return self._table("customers")

    def segments(self):
        return self._table("segments")

    def scores(self):
        return self._table("scores")

    def events(self):
        return self._table("events")

    def export_text(self):
        return self.spark.read.text(f"{self.root}/export_text")

    def _report(self, name: str) -> DataFrame:
        return report_lines.read_numbered_lines(self.spark, f"{self.root}/{name}")

    def type_reports(self):
        return self._report("revenue_report"), self._report("profit_report")

    def daily_report(self):
        return self._report("daily_report")

    def variant_report(self):
        return self._report("variant_report")


def _round(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.round(c, ROUND_PLACES).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def _joined_scores(df: DataFrame) -> DataFrame:
    return df.withColumn("scores", F.array_join("scores", "|"))


def q_bought_together(inp):
    return plans.bought_together(inp.lines())


def q_bought_together_monthly(inp):
    return plans.bought_together_monthly(inp.lines())


def q_customer_retention(inp):
    return plans.customer_retention(inp.lines(), RETENTION_AS_OF)


def q_order_gap(inp):
    return plans.order_gap(inp.lines())


def q_order_gap_events(inp):
    return plans.order_gap(inp.events())


def q_order_frequency_histogram(inp):
    return plans.order_frequency_histogram(inp.lines())


def q_recency(inp):
    return plans.recency(inp.lines(), AS_OF)


def q_day_hour_profile(inp):
    return plans.day_hour_profile(inp.lines())


def q_day_hour_profile_events(inp):
    return plans.day_hour_profile(inp.events())


def q_customer_value_segment(inp):
    return plans.customer_value_segment(inp.lines(), inp.customers(),
                                        inp.segments())


def q_global_averages(inp):
    return plans.global_averages(inp.lines(), inp.customers())


def q_population_averages(inp):
    return plans.population_averages(inp.lines())


def q_customer_score_attach(inp):
    keys = plans.known_customers(inp.lines(), inp.customers())
    return _joined_scores(plans.customer_score_attach(keys, inp.scores()))


def q_calendar_columns(inp):
    orders = inp.lines().select("order_id", "created_at").distinct()
    d = cal.created_date("created_at")
    hour = cal.created_hour("created_at")
    return orders.select(
        "order_id", d.alias("order_date"), cal.month_start(d).alias("month"),
        cal.year_month(d).alias("year_month"), cal.week_start_thursday(d).alias("week"),
        cal.weekday_name(d).alias("weekday"), hour.alias("hour"),
        cal.two_hour_slot(hour).alias("slot"),
        cal.days_between(F.lit(AS_OF).cast("date"), d).alias("days_to_as_of"))


def q_label_columns(inp):
    det = exports.customer_details(inp.customers())
    sc = inp.scores()
    out = det.join(sc, "email")
    return out.select("email", "name", "location", upper_label("name").alias("name_upper"),
                      F.size("scores").alias("n_scores"),
                      F.element_at("scores", 1).alias("first_score"))


def q_customer_profile(inp):
    out = plans.customer_profile(inp.lines(), inp.customers(),
                                 inp.segments(), inp.scores(), AS_OF)
    return _joined_scores(out)


def q_weekly_visits(inp):
    return plans.weekly_visits(inp.lines())


def q_weekly_basket(inp):
    return plans.weekly_basket(inp.lines())


def q_customer_week_profile(inp):
    return plans.customer_week_profile(inp.lines(), inp.customers())


def q_product_week_revenue(inp):
    return _round(plans.product_week_revenue(inp.lines()), "cmgr")


def q_product_month_revenue(inp):
    return plans.product_month_revenue(inp.lines())


def q_product_month_dense(inp):
    return plans.product_month_dense(inp.lines())


def q_product_cmgr(inp):
    return _round(plans.product_cmgr(inp.lines()), "cmgr")


def q_product_series(inp):
    return plans.product_series(inp.lines())


def q_unfulfilled_by_day(inp):
    return plans.unfulfilled_by_day(inp.lines(), AS_OF)


def q_unfulfilled_by_month(inp):
    return plans.unfulfilled_by_month(inp.lines(), AS_OF, start=YEAR_START)


def q_revenue_by_type_long(inp):
    rev, gp = inp.type_reports()
    return plans.revenue_by_type_long(rev, gp)


def q_daily_sales_summary(inp):
    return plans.daily_sales_summary(inp.daily_report())


def q_product_growth_report(inp):
    return _round(plans.product_growth_report(inp.variant_report()),
                  "cmgr")


def q_csv_order_lines(inp):
    parsed = exports.parse_order_export(inp.export_text())
    return _plain_lines(parsed)


def q_stored_lines_views(inp):
    """Gaps, recency and weekday habits of every customer, three views of order lines that were parsed and stored once."""
    spark = inp.spark
    stored = sinks.store_bucketed_lines(inp.lines(), "email", run_folder(spark, "lines-by-email", allow_local_default=True),
                                        2 * spark.sparkContext.defaultParallelism)
    habits = plans.day_hour_profile(stored).select("email", "sunday", "h00")
    return plans.order_gap(stored).join(plans.recency(stored, AS_OF), "email").join(habits, "email")


def q_order_gap_rows(inp):
    return plans.order_gap_rows(inp.lines())


def q_order_gap_rows_events(inp):
    return plans.order_gap_rows(inp.events())


def q_bought_together_basket_arrays(inp):
    return plans.bought_together_basket_arrays(inp.lines())


def q_shared_orders(inp):
    """Orders shared by every two products of one type (the last word of the name), pairs without a common order included."""
    lines = inp.lines()
    typed = lines.select("product").distinct().withColumn("kind", F.substring_index("product", " ", -1))
    pairs = typed.withColumnRenamed("product", "product_1").join(typed.withColumnRenamed("product", "product_2"), "kind")
    return plans.shared_orders(lines, pairs.where("product_1 < product_2"))


def q_bought_together_published(inp):
    """The sorted pair view published as parquet and read back from there."""
    path = run_folder(inp.spark, "bought-together", allow_local_default=True)
    sinks.publish_view(plans.bought_together(inp.lines()), path)
    return inp.spark.read.parquet(path)


def q_customer_week_published(inp):
    """The weekly visits published as CSV and read back from there."""
    path = run_folder(inp.spark, "weekly-visits", allow_local_default=True)
    view = plans.weekly_visits(inp.lines())
    sinks.publish_view(view, path, "csv")
    return inp.spark.read.csv(path, schema=view.schema, header=True, escape='"')


def q_export_rejects(inp):
    """Lines of a damaged export file by what became of them: of every twenty orders one has a quantity in words, one a price with too many
    decimals and one a date in another format."""
    lines = inp.lines()
    turn = F.pmod(F.substring("order_id", 2, 20).cast("long"), F.lit(20))
    damaged = lines.select("order_id", "email", "status", F.when(turn == 3, F.concat(F.lit("on "), "created_at")).otherwise(F.col("created_at")).alias("created_at"),
                           F.when(turn == 1, "a few").otherwise(F.col("qty").cast("string")).alias("qty"), "product",
                           F.when(turn == 2, F.concat(F.col("price").cast("string"), F.lit("5"))).otherwise(F.col("price").cast("string")).alias("price"), "sku")
    path = run_folder(inp.spark, "damaged-export", allow_local_default=True)
    testdata.export_text_of(inp.spark, damaged).write.text(path)
    kept, rejects = exports.split_order_export(inp.spark.read.text(path))
    both = kept.select(F.col("order_id"), F.lit("kept").alias("reason")).unionByName(
        rejects.select(F.substring_index("line", ",", 1).alias("order_id"), "reason"))
    return both.groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct("order_id").alias("n_orders"))


def q_customer_export_files(inp):
    """The customer, segment and score exports written as CSV files into new shared folders, read back by the
    library's readers and joined by customer."""
    def folder(rows, name):
        path = run_folder(inp.spark, name, allow_local_default=True)
        rows.write.option("header", "true").option("escape", '"').csv(path)
        return path

    customers = exports.read_customers_export(inp.spark, folder(testdata.customer_export_columns(inp.customers()), "customers"))
    segments = exports.read_segments(inp.spark, folder(inp.segments(), "segments"))
    scores = inp.scores().select("email", F.col("scores")[0].alias("score_1"), F.col("scores")[1].alias("score_2"))
    scores = exports.read_scores(inp.spark, folder(scores, "scores"))
    joined = exports.customer_details(customers).join(segments, "email", "left").join(scores, "email", "left")
    return _joined_scores(joined.select("email", "name", "location", "attr12", "segment", "scores"))


def _plain_lines(lines):
    return lines.select("order_id", "email", "status", "created_at", F.col("qty").cast("double").alias("qty"),
                        "product", F.col("price").cast("double").alias("price"), "sku")


def q_order_export_files(inp):
    """The order lines written as export CSV files into a new shared folder, products with a
    non-ASCII word in front, and read back from there by the library's reader."""
    rows = inp.lines().withColumn("product", F.concat(F.lit("Café "), "product"))
    path = run_folder(inp.spark, "order-export", allow_local_default=True)
    testdata.export_text_of(inp.spark, rows).write.text(path)
    return _plain_lines(exports.read_order_export(inp.spark, path))


def q_daily_summary_file(inp):
    """The daily report written as one text file into a new shared folder, numbered and read back."""
    path = run_folder(inp.spark, "daily-report", allow_local_default=True)
    inp.daily_report().orderBy("line_no").select("line").coalesce(1).write.text(path)
    return plans.daily_sales_summary(report_lines.read_numbered_lines(inp.spark, path))


VIEWS: dict[str, View] = {
    "bought_together": q_bought_together,
    "bought_together_monthly": q_bought_together_monthly,
    "customer_retention": q_customer_retention,
    "order_gap": q_order_gap,
    "order_gap_events": q_order_gap_events,
    "order_frequency_histogram": q_order_frequency_histogram,
    "recency": q_recency,
    "day_hour_profile": q_day_hour_profile,
    "day_hour_profile_events": q_day_hour_profile_events,
    "customer_value_segment": q_customer_value_segment,
    "global_averages": q_global_averages,
    "population_averages": q_population_averages,
    "customer_score_attach": q_customer_score_attach,
    "calendar_columns": q_calendar_columns,
    "label_columns": q_label_columns,
    "customer_profile": q_customer_profile,
    "weekly_visits": q_weekly_visits,
    "weekly_basket": q_weekly_basket,
    "customer_week_profile": q_customer_week_profile,
    "product_week_revenue": q_product_week_revenue,
    "product_month_revenue": q_product_month_revenue,
    "product_month_dense": q_product_month_dense,
    "product_cmgr": q_product_cmgr,
    "product_series": q_product_series,
    "unfulfilled_by_day": q_unfulfilled_by_day,
    "unfulfilled_by_month": q_unfulfilled_by_month,
    "revenue_by_type_long": q_revenue_by_type_long,
    "daily_sales_summary": q_daily_sales_summary,
    "product_growth_report": q_product_growth_report,
    "csv_order_lines": q_csv_order_lines,
    "order_export_files": q_order_export_files,
    "daily_summary_file": q_daily_summary_file,
    "order_gap_rows": q_order_gap_rows,
    "order_gap_rows_events": q_order_gap_rows_events,
    "bought_together_basket_arrays": q_bought_together_basket_arrays,
    "shared_orders": q_shared_orders,
    "bought_together_published": q_bought_together_published,
    "weekly_visits_published": q_customer_week_published,
    "export_rejects": q_export_rejects,
    "customer_export_files": q_customer_export_files,
    "stored_lines_views": q_stored_lines_views,
}


def _bind(view: View) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return view(TestDataInputs(spark, sf_dir))
    query.__name__ = view.__name__
    query.__doc__ = view.__doc__
    return query


QUERIES: dict[str, Query] = {name: _bind(view) for name, view in VIEWS.items()}
