"""Adapters that shape the /root/testdata tables into the exports the views read.

They only produce rows in the export layout; every view computation happens in
``tillroll.plans`` on whatever rows arrive.  The customer, segment and score
exports hold every customer and every order line is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.exports import typed_order_lines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _email(custkey) -> F.Column:
    return F.concat(F.lit("cust"), F.col(custkey).cast("string"), F.lit("@example.com"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders x part as order-export lines.

    created_at is the text form ``yyyy-MM-dd HH:00:00 -0500``; the hour is a
    fixed function of the order key because the test orders carry dates only.
    Orders of priority ``4-NOT SPECIFIED`` have a blank fulfilment status.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                   "o_orderdate", "o_orderpriority")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    joined = (li.join(orders, li.l_orderkey == orders.o_orderkey)
                .join(part, li.l_partkey == part.p_partkey))
    hour = F.pmod(F.col("o_orderkey") * 37, F.lit(24))
    status = (F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(""))
               .when(F.col("o_orderstatus") == "O", F.lit("unfulfilled"))
               .when(F.col("o_orderstatus") == "F", F.lit("fulfilled"))
               .otherwise(F.lit("partial")))
    # Casting the (zone-less) timestamp to text keeps its wall clock whatever
    # the session time zone is.
    created = F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit(" "),
                       F.lpad(hour.cast("string"), 2, "0"), F.lit(":00:00 -0500"))
    return typed_order_lines(joined.select(
        F.concat(F.lit("#"), F.col("o_orderkey").cast("string")).alias("order_id"),
        _email("o_custkey").alias("email"),
        status.alias("status"),
        created.alias("created_at"),
        F.col("l_quantity").cast("int").cast("string").alias("qty"),
        F.col("p_name").alias("product"),
        F.col("p_retailprice").cast("decimal(12,2)").cast("string").alias("price"),
        F.concat(F.lit("sku"), F.col("p_partkey").cast("string")).alias("sku"),
    ))


def customers_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer export columns of every customer."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    return c.join(geo, c.c_nationkey == geo.n_nationkey).select(
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        _email("c_custkey").alias("email"),
        F.col("n_name").alias("address1"),
        F.col("c_nationkey").cast("string").alias("city"),
        F.col("r_name").alias("province"),
        F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("attr12"),
    )


def customer_export_columns(customers: DataFrame) -> DataFrame:
    """Customers in the columns of the customer export, unread ones filled in, names with commas and quotes."""
    from tillroll.sources.exports import CUSTOMER_EXPORT_POSITIONS
    by_pos = {pos: F.col(name) for name, pos in CUSTOMER_EXPORT_POSITIONS.items()}
    by_pos[CUSTOMER_EXPORT_POSITIONS["address1"]] = F.concat(F.lit('12 "Old", '), "address1")
    return customers.select(*[by_pos.get(i, F.lit(_EXPORT_FILLER.get(i, ""))).alias(f"column_{i}")
                              for i in range(max(CUSTOMER_EXPORT_POSITIONS.values()) + 1)])


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment file of every customer."""
    c = table(spark, sf_dir, "customer")
    return c.select(_email("c_custkey").alias("email"), F.col("c_mktsegment").alias("segment"))


def score_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score file body lines ``email,score,score`` of every customer."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.concat_ws(",", _email("c_custkey"), F.col("c_nationkey").cast("string"),
                                F.col("c_mktsegment")).alias("line"))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site events as order lines with real times of day (one order per event)."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return e.select(
        F.concat(F.lit("#"), F.col("event_id").cast("string")).alias("order_id"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("email"),
        F.concat(F.substring(F.col("ts").cast("string"), 1, 19), F.lit(" +0000")).alias("created_at"),
    )


# Filler values for export columns the views never read; some hold commas and
# quotes so that the quote-aware parse is exercised.
_EXPORT_FILLER = {
    2: "paid",
    3: "note, with a comma",
    13: 'said "hi", twice',
}
_EXPORT_HEADER = ["Name", "Email", "Financial Status", "Notes", "Fulfillment Status"] + [
    f"Column {i}" for i in range(5, 15)] + ["Created at", "Lineitem quantity", "Lineitem name",
                                            "Lineitem price", "Column 19", "Lineitem sku"]


def _csv_field(c: F.Column) -> F.Column:
    """Quote a field only when it holds a comma or a quote (doubling quotes)."""
    c = F.coalesce(c, F.lit(""))
    needs = c.contains(",") | c.contains('"')
    quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(needs, quoted).otherwise(c)


def order_export_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines rendered as raw export CSV text (one ``value`` per line),
    with a header line."""
    return export_text_of(spark, order_lines(spark, sf_dir))


def export_text_of(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """Order lines as raw export CSV text."""
    from tillroll.sources.exports import ORDER_EXPORT_POSITIONS
    by_pos = {pos: F.col(name).cast("string") for name, pos in ORDER_EXPORT_POSITIONS.items()}
    width = max(ORDER_EXPORT_POSITIONS.values()) + 1
    fields = [_csv_field(by_pos.get(i, F.lit(_EXPORT_FILLER.get(i, "")))) for i in range(width)]
    # the text comes out of a generator, so that filters on it are not moved into the joins, where they would write it once more
    body = lines.select(F.explode(F.array(F.concat_ws(",", *fields))).alias("value"))
    header = spark.range(1).select(F.lit(",".join(_EXPORT_HEADER)).alias("value"))
    return header.unionByName(body)
