"""Products bought together, overall and per calendar month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.calendar import month_start
from tillroll.operators import bitsets
from tillroll.operators.cooccurrence import basket_sets, distinct_items, pair_counts, set_pairs
from tillroll.operators.numbering import number_rows
from tillroll.plans._common import purchase_date


def bought_together(lines: DataFrame, sort: bool = True) -> DataFrame:
    """product_1 < product_2 and the number of distinct orders holding both.

    Pairs that never share an order do not appear.  Sorted by count descending
    (ties by product names) when ``sort``.
    """
    out = pair_counts(lines.select("order_id", "product"), ["order_id"], "product")
    out = out.select("product_1", "product_2", "n_orders")
    if sort:
        out = out.orderBy(F.desc("n_orders"), "product_1", "product_2")
    return out


def bought_together_monthly(lines: DataFrame, sort: bool = True) -> DataFrame:
    """Like ``bought_together`` within the calendar month of the order line."""
    baskets = lines.select("order_id", month_start(purchase_date(lines)).alias("month"),
                           "product")
    out = pair_counts(baskets, ["order_id", "month"], "product", group_keys=["month"])
    out = out.select("month", "product_1", "product_2", "n_orders")
    if sort:
        out = out.orderBy(F.desc("n_orders"), "month", "product_1", "product_2")
    return out


def bought_together_basket_arrays(lines: DataFrame, block: int = 256) -> DataFrame:
    """``bought_together`` unsorted, by gathering each order's products into bounded arrays first."""
    sets = basket_sets(lines.select("order_id", "product"), ["order_id"], "product", block)
    pairs = set_pairs(sets, ["order_id"], [], "product_1", "product_2")
    return pairs.groupBy("product_1", "product_2").agg(F.count(F.lit(1)).alias("n_orders"))


def shared_orders(lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """product_1, product_2, n_orders for given ``pairs`` of products: how many distinct orders hold both, 0 included.

    Orders are numbered once, in a table written when this is called; a product's orders are a bit set of 64 numbers a word.  A pair's words meet on
    (product, word) and are intersected bit by bit, so no set of orders is ever one value.
    """
    wanted = pairs.select("product_1", "product_2").distinct()
    named = wanted.select(F.explode(F.array("product_1", "product_2")).alias("product")).distinct()
    held = distinct_items(lines, ["order_id"], "product").join(named, "product", "left_semi")
    numbers = number_rows(held.select(F.col("order_id").alias("numbered_order")).distinct(), ["numbered_order"], "order_no")
    sets = bitsets.packed(held.join(numbers, F.col("order_id") == F.col("numbered_order")), ["product"], "order_no")
    sizes = bitsets.intersection_sizes(sets, wanted, "product", "product_1", "product_2", "n_orders")
    return (wanted.join(sizes, ["product_1", "product_2"], "left")
            .select("product_1", "product_2", F.coalesce("n_orders", F.lit(0)).cast("long").alias("n_orders")))
