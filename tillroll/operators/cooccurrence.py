"""Co-occurrence counting: how many baskets hold both items of a pair.

The count for a pair is the size of the intersection of the two items' basket
sets.  The rows are made distinct first (map-side, so copies collapse before the
shuffle), which makes each (basket, item_1, item_2) unique: a plain count of
pairs is the distinct-basket count, and it aggregates map-side before its shuffle.

Light baskets, of at most ``block`` items and so nearly all, are gathered into one
sorted array each on the basket's partitioning, and their pairs are expanded from it
in place: no self-join, and no array above ``block`` items.

The work inside a basket is quadratic, so only heavy baskets are cut, into parts of
about ``block`` items, and joined with themselves part by part: every two parts of a
basket meet on a key of their own, (basket, part, part).  A task then holds at most
about ``block`` items of each side, whatever the basket's size; none is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_items(baskets: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """One row per basket and item.  Rows with a null key or item are in no pair; saying so here keeps
    all readers of the result alike, so that they share one scan and one shuffle."""
    known = baskets.select(*keys, item)
    for c in (*keys, item):
        known = known.where(F.col(c).isNotNull())
    return known.distinct()


def heavy_baskets(dedup: DataFrame, keys: Sequence[str], block: int) -> DataFrame:
    """(keys..., n_parts) of the baskets with more than ``block`` items."""
    return (dedup.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_items")).where(F.col("n_items") > block)
            .select(*keys, F.ceil(F.col("n_items") / block).cast("int").alias("n_parts")))


def basket_arrays(dedup: DataFrame, heavy: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """(keys..., items): the light baskets, each as the sorted array of its items."""
    light = dedup.join(heavy.select(*keys), list(keys), "left_anti")
    return light.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("items"))


def blocked(dedup: DataFrame, heavy: DataFrame, keys: Sequence[str], item: str, first: str, second: str) -> tuple[DataFrame, DataFrame]:
    """The heavy baskets' rows as left and right sides: a row meets every part from its own on (left) or
    up to its own (right), so that two parts meet once in each order of their items."""
    sized = dedup.join(heavy, list(keys)).withColumn("part", F.pmod(F.xxhash64(item), F.col("n_parts")).cast("int"))
    left = sized.select(*keys, F.col("part").alias("left_part"), F.explode(F.expr("sequence(0, n_parts - 1)")).alias("right_part"), F.col(item).alias(first))
    right = sized.select(*keys, F.explode(F.expr("sequence(0, n_parts - 1)")).alias("left_part"), F.col("part").alias("right_part"), F.col(item).alias(second))
    return left, right


def pair_counts(baskets: DataFrame, basket_keys: Sequence[str], item: str, *,
                group_keys: Sequence[str] = (), first: str = "product_1",
                second: str = "product_2", count: str = "n_orders",
                block: int = 256) -> DataFrame:
    """Count baskets per unordered item pair (``first < second``).

    ``baskets`` holds one row per (basket_keys..., item); duplicates are removed
    here.  ``group_keys`` (a subset of ``basket_keys``) are kept in the output.
    """
    keys = list(basket_keys)
    dedup = distinct_items(baskets, keys, item)
    heavy = heavy_baskets(dedup, keys, block)
    pairs = F.expr("flatten(transform(items, (x, i) -> transform(slice(items, i + 2, size(items)), y -> struct(x, y))))")
    light = (basket_arrays(dedup, heavy, keys, item).where("size(items) > 1").select(*group_keys, F.explode(pairs).alias("pair"))
             .select(*group_keys, F.col("pair.x").alias(first), F.col("pair.y").alias(second)))
    left, right = blocked(dedup, heavy, keys, item, first, second)
    cut = left.join(right, [*keys, "left_part", "right_part"]).where(F.col(first) < F.col(second)).select(*group_keys, first, second)
    return light.unionByName(cut).groupBy(*group_keys, first, second).agg(F.count(F.lit(1)).alias(count))


def basket_sets(baskets: DataFrame, keys: Sequence[str], item: str, block: int = 256) -> DataFrame:
    """(keys..., n_parts, part, piece, items): every basket as sorted arrays of its distinct items, none longer than
    ``block``.  A light basket is one array; a heavy one is gathered by (basket, part), so none of it meets elsewhere."""
    dedup = distinct_items(baskets, keys, item)
    heavy = heavy_baskets(dedup, keys, block)
    light = basket_arrays(dedup, heavy, keys, item).select(*keys, F.lit(1).alias("n_parts"), F.lit(0).alias("part"), "items")
    parted = dedup.join(heavy, list(keys)).withColumn("part", F.pmod(F.xxhash64(item), F.col("n_parts")).cast("int"))
    large = parted.groupBy(*keys, "n_parts", "part").agg(F.array_sort(F.collect_list(item)).alias("items"))
    pieces = light.unionByName(large).withColumn("piece", F.explode(F.expr(f"sequence(0, cast((size(items) - 1) div {block} as int))")))
    return pieces.select(*keys, "n_parts", "part", "piece", F.expr(
        f"if(size(items) <= {block}, items, slice(items, piece * {block} + 1, {block}))").alias("items"))


def set_pairs(sets: DataFrame, keys: Sequence[str], kept: Sequence[str], first: str, second: str) -> DataFrame:
    """(kept..., first, second): every pair of items of a basket once, from its arrays (``basket_sets``): pairs inside
    an array in place, pairs of a heavy basket's arrays by a join in which every two parts have their own key."""
    inside = sets.where("size(items) > 1").select(*kept, F.expr(
        "flatten(transform(items, (x, i) -> transform(slice(items, i + 2, size(items)), y -> struct(x, y))))").alias("pairs"))
    heavy = sets.where("n_parts > 1")
    left = heavy.select(*keys, F.col("part").alias("lo"), F.explode(F.expr("sequence(part, n_parts - 1)")).alias("hi"),
                        F.col("piece").alias("left_piece"), F.col("items").alias("left_items"))
    right = heavy.select(*keys, F.explode(F.expr("sequence(0, part)")).alias("lo"), F.col("part").alias("hi"), "piece", "items")
    across = left.join(right, [*keys, "lo", "hi"]).where("lo < hi or left_piece < piece").select(*kept, F.expr(
        "flatten(transform(left_items, x -> transform(items, y -> struct(least(x, y) as x, greatest(x, y) as y))))").alias("pairs"))
    pairs = inside.unionByName(across).select(*kept, F.explode("pairs").alias("pair"))
    return pairs.select(*kept, F.col("pair.x").alias(first), F.col("pair.y").alias(second))
