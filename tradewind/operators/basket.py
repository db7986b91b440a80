"""Products bought together: the most common pairs.

Two products of an order are a pair, in id order; a product that stands on several
lines of an order is also a pair with itself. An order counts once for each of its
pairs.

Counting every pair of every order would be quadratic in the size of an order. The
result holds only the k most common pairs, and three exact bounds leave out pairs
that cannot be among them:

* a pair is in at most as many orders as the rarer of its products. The k-th count
  among the most frequent products is a floor for the result, and products with fewer
  orders than the floor take no part;
* an order counts once per pair. The few very large orders therefore add at most their
  own number to a pair. Their pairs are not listed: what they add is looked up for
  pairs that the other orders contain;
* pairs found in large orders alone matter only where the floor is not above the
  number of large orders, and then only among products that so many of them contain.
  These are listed in blocks of products, so that no task lists a whole order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.ranking import top
from tradewind.sources.staging import stage

PAIR = ["product_a", "product_b"]


def most_common_pairs(
    df: DataFrame, k: int = 10, order: str = "order_id", product: str = "product_id",
    large_order: int = 1000, probes: int = 100,
) -> DataFrame:
    """The k most common pairs: product_a, product_b, count; ties in id order."""
    lines = stage(
        df.where(F.col(order).isNotNull() & F.col(product).isNotNull())
        .groupBy(F.col(order).alias("order"), F.col(product).alias("product"))
        .agg(F.count("*").alias("copies")), "lines")
    support = stage(
        lines.groupBy("product").agg(F.count("*").alias("orders"), F.count_if(F.col("copies") > 1).alias("repeats")),
        "support")
    with_itself = support.where("repeats > 0").select(
        F.col("product").alias("product_a"), F.col("product").alias("product_b"), F.col("repeats").alias("count"))

    leaders = top(support, "orders", "product", probes).select("product")
    probed = _counted(_pairs(lines.join(F.broadcast(leaders), "product", "left_semi")))  # `probes` rows
    best = top(with_itself.unionByName(probed), "count", PAIR, k).collect()
    floor = best[-1]["count"] if len(best) == k else 1

    if not support.where(F.col("orders") < floor).isEmpty():
        lines = lines.join(support.where(F.col("orders") >= floor), "product", "left_semi")
    large = lines.groupBy("order").agg(F.count("*").alias("size")).where(F.col("size") > large_order)
    large_orders = large.count()
    if not large_orders:
        return top(with_itself.unionByName(_counted(_pairs(lines))), "count", PAIR, k)

    large = stage(large, "large")
    in_large = stage(lines.join(large, "order"), "in_large")
    normal = stage(_counted(_pairs(lines.join(large, "order", "left_anti"))), "pairs")
    totals = _with_large_orders(normal, in_large, floor)
    if large_orders >= floor:
        totals = totals.unionByName(_pairs_of_large_orders(in_large, floor, large_order)
                                    .join(normal, PAIR, "left_anti"))
    return top(with_itself.unionByName(totals), "count", PAIR, k)


def _pairs(lines: DataFrame) -> DataFrame:
    first = lines.select("order", F.col("product").alias("product_a"))
    second = lines.select("order", F.col("product").alias("product_b"))
    return first.join(second, "order").where("product_a < product_b")


def _counted(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(*PAIR).agg(F.count("*").alias("count"))


def _with_large_orders(normal: DataFrame, in_large: DataFrame, floor: int) -> DataFrame:
    """Add what the large orders contribute to pairs that can still reach the floor."""
    reach = stage(in_large.groupBy("product").agg(F.count("*").alias("reach")), "reach")
    bounded = (
        normal.join(reach.withColumnsRenamed({"product": "product_a", "reach": "_a"}), "product_a", "left")
        .join(reach.withColumnsRenamed({"product": "product_b", "reach": "_b"}), "product_b", "left")
        .na.fill(0, subset=["_a", "_b"])
        .where(F.col("count") + F.least("_a", "_b") >= floor)
    )
    holds = in_large.select("order", "product")
    extra = (
        bounded.where(F.least("_a", "_b") > 0).select(*PAIR)
        .join(holds.withColumnRenamed("product", "product_a"), "product_a")
        .join(holds.withColumnRenamed("product", "product_b"), ["order", "product_b"])
        .groupBy(*PAIR).agg(F.count("*").alias("_extra"))
    )
    return bounded.join(extra, PAIR, "left").select(
        *PAIR, (F.col("count") + F.coalesce("_extra", F.lit(0))).alias("count"))


def _pairs_of_large_orders(in_large: DataFrame, floor: int, block_size: int) -> DataFrame:
    reach = in_large.groupBy("product").agg(F.count("*").alias("reach")).where(F.col("reach") >= floor)
    blocks = F.ceil(F.col("size") / block_size)
    lines = in_large.join(reach, "product", "left_semi").withColumns({
        "_block": F.pmod(F.xxhash64("product"), blocks),
        "_other": F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)),
    })
    first = lines.select("order", F.col("product").alias("product_a"), F.col("_block").alias("_i"),
                         F.col("_other").alias("_j"))
    second = lines.select("order", F.col("product").alias("product_b"), F.col("_other").alias("_i"),
                          F.col("_block").alias("_j"))
    return _counted(first.join(second, ["order", "_i", "_j"]).where("product_a < product_b"))
