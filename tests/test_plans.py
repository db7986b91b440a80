"""What the physical plans have to look like to hold at scale."""

import contextlib
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradewind.operators import denormalize, ranking, sales
from tradewind.plans.roles import role
from tradewind.session import TASK_BYTES, tune
from tradewind.plans.tables import facts, wide
from tradewind.schemas import RAW_SCHEMAS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **values):
    values = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_only_used_columns_are_read(spark, sf_dir):
    text = plan(sales.product_sales(facts(spark, sf_dir)))
    assert "ReadSchema: struct<l_partkey:bigint,l_linenumber:int,l_extendedprice:double,l_tax:double>" in text.replace(
        "l_orderkey:bigint,", "")


def test_unused_texts_are_not_collected(spark, sf_dir):
    assert "collect_list" not in plan(sales.state_sales(facts(spark, sf_dir, "order", "customer", "payment")))


def test_filters_reach_the_scan(spark, sf_dir):
    text = plan(role(spark, sf_dir, "order_items").where("price > 1000"))
    assert "GreaterThan(l_extendedprice,1000.0)" in text


def test_top_k_is_no_global_sort(spark, sf_dir):
    text = plan(ranking.top(sales.product_sales(facts(spark, sf_dir)), "total_revenue", "product_id", 10))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_best_of_a_group_is_limited_before_the_shuffle(spark, sf_dir):
    monthly = sales.sales_by(facts(spark, sf_dir, "order"), ["product_id", "order_purchase_month"])
    text = plan(ranking.best_per_group(monthly, "order_purchase_month", "total_revenue", "product_id"))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_items_are_shuffled_once_per_key(spark, sf_dir):
    """Three joins of the items: by order, by product, by seller."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(wide(spark, sf_dir))
    # The item table is the only one with this column.
    items = [line for line in text.splitlines() if "Exchange" in line and "hashpartitioning(" in line]
    assert len([line for line in items if "hashpartitioning(product_id" in line]) == 2
    assert len([line for line in items if "hashpartitioning(seller_id" in line]) == 2


def test_the_columns_of_an_order_meet_the_items_last(spark, sf_dir):
    """They are as wide as all others together, and would be shuffled with every item for product and seller."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(wide(spark, sf_dir))
    joins = [line for line in text.splitlines() if "SortMergeJoin" in line and "LeftOuter" in line]
    assert "order_id" in joins[0] and "seller_id" in joins[1] and "product_id" in joins[2]


def test_tasks_of_relational_queries_take_bounded_shares(spark):
    advisory, partitions = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions"
    with settings(spark, **{advisory.replace(".", "__"): "64MB", partitions.replace(".", "__"): "4"}):
        tune(spark, 50 * TASK_BYTES, TASK_BYTES)
        assert (spark.conf.get(advisory), spark.conf.get(partitions)) == (f"{TASK_BYTES}b", "25")
        spark.conf.set(advisory, "1m")
        tune(spark, 50 * TASK_BYTES, TASK_BYTES)
        assert spark.conf.get(advisory) == f"{1 << 20}b"


def hot_tables(spark):
    """20,000 of 60,000 items, and of as many payments, belong to one order."""
    day = F.lit(dt.datetime(2018, 1, 5)).cast("timestamp_ntz")
    order = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("o"), F.col("id") % 5000))
    many = spark.range(0, 60_000, 1, 12)
    items = many.select(
        order.alias("order_id"), F.lit(1).alias("order_item_id"), F.concat(F.lit("product"), "id").alias("product_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("seller_id"), day.alias("shipping_limit_date"),
        F.lit(1.5).alias("price"), F.lit(0.5).alias("freight_value"))
    payments = many.select(
        order.alias("order_id"), F.col("id").cast("int").alias("payment_sequential"), F.lit("card").alias("payment_type"),
        F.lit(1).alias("payment_installments"), F.lit(0.5).alias("payment_value"))
    orders = spark.range(-1, 5000, 1, 12).select(
        F.when(F.col("id") < 0, "hot").otherwise(F.concat(F.lit("o"), "id")).alias("order_id"),
        F.concat(F.lit("c"), "id").alias("customer_id"), F.lit("delivered").alias("order_status"),
        *[day.alias(name) for name in RAW_SCHEMAS["orders"].names[3:]])
    return {"order_items": items, "orders": orders, "payments": payments}


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "100KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "100KB",
}


@pytest.mark.parametrize("parts", [["order"], ["payment"], ["order", "payment"]])
def test_the_partition_of_a_hot_order_is_split(spark, parts):
    """An order with a third of all items, joined without broadcasts."""
    with settings(spark, **SKEW):
        joined = denormalize.denormalize(hot_tables(spark), parts)
        sums = joined.groupBy().agg(F.sum("price"), F.count_distinct("seller_id"), F.count(joined.columns[-1]))
        assert tuple(sums.collect()[0]) == (90_000.0, 60_000, 60_000)
        assert "skew=true" in plan(sums)


def test_a_hot_order_is_split_in_the_join_from_orders(spark):
    tables = hot_tables(spark)
    with settings(spark, **SKEW):
        joined = denormalize._left_join_many(tables["orders"], tables["order_items"], "order_id")
        sums = joined.groupBy().agg(F.count("order_id"), F.count("price"), F.count_distinct("seller_id"))
        # The orders o0..o4999 whose number is met by an item, and the hot one.
        assert sums.collect()[0][1:] == (60_000, 60_000)
        assert "skew=true" in plan(sums)


def whole_tables(spark):
    """`hot_tables` with 20,000 products, three sellers, a customer for each order, and reviews."""
    tables = hot_tables(spark)
    tables["order_items"] = tables["order_items"].withColumns({
        "product_id": F.concat(F.lit("product"), F.col("product_id").substr(8, 9).cast("long") % 25_000),
        "seller_id": F.element_at(F.array(F.lit("s1"), F.lit("s2"), F.lit("s3"), F.lit("none"), F.lit(None)),
                                  F.pmod(F.xxhash64("seller_id"), F.lit(5)).cast("int") + 1)})
    text = F.sha2(F.col("id").cast("string"), 512)
    products = spark.range(20_000).select(
        F.concat(F.lit("product"), "id").alias("product_id"), text.alias("product_category_name"),
        *[F.rand(seed).alias(name) for seed, name in enumerate(RAW_SCHEMAS["products"].names[2:])])
    return tables | {
        "products": products,
        "category_translation": spark.createDataFrame([("a", "b")], "product_category_name string, product_category_name_english string"),
        "sellers": spark.createDataFrame([(f"s{i}", i, f"city {i}", "x") for i in (1, 2, 3)], RAW_SCHEMAS["sellers"].simpleString()),
        "customers": spark.range(-1, 4000).select(
            F.concat(F.lit("c"), "id").alias("customer_id"), text.alias("customer_unique_id"), F.lit(1).alias("customer_zip_code_prefix"),
            F.lit("city").alias("customer_city"), F.lit("x").alias("customer_state")),
        "reviews": spark.range(0, 6000, 1, 4).select(
            F.concat(F.lit("o"), F.col("id") % 5500).alias("order_id"), (F.col("id") % 5).cast("int").alias("review_score"),
            F.lit("title").alias("review_comment_title"), text.alias("review_comment_message")),
    }


def test_nothing_else_is_shuffled_with_the_items_of_a_whole_table(spark):
    """The shuffles of customers, payments and reviews are over by then, and small sellers are met last, without one."""
    tables = whole_tables(spark)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="100KB"):
        whole = denormalize.denormalize(tables, whole=True)
        text = plan(whole)
        plain = denormalize.denormalize(tables)
        assert whole.columns == plain.columns
        ours, theirs = (sorted(map(str, df.collect())) for df in (whole, plain))
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line]
    assert len(exchanges) == 4
    assert len([line for line in exchanges if "(product_id" in line]) == len([line for line in exchanges if "(order_id" in line]) == 2
    joins = [line for line in text.splitlines() if "Join" in line]
    assert "BroadcastHashJoin" in joins[0] and "seller_id" in joins[0] and "order_id" in joins[1] and "product_id" in joins[2]
    assert ours == theirs


def test_columns_of_a_whole_table_can_be_left_out(spark):
    wide = denormalize.denormalize(whole_tables(spark), whole=True, without=["review_comment_title"])
    assert "review_comment_title" not in wide.columns and "review_comment_message" in wide.columns


def test_a_large_side_of_a_whole_table_meets_the_items_before_their_orders(spark):
    with settings(spark, **SKEW):
        joined = denormalize.denormalize(whole_tables(spark), whole=True)
        sums = joined.groupBy().agg(F.sum("price"), F.count_distinct("product_category_name"), F.count("payment_type"))
        assert tuple(sums.collect()[0]) == (90_000.0, 20_000, 60_000)
        text = plan(sums)
    joins = [line for line in text.splitlines() if "SortMergeJoin" in line]
    assert "order_id" in joins[0] and "skew=true" in text
