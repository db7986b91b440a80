import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradewind.operators import denormalize as d
from tradewind.operators import sales
from tradewind.operators.clean import with_item_revenue
from tradewind.schemas import RAW_SCHEMAS

DAY = dt.datetime(2018, 1, 5, 10)


@pytest.fixture
def tables(spark):
    data = {
        "order_items": [("o1", 1, "p1", "s1", DAY, 10.0, 1.0), ("o1", 2, "p1", "s1", DAY, 10.0, 1.0),
                        ("o1", 3, "p2", "s1", DAY, 10.0, None), ("o2", 1, "p3", "s9", DAY, 5.0, 0.5)],
        "orders": [("o1", "c1", "delivered", DAY, DAY, DAY, DAY, DAY)],
        "customers": [("c1", "u1", 100, "Town", "SP")],
        "sellers": [("s1", 200, "City", "RJ")],
        "products": [("p1", "moveis", *[1.0] * 7), ("p2", None, *[None] * 7)],
        "category_translation": [("moveis", "furniture")],
        "payments": [("o1", 2, "voucher", 1, 40.0), ("o1", 1, "card", 3, 60.0), ("o2", 1, "cash", 1, 5.5)],
        "reviews": [("o1", 4, None, "good"), ("o1", 1, None, None), ("o2", None, "t", None)],
        "geolocation": [(100, -10.0, 20.0), (100, -20.0, 30.0), (300, 0.0, 0.0)],
    }
    return {name: spark.createDataFrame(rows, RAW_SCHEMAS[name]) for name, rows in data.items()}


def test_wide_table(tables, rows):
    wide = d.denormalize(tables)
    assert len(wide.columns) == 41
    columns = ("order_id", "order_item_id", "product_category_name_english", "customer_state", "customer_lat",
               "seller_lat", "payment_sequential", "payment_type", "payment_value", "review_score",
               "review_comment_title", "review_comment_message")
    assert rows(wide, *columns) == [
        ("o1", 1, "furniture", "SP", -15.0, None, 2, "card, voucher", 100.0, 2.5, "nan, nan", "good, nan"),
        ("o1", 2, "furniture", "SP", -15.0, None, 2, "card, voucher", 100.0, 2.5, "nan, nan", "good, nan"),
        ("o1", 3, None, "SP", -15.0, None, 2, "card, voucher", 100.0, 2.5, "nan, nan", "good, nan"),
        # An order that is missing in `orders` keeps its payments and reviews.
        ("o2", 1, None, None, None, None, 1, "cash", 5.5, None, "t", None),
    ]


def test_money_fans_out_over_items_unless_counted_per_order(tables, rows):
    wide = with_item_revenue(d.denormalize(tables))
    assert rows(sales.sales_by(wide, "customer_state", "payment_value")) == [("SP", 300.0)]
    assert rows(sales.sales_by(wide, "customer_state", "payment_value", grain="order", items="n")) == [("SP", 100.0, 3)]


def test_joined_text_of_many_rows_is_in_order(spark):
    payments = spark.createDataFrame(
        [("o", i, f"t{i}", 1, 0.1) for i in range(1, 3502)], RAW_SCHEMAS["payments"]).repartition(7)
    row = d.payments_rollup(payments).first()
    assert row["payment_type"] == ", ".join(f"t{i}" for i in range(1, 3502))
    assert (row["payment_sequential"], row["payment_installments"], row["payment_value"]) == (3501, 3501, 350.1)


def test_only_known_zips(tables, rows):
    known = d.only_known_zips(tables["geolocation"], tables["customers"], "customer_zip_code_prefix")
    assert rows(known, "geolocation_zip_code_prefix") == [(100,), (100,)]


def test_rebuilt_table_keeps_every_combination(tables, rows):
    joined = d.join_from_orders(tables)
    assert joined.count() == 3 * 2 * 2
    median = d.rebuild_wide(tables, "median")
    assert rows(median.where("order_item_id = 3"), "freight_value", "product_category_name",
                "product_category_name_english", "review_comment_message").count(
        (1.0, "unknown", "nan", "good")) == 2
    zero = d.rebuild_wide(tables, "zero")
    assert rows(zero.where("order_item_id = 3"), "item_total_revenue") == [(10.0,)] * 4
    with pytest.raises(ValueError):
        d.rebuild_wide(tables, "mean")


def rebuilt_by_hand(tables, fill):
    """Join, fill, drop, deduplicate, in this order."""
    from pyspark.sql import functions as F

    from tradewind.operators import clean

    table = d.join_from_orders(tables)
    if fill == "zero":
        table = clean.fill_constants(table, {"price": 0.0, "freight_value": 0.0})
        return with_item_revenue(table).na.drop(subset=["order_purchase_timestamp", "item_total_revenue"]).dropDuplicates()
    medians = table.agg(*[F.median(F.col(name).cast("double")).alias(name) for name in d.REBUILT_NUMBERS]).first()
    table = table.withColumn(
        "product_category_name_english", F.coalesce("product_category_name_english", "product_category_name"))
    table = table.withColumns({
        name: F.coalesce(F.col(name).cast("double"), F.lit(medians[name]).cast("double")) for name in d.REBUILT_NUMBERS})
    table = clean.fill_constants(table, {
        "review_comment_message": "no_comment", "review_comment_title": "no_comment", "payment_type": "unknown",
        "order_status": "unknown", "product_category_name": "unknown"})
    table = with_item_revenue(table).na.drop(
        subset=["order_id", "customer_id", "order_purchase_timestamp", "item_total_revenue"]).dropDuplicates()
    return table.withColumns({name: d.normalized(name, missing_word="nan") for name in d.REBUILT_TEXT})


def odd_tables(spark):
    """Repeated rows in every table, orders without children, children without orders, rows that are equal once filled."""
    import random

    rng = random.Random(6)
    orders = [(f"o{i}", f"c{i % 7}", rng.choice(["delivered", None]), rng.choice([DAY, DAY, None]), DAY, DAY, DAY, DAY) for i in range(30)]
    items = [(f"o{rng.randint(0, 34)}", rng.randint(1, 2), f"p{rng.randint(0, 4)}", f"s{rng.randint(0, 2)}", DAY,
              rng.choice([None, 1.0, 2.0, 9.0]), rng.choice([None, 0.5])) for _ in range(90)]
    payments = [(f"o{rng.randint(0, 34)}", rng.choice([None, 1, 2]), rng.choice([None, "unknown", "card"]), 1, rng.choice([None, 3.0, 8.0, 40.0]))
                for _ in range(80)]
    reviews = [(f"o{rng.randint(0, 34)}", rng.choice([None, 1, 5]), rng.choice([None, "no_comment"]), None) for _ in range(60)]
    data = {
        "order_items": items + items[:5] + [(None, 1, "p1", "s1", DAY, 1.0, 1.0)], "orders": orders + orders[:3] + [(None, "c1", "x", DAY, DAY, DAY, DAY, DAY)],
        "customers": [(f"c{i}", f"u{i}", i, "Town", "SP") for i in range(6)] + [("c0", "u0", 0, "Town", "SP")],
        "sellers": [("s1", 200, " City", "RJ")], "products": [("p1", "moveis", *[1.0] * 7), ("p1", "moveis", *[1.0] * 7), ("p2", None, *[None] * 7), ("p3", "x", *[2.0] * 7)],
        "category_translation": [("moveis", "furniture")], "payments": payments + payments[:4], "reviews": reviews + reviews[:4],
    }
    return {name: spark.createDataFrame(rows, RAW_SCHEMAS[name]) for name, rows in data.items()}


@pytest.mark.parametrize("fill", ["median", "zero"])
@pytest.mark.parametrize("slice_rows", [d.SLICE_ROWS, 4])
def test_rebuilt_table_equals_the_one_built_the_long_way(spark, monkeypatch, fill, slice_rows):
    monkeypatch.setattr(d, "SLICE_ROWS", slice_rows)
    tables = odd_tables(spark)
    got, expected = d.rebuild_wide(tables, fill), rebuilt_by_hand(tables, fill)
    assert set(got.columns) == set(expected.columns)
    names = sorted(got.columns)
    assert sorted(map(str, got.select(names).collect())) == sorted(map(str, expected.select(names).collect()))


def test_large_fan_out_is_built_once_without_an_exchange_above_it(spark, monkeypatch):
    """An order with 300 items, payments and reviews: 27 million rows, in slices."""
    from pyspark.sql import functions as F

    n = 300
    day = F.lit(DAY).cast("timestamp_ntz")
    one = spark.range(1)
    tables = {
        "orders": one.select(F.lit("o").alias("order_id"), F.lit("c").alias("customer_id"), F.lit("x").alias("order_status"),
                             *[day.alias(name) for name in RAW_SCHEMAS["orders"].names[3:]]),
        "customers": spark.createDataFrame([("c", "u", 1, "Town", "SP")], RAW_SCHEMAS["customers"]),
        "sellers": spark.createDataFrame([("s", 200, "City", "RJ")], RAW_SCHEMAS["sellers"]),
        "products": spark.createDataFrame([("p", "moveis", *[1.0] * 7)], RAW_SCHEMAS["products"]),
        "category_translation": spark.createDataFrame([("moveis", "furniture")], RAW_SCHEMAS["category_translation"]),
        "order_items": spark.range(n).select(
            F.lit("o").alias("order_id"), F.col("id").cast("int").alias("order_item_id"), F.lit("p").alias("product_id"),
            F.lit("s").alias("seller_id"), day.alias("shipping_limit_date"), F.col("id").cast("double").alias("price"), F.lit(0.5).alias("freight_value")),
        "payments": spark.range(n).select(
            F.lit("o").alias("order_id"), F.col("id").cast("int").alias("payment_sequential"), F.lit("card").alias("payment_type"),
            F.lit(1).alias("payment_installments"), F.lit(None).cast("double").alias("payment_value")),
        "reviews": spark.range(n).select(
            F.lit("o").alias("order_id"), (F.col("id") % 5).cast("int").alias("review_score"), F.col("id").cast("string").alias("review_comment_title"),
            F.lit(None).cast("string").alias("review_comment_message")),
    }
    wide = d.rebuild_wide(tables, "median")
    text = wide._jdf.queryExecution().executedPlan().toString()
    # From the top down to the last join there is no shuffle.
    assert "Exchange" not in text.split("Join")[0]
    assert wide.select("price", "review_comment_title").agg(F.count("*"), F.sum("price")).first()[:] == (n ** 3, sum(range(n)) * 1.0 * n * n)


def test_payments_and_reviews_roll_up_side_by_side(spark):
    """Orders with one of both or none, more rows than a chunk, and texts that are missing."""
    payments = spark.createDataFrame(
        [("a", 2, "card", 1, 0.5), ("a", 1, None, 2, 1.5), ("b", 1, "cash", None, None), (None, 1, "card", 1, 1.0)]
        + [("long", i, f"t{i}", 1, 1.0) for i in range(2500)],
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double")
    reviews = spark.createDataFrame(
        [("a", 3, "good", None, 1), ("a", 4, None, "note", 0), ("c", 5, None, None, 0), ("d", None, "bad", "x", None)],
        "order_id string, review_score int, review_comment_title string, review_comment_message string, at int")
    for few in (payments.where("order_id <> 'long'"), payments):
        for known in (reviews.where("at IS NOT NULL"), reviews):
            apart = d.payments_rollup(few).join(d.reviews_rollup(known, sequence="at"), "order_id", "full")
            got = d.payments_and_reviews_rollup(few, known, "at")
            assert got.columns == apart.columns
            assert sorted(map(str, got.collect())) == sorted(map(str, apart.collect()))


def test_rows_to_roll_up_are_shuffled_as_they_are(tables):
    """Lists and sums of a few rows each, which is what a task makes of an unsorted table, are wider than these."""
    rolled = d.payments_and_reviews_rollup(tables["payments"], tables["reviews"])
    before = rolled._jdf.queryExecution().executedPlan().toString().split("Exchange ")
    assert len(before) == 2 and "Aggregate" not in before[1]


@pytest.fixture
def small_tables(spark, tmp_path):
    """An order with three items, payments and reviews, and one with none of them."""
    day = dt.datetime(2018, 1, 5)
    tables = {
        "nation": ([(1, "PERU")], "n_nationkey int, n_name string"),
        "customer": ([(1, 1, "AUTO")], "c_custkey bigint, c_nationkey int, c_mktsegment string"),
        "supplier": ([(1, "one", 1, 2.0)], "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
        "part": ([(1, "a part", "SMALL", 3, 2.5)], "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double"),
        "orders": ([(1, 1, "F", day), (2, 1, "P", day)], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz"),
        "lineitem": (
            [(1, 1, 1, line, 1.0, 10.0 * line, 0.0, 0.1, "R", "O", day) for line in (1, 2, 3)],
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
            " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    }
    for name, (values, schema) in tables.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_the_rebuilt_table_has_every_payment_and_review(spark, small_tables):
    from tradewind.plans.tables import fallback_wide

    found = fallback_wide(spark, small_tables)
    assert found.groupBy("order_id").count().orderBy("order_id").collect() == [(1, 27), (2, 1)]
    one = found.where("order_id = 1")
    # No two payments of one type are one, and no two reviews.
    assert one.select("payment_sequential", "payment_value").distinct().count() == 3
    assert one.select("review_score", "review_comment_message").distinct().count() == 3
    assert "review_sequence" not in found.columns


def test_missing_values_are_counted_in_all_columns_of_the_wide_table(spark, small_tables):
    from tradewind.plans.tables import null_profile, wide

    lines = spark.read.parquet(f"{small_tables}/lineitem.parquet")
    lines.unionByName(lines.withColumn("l_suppkey", F.lit(9).cast("bigint"))).write.parquet(f"{small_tables}/twice/lineitem.parquet")
    for name in ("nation", "customer", "supplier", "part", "orders"):
        spark.read.parquet(f"{small_tables}/{name}.parquet").write.parquet(f"{small_tables}/twice/{name}.parquet")
    found = dict(map(tuple, null_profile(spark, f"{small_tables}/twice").collect()))
    assert list(found) == wide(spark, f"{small_tables}/twice", geolocation=True).columns and len(found) == 41
    missing = {name for name, count in found.items() if count}
    assert missing == {"seller_zip_code_prefix", "seller_city", "seller_state", "seller_lat", "seller_lng"}
    assert found["seller_city"] == found["seller_lat"] == 3
