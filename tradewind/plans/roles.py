"""The test tables in the roles of the raw retail tables.

A role is a list of SQL expressions over one table. The same list makes the DataFrame
and the common table expression of the comparison query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# role: (FROM clause, select list)
ROLES: dict[str, tuple[str, list[str]]] = {
    "order_items": ("lineitem", [
        "l_orderkey AS order_id",
        "l_linenumber AS order_item_id",
        "l_partkey AS product_id",
        "l_suppkey AS seller_id",
        "l_shipdate AS shipping_limit_date",
        "l_extendedprice AS price",
        "l_extendedprice * l_tax AS freight_value",
    ]),
    "orders": ("orders", [
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "CASE o_orderstatus WHEN 'P' THEN 'canceled' WHEN 'F' THEN 'delivered' ELSE ' Shipped' END AS order_status",
        "o_orderdate AS order_purchase_timestamp",
        "CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderdate + INTERVAL '1' DAY END AS order_approved_at",
        "CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderdate + INTERVAL '3' DAY END"
        " AS order_delivered_carrier_date",
        "CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderdate + INTERVAL '9' DAY END"
        " AS order_delivered_customer_date",
        "o_orderdate + INTERVAL '20' DAY AS order_estimated_delivery_date",
    ]),
    "customers": ("customer JOIN nation ON c_nationkey = n_nationkey", [
        "c_custkey AS customer_id",
        "c_custkey AS customer_unique_id",
        "c_nationkey AS customer_zip_code_prefix",
        "n_name || '-' || c_mktsegment AS customer_city",
        "n_name AS customer_state",
    ]),
    "sellers": ("supplier JOIN nation ON s_nationkey = n_nationkey", [
        "s_suppkey AS seller_id",
        "s_nationkey AS seller_zip_code_prefix",
        "s_name AS seller_city",
        "n_name AS seller_state",
    ]),
    "products": ("part", [
        "p_partkey AS product_id",
        "CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE p_type END AS product_category_name",
        "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(length(p_name) AS DOUBLE) END AS product_name_lenght",
        "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_retailprice END AS product_description_lenght",
        "CAST(p_size % 6 AS DOUBLE) AS product_photos_qty",
        "CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE CAST(p_size - 1 AS DOUBLE) END AS product_weight_g",
        "CAST(p_size % 7 AS DOUBLE) AS product_length_cm",
        "CAST(p_size + 2 AS DOUBLE) AS product_height_cm",
        "CAST(p_size % 11 AS DOUBLE) AS product_width_cm",
    ]),
    # LARGE has no translation.
    "category_translation": (
        "(VALUES ('ECONOMY', 'Budget '), ('MEDIUM', ' Medium'), ('PROMO', 'promo'), ('SMALL', 'small'),"
        " ('STANDARD', 'standard')) AS names(product_category_name, product_category_name_english)",
        ["product_category_name", "product_category_name_english"]),
    "payments": ("lineitem", [
        "l_orderkey AS order_id",
        "l_linenumber AS payment_sequential",
        "l_returnflag AS payment_type",
        "CAST(l_quantity AS INT) AS payment_installments",
        "l_extendedprice * (1 - l_discount) AS payment_value",
    ]),
    "reviews": ("lineitem", [
        "l_orderkey AS order_id",
        "CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE CAST(1 + (l_orderkey * 7 + l_linenumber) % 5 AS INT) END"
        " AS review_score",
        "CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE 'Title ' || l_returnflag END AS review_comment_title",
        "CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN NULL ELSE 'note ' || l_linestatus || l_returnflag END"
        " AS review_comment_message",
        "l_linenumber AS review_sequence",
    ]),
    "geolocation": ("supplier", [
        "s_nationkey AS geolocation_zip_code_prefix",
        "s_acctbal AS geolocation_lat",
        "s_acctbal / -4 AS geolocation_lng",
    ]),
    # One payment per order and type, one review per order, for a join of fewer combinations than that of the raw children.
    "payments_by_type": ("lineitem GROUP BY l_orderkey, l_returnflag", [
        "l_orderkey AS order_id",
        "CAST(min(l_linenumber) AS INT) AS payment_sequential",
        "l_returnflag AS payment_type",
        "CAST(max(l_quantity) AS INT) AS payment_installments",
        "max(l_extendedprice) AS payment_value",
    ]),
    "reviews_by_order": ("lineitem GROUP BY l_orderkey", [
        "l_orderkey AS order_id",
        "CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE CAST(1 + max(l_orderkey * 7 + l_linenumber) % 5 AS INT) END"
        " AS review_score",
        "CASE WHEN max(l_linestatus) = 'O' THEN NULL ELSE 'Title ' || max(l_linestatus) END AS review_comment_title",
        "CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE 'note ' || max(l_returnflag) END AS review_comment_message",
    ]),
    "visits": ("events", [
        "event_id", "user_id", "ts AS order_purchase_timestamp", "event_type", "value",
    ]),
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A role as a DataFrame."""
    source, columns = ROLES[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if t in source.replace("(", " ").split()}
    for used_name in used:
        source = " ".join(f"{{{used_name}}}" if word == used_name else word for word in source.split(" "))
    return spark.sql(f"SELECT {', '.join(columns)} FROM {source}", **used)


def roles(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {name: role(spark, sf_dir, name) for name in names}


def role_cte(name: str) -> str:
    """A role as a common table expression. `orders` is the name of a role and of a table."""
    source, columns = ROLES[name]
    return f"r_{name} AS (SELECT {', '.join(columns)} FROM {source})"
