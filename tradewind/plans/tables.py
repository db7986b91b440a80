"""Registered queries: sources, joins, profiles and cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators import clean, denormalize, profile
from tradewind.operators.timeseries import daily_sales
from tradewind.plans.registry import define, dsum, query
from tradewind.plans.roles import role, roles, table
from tradewind.schemas import RAW_SCHEMAS
from tradewind.sources import stage, write_csv
from tradewind.sources.staging import new_path
from tradewind.sources.tables import read_csv

_PART_ROLES = {
    "product": ("products", "category_translation"), "order": ("orders",), "customer": ("customers",),
    "seller": ("sellers",), "payment": ("payments",), "review": ("reviews",),
}


def wide(spark: SparkSession, sf_dir: str, parts: Sequence[str] = denormalize.PARTS,
         geolocation: bool = False, revenue: bool = False, whole: bool = False, without: Sequence[str] = ()) -> DataFrame:
    names = ["order_items", *[name for part in parts for name in _PART_ROLES[part]]]
    if geolocation:
        names.append("geolocation")
    tables = roles(spark, sf_dir, *names)
    if revenue:
        tables["order_items"] = clean.with_item_revenue(tables["order_items"])
    return denormalize.denormalize(tables, parts, review_sequence="review_sequence", whole=whole, without=without)


def facts(spark: SparkSession, sf_dir: str, *parts: str) -> DataFrame:
    """The wide table with just the given parts, revenue and calendar columns."""
    # The revenue is one number to shuffle where its two parts would be two.
    items = wide(spark, sf_dir, parts, revenue=True)
    items = items.select(*[name for name in items.columns if name != "item_total_revenue"], "item_total_revenue")
    return clean.with_calendar(items) if "order" in parts else items


# ---------------------------------------------------------------- sources

@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_csv_roundtrip(spark, sf_dir):
    """Whole documents, with their quotes and line ends, through the CSV sink and source."""
    documents = table(spark, sf_dir, "documents")
    path = new_path(spark, "csv")
    write_csv(documents, path)
    return read_csv(spark, path, documents.schema, multi_line=True)


def _joined_from_orders(payments: str, reviews: str) -> str:
    return f"""
        SELECT o.*, c.* EXCLUDE (customer_id), i.* EXCLUDE (order_id), p.* EXCLUDE (product_id),
               t.product_category_name_english, s.* EXCLUDE (seller_id), y.* EXCLUDE (order_id),
               v.* EXCLUDE (order_id)
        FROM r_orders o
        LEFT JOIN r_customers c ON o.customer_id = c.customer_id
        LEFT JOIN r_order_items i ON o.order_id = i.order_id
        LEFT JOIN r_products p ON i.product_id = p.product_id
        LEFT JOIN r_sellers s ON i.seller_id = s.seller_id
        LEFT JOIN {payments} y ON o.order_id = y.order_id
        LEFT JOIN {reviews} v ON o.order_id = v.order_id
        LEFT JOIN r_category_translation t ON p.product_category_name = t.product_category_name"""


define("d_joined", _joined_from_orders("r_payments_by_type", "r_reviews_by_order"))
define("d_joined_raw", _joined_from_orders("r_payments", "r_reviews"))


@query(f"""
    WITH medians AS (
        SELECT {', '.join(f'quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}' for c in denormalize.REBUILT_NUMBERS)}
        FROM d_joined_raw
    )
    SELECT DISTINCT
        j.order_id, j.customer_id, order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
        order_delivered_customer_date, order_estimated_delivery_date, customer_unique_id,
        customer_zip_code_prefix, order_item_id, product_id, seller_id, shipping_limit_date,
        seller_zip_code_prefix,
        {', '.join(f'COALESCE(CAST(j.{c} AS DOUBLE), m.{c}) AS {c}' for c in denormalize.REBUILT_NUMBERS)},
        COALESCE(j.price, m.price) + COALESCE(j.freight_value, m.freight_value) AS item_total_revenue,
        COALESCE(review_comment_title, 'no_comment') AS review_comment_title,
        COALESCE(review_comment_message, 'no_comment') AS review_comment_message,
        lower(trim(COALESCE(product_category_name_english, product_category_name, 'nan')))
            AS product_category_name_english,
        lower(trim(COALESCE(product_category_name, 'unknown'))) AS product_category_name,
        lower(trim(COALESCE(customer_city, 'nan'))) AS customer_city,
        lower(trim(COALESCE(customer_state, 'nan'))) AS customer_state,
        lower(trim(COALESCE(seller_city, 'nan'))) AS seller_city,
        lower(trim(COALESCE(seller_state, 'nan'))) AS seller_state,
        lower(trim(COALESCE(payment_type, 'unknown'))) AS payment_type,
        lower(trim(COALESCE(order_status, 'unknown'))) AS order_status
    FROM d_joined_raw j, medians m""")
def fallback_wide(spark, sf_dir):
    """The table rebuilt from every payment and review of an order, none of them rolled up."""
    return denormalize.rebuild_wide(_raw_children(spark, sf_dir), fill="median")


def _raw_children(spark, sf_dir):
    tables = roles(spark, sf_dir, "orders", "customers", "order_items", "products", "sellers",
                   "category_translation", "payments", "reviews")
    # The place of a review is no column of the raw table.
    tables["reviews"] = tables["reviews"].drop("review_sequence")
    return tables


def _grouped_children(spark, sf_dir):
    """The raw children with one payment per order and type, and one review per order."""
    return _raw_children(spark, sf_dir) | {
        "payments": role(spark, sf_dir, "payments_by_type"), "reviews": role(spark, sf_dir, "reviews_by_order")}


@query(f"""SELECT CAST(order_purchase_timestamp AS DATE) AS order_date, {dsum('revenue')} AS total_sales
          FROM (SELECT DISTINCT * EXCLUDE (price, freight_value), COALESCE(price, 0) AS price,
                       COALESCE(freight_value, 0) AS freight_value,
                       COALESCE(price, 0) + COALESCE(freight_value, 0) AS revenue FROM d_joined)
          WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1""")
def fallback_daily_sales(spark, sf_dir):
    """The daily series of the table rebuilt with zeros for missing prices."""
    return daily_sales(denormalize.rebuild_wide(_grouped_children(spark, sf_dir), fill="zero"))


# ---------------------------------------------------------------- joins and roll-ups

@query("SELECT order_id, order_item_id, product_id, price + freight_value AS item_total_revenue FROM r_order_items")
def item_revenue(spark, sf_dir):
    items = clean.with_item_revenue(role(spark, sf_dir, "order_items"))
    return items.select("order_id", "order_item_id", "product_id", "item_total_revenue")


@query("SELECT * FROM d_payments")
def payments_rollup(spark, sf_dir):
    return denormalize.payments_rollup(role(spark, sf_dir, "payments"))


@query("SELECT * FROM d_reviews")
def reviews_rollup(spark, sf_dir):
    return denormalize.reviews_rollup(role(spark, sf_dir, "reviews"), sequence="review_sequence")


@query("""SELECT i.order_id, order_item_id, price, payment_sequential, payment_type, payment_installments,
                 payment_value
          FROM r_order_items i LEFT JOIN d_payments p ON i.order_id = p.order_id""")
def payments_rollup_join(spark, sf_dir):
    return wide(spark, sf_dir, ["payment"]).select(
        "order_id", "order_item_id", "price", "payment_sequential", "payment_type", "payment_installments",
        "payment_value")


@query("SELECT zip AS zip_code, lat, lng FROM d_geo")
def geo_mean(spark, sf_dir):
    return denormalize.zip_centroids(role(spark, sf_dir, "geolocation"))


@query("""SELECT geolocation_zip_code_prefix, geolocation_lat, geolocation_lng FROM r_geolocation
          WHERE geolocation_zip_code_prefix IN (SELECT customer_zip_code_prefix FROM r_customers)""")
def geo_semi(spark, sf_dir):
    return denormalize.only_known_zips(
        role(spark, sf_dir, "geolocation"), role(spark, sf_dir, "customers"), "customer_zip_code_prefix")


@query("""SELECT c.*, lat AS customer_lat, lng AS customer_lng
          FROM r_customers c LEFT JOIN d_geo ON customer_zip_code_prefix = zip""")
def geo_enrich(spark, sf_dir):
    centroids = stage(denormalize.zip_centroids(role(spark, sf_dir, "geolocation")), "centroids")
    return denormalize.with_position(role(spark, sf_dir, "customers"), centroids, "customer")


@query("SELECT * FROM d_wide")
def denormalize_wide(spark, sf_dir):
    return wide(spark, sf_dir, geolocation=True, whole=True)


# ---------------------------------------------------------------- profiles

@query("""SELECT column_name, data_type, row_count FROM (VALUES
              ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'),
              ('o_totalprice', 'double'), ('o_orderdate', 'timestamp_ntz'), ('o_orderpriority', 'string')
          ) AS columns(column_name, data_type), (SELECT COUNT(*) AS row_count FROM orders)""")
def table_profile(spark, sf_dir):
    return profile.table_profile(table(spark, sf_dir, "orders"))


# The columns of the wide table.
_PROFILED = tuple(dict.fromkeys([
    *[name for part in ("order_items", "products", "category_translation", "orders", "customers", "sellers", "payments", "reviews")
      for name in RAW_SCHEMAS[part].names],
    *[f"{part}_{name}" for part in ("customer", "seller") for name in ("lat", "lng")]]))


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS column_name, COUNT(*) - COUNT({name}) AS null_count FROM d_wide" for name in _PROFILED))
def null_profile(spark, sf_dir):
    return profile.null_profile(wide(spark, sf_dir, geolocation=True, whole=True))


@query("""SELECT COUNT(*) AS row_count,
                 (SELECT COUNT(*) FROM (SELECT DISTINCT order_id, product_id, seller_id FROM r_order_items))
                     AS distinct_rows,
                 COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT order_id, product_id, seller_id
                                                   FROM r_order_items)) AS duplicate_rows
          FROM r_order_items""")
def duplicate_profile(spark, sf_dir):
    return profile.duplicate_profile(
        role(spark, sf_dir, "order_items").select("order_id", "product_id", "seller_id"))


# ---------------------------------------------------------------- cleaning

@query("""SELECT order_id, order_approved_at, order_delivered_carrier_date, order_delivered_customer_date
          FROM r_orders WHERE order_approved_at IS NOT NULL AND order_delivered_carrier_date IS NOT NULL
                          AND order_delivered_customer_date IS NOT NULL""")
def clean_dropna(spark, sf_dir):
    orders = clean.drop_missing(role(spark, sf_dir, "orders"), clean.REQUIRED_MOMENTS)
    return orders.select("order_id", *clean.REQUIRED_MOMENTS)


_FILLED = ("product_name_lenght", "product_description_lenght", "product_weight_g")


@query(f"""WITH medians AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS {c}' for c in _FILLED)} FROM r_products)
           SELECT product_id, {', '.join(f'COALESCE(p.{c}, m.{c}) AS {c}' for c in _FILLED)}
           FROM r_products p, medians m""")
def median_fill(spark, sf_dir):
    products = stage(role(spark, sf_dir, "products"), "products")
    return clean.fill_median(products, _FILLED).select("product_id", *_FILLED)


@query("SELECT product_id, COALESCE(product_category_name, 'unknown') AS product_category_name FROM r_products")
def const_fill(spark, sf_dir):
    products = role(spark, sf_dir, "products").select("product_id", "product_category_name")
    return clean.fill_constants(products, {"product_category_name": "unknown"})


@query("SELECT DISTINCT order_id, product_id, seller_id FROM r_order_items")
def dedup_rows(spark, sf_dir):
    return clean.drop_duplicate_rows(
        role(spark, sf_dir, "order_items").select("order_id", "product_id", "seller_id"))


define("d_untidy", """
    SELECT product_id, chr(9) || '  ' || product_category_name || chr(10) || ' ' AS product_category_name
    FROM r_products""")


@query("""SELECT product_id, regexp_replace(lower(product_category_name), '^\\s+|\\s+$', '', 'g')
                 AS product_category_name FROM d_untidy""")
def text_normalize(spark, sf_dir):
    products = role(spark, sf_dir, "products").select(
        "product_id", F.concat(F.lit("\t  "), "product_category_name", F.lit("\n ")).alias("product_category_name"))
    return clean.normalize_text(products, ["product_category_name"])


@query("SELECT c_custkey, abs(c_acctbal) AS c_acctbal FROM customer")
def abs_fix(spark, sf_dir):
    return clean.make_positive(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])


@query("""SELECT product_id, CASE WHEN product_weight_g IS NULL OR product_weight_g = 0 THEN 1.0
                                  ELSE product_weight_g END AS product_weight_g,
                 product_height_cm FROM r_products""")
def zero_fix(spark, sf_dir):
    """Heights are never 0 or less, so their column is left alone."""
    products = role(spark, sf_dir, "products").select("product_id", "product_weight_g", "product_height_cm")
    return clean.zero_to_one(products, ["product_weight_g", "product_height_cm"])


def _quartile_cte(columns: Sequence[str], source: str) -> str:
    return f"""quartiles AS (SELECT {', '.join(
        f'quantile_cont({c}, 0.25) AS {c}_1, quantile_cont({c}, 0.75) AS {c}_3' for c in columns)} FROM {source})"""


def _capped(column: str, value: str) -> str:
    low = f"{column}_1 - 1.5 * ({column}_3 - {column}_1)"
    high = f"{column}_3 + 1.5 * ({column}_3 - {column}_1)"
    return f"CASE WHEN {value} < {low} THEN {low} WHEN {value} > {high} THEN {high} ELSE {value} END"


_MEASURES = ("price", "freight_value")


@query(f"""WITH {_quartile_cte(_MEASURES, 'r_order_items')} """ + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, round({c}_1 - 1.5 * ({c}_3 - {c}_1), 6) AS lower_bound,
               round({c}_3 + 1.5 * ({c}_3 - {c}_1), 6) AS upper_bound FROM quartiles""" for c in _MEASURES))
def iqr_bounds(spark, sf_dir):
    items = stage(role(spark, sf_dir, "order_items").select(*_MEASURES), "items")
    bounds = clean.iqr_bounds(items, _MEASURES)
    rows = [(name, round(low, 6), round(high, 6)) for name, (low, high) in bounds.items()]
    return spark.createDataFrame(rows, "column_name STRING, lower_bound DOUBLE, upper_bound DOUBLE")


@query(f"""WITH {_quartile_cte(_MEASURES, 'r_order_items')}
           SELECT order_id, order_item_id, product_id,
                  {', '.join(f'round({_capped(c, c)}, 6) AS {c}' for c in _MEASURES)}
           FROM r_order_items, quartiles""")
def iqr_cap(spark, sf_dir):
    items = role(spark, sf_dir, "order_items").select("order_id", "order_item_id", "product_id", *_MEASURES)
    capped = clean.cap_outliers(items, clean.iqr_bounds(stage(items, "items"), _MEASURES))
    return capped.withColumns({name: F.round(name, 6) for name in _MEASURES})


@query("""SELECT event_id, TRY_CAST(CASE WHEN event_id % 5 = 0 THEN 'soon' ELSE CAST(ts AS VARCHAR) END AS TIMESTAMP)
                     AS order_purchase_timestamp,
                 TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'n.a.' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS value
          FROM events""")
def coerce_types(spark, sf_dir):
    """Dates and numbers written as text, some of them unreadable."""
    visits = role(spark, sf_dir, "visits").select(
        "event_id",
        F.when(F.col("event_id") % 5 == 0, "soon").otherwise(F.col("order_purchase_timestamp").cast("string"))
        .alias("order_purchase_timestamp"),
        F.when(F.col("event_id") % 7 == 0, "n.a.").otherwise(F.col("value").cast("string")).alias("value"))
    return clean.coerce_numbers(clean.coerce_timestamps(visits, ["order_purchase_timestamp"]), ["value"])


@query("""SELECT event_id, CAST(year(ts) AS INTEGER) AS order_purchase_year,
                 CAST(month(ts) AS INTEGER) AS order_purchase_month, CAST(day(ts) AS INTEGER) AS order_purchase_day,
                 CAST(isodow(ts) - 1 AS INTEGER) AS order_purchase_day_of_week,
                 CAST(hour(ts) AS INTEGER) AS order_purchase_hour FROM events""")
def calendar_features(spark, sf_dir):
    visits = clean.with_calendar(role(spark, sf_dir, "visits"))
    return visits.select("event_id", *[name for name in visits.columns if name.startswith("order_purchase_")
                                       and name != "order_purchase_timestamp"])


define("d_complete", """
    SELECT * FROM d_wide
    WHERE payment_sequential IS NOT NULL AND payment_type IS NOT NULL AND payment_installments IS NOT NULL
      AND payment_value IS NOT NULL AND order_approved_at IS NOT NULL
      AND order_delivered_carrier_date IS NOT NULL AND order_delivered_customer_date IS NOT NULL""")
define("d_medians", f"""
    SELECT {', '.join(f'quantile_cont({c}, 0.5) AS {c}' for c in clean.MEDIAN_COLUMNS)} FROM d_complete""")
_UNKNOWN = ("product_category_name", "product_category_name_english")
_REPLACED = (*clean.MEDIAN_COLUMNS, *_UNKNOWN, "review_comment_title")
define("d_distinct", f"""
    SELECT DISTINCT w.* EXCLUDE ({', '.join(_REPLACED)}),
           {', '.join(f'COALESCE(w.{c}, m.{c}) AS {c}' for c in clean.MEDIAN_COLUMNS)},
           {', '.join(f"COALESCE({c}, 'unknown') AS {c}" for c in _UNKNOWN)},
           COALESCE(review_comment_message, 'no_comment') AS review_comment_title
    FROM d_complete w, d_medians m""")
_TIDIED = (*clean.TEXT_COLUMNS, *clean.UNSIGNED_COLUMNS)
define("d_tidy", f"""
    SELECT * EXCLUDE ({', '.join((*_TIDIED, *clean.SIZE_COLUMNS))}),
           {', '.join(f'lower(trim({c})) AS {c}' for c in clean.TEXT_COLUMNS)},
           {', '.join(f'abs({c}) AS {c}' for c in clean.UNSIGNED_COLUMNS)},
           {', '.join(f'''CASE WHEN (SELECT MIN({c}) FROM d_distinct) <= 0 AND ({c} IS NULL OR {c} = 0)
                               THEN 1.0 ELSE {c} END AS {c}''' for c in clean.SIZE_COLUMNS)}
    FROM d_distinct""")


@query(f"""
    WITH {_quartile_cte(clean.CAPPED_COLUMNS, 'd_tidy')}, capped AS (
        SELECT d_tidy.* EXCLUDE ({', '.join(clean.CAPPED_COLUMNS)}),
               {', '.join(f'{_capped(c, c)} AS {c}' for c in clean.CAPPED_COLUMNS)}
        FROM d_tidy, quartiles)
    SELECT * EXCLUDE ({', '.join(clean.CAPPED_COLUMNS)}),
           {', '.join(f'round({c}, 6) AS {c}' for c in clean.CAPPED_COLUMNS)},
           round(price + freight_value, 6) AS item_total_revenue,
           CAST(year(order_purchase_timestamp) AS INTEGER) AS order_purchase_year,
           CAST(month(order_purchase_timestamp) AS INTEGER) AS order_purchase_month,
           CAST(day(order_purchase_timestamp) AS INTEGER) AS order_purchase_day,
           CAST(isodow(order_purchase_timestamp) - 1 AS INTEGER) AS order_purchase_day_of_week,
           CAST(hour(order_purchase_timestamp) AS INTEGER) AS order_purchase_hour
    FROM capped""")
def cleaned_table(spark, sf_dir):
    # The cleaning makes the title from the message.
    cleaned = clean.clean(wide(spark, sf_dir, geolocation=True, whole=True, without=["review_comment_title"]))
    rounded = (*clean.CAPPED_COLUMNS, "item_total_revenue")
    return cleaned.withColumns({name: F.round(name, 6) for name in rounded})
