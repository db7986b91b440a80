"""Registered queries over feeds on which an operator left out would show, and round trips of sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewind.functions import exact_mean, exact_sum
from tradewind.operators import clean, denormalize, profile, rfm, sales
from tradewind.operators import timeseries as ts
from tradewind.operators.binning import distinct_edges, even_probabilities, value_score
from tradewind.operators.ordering import exact_quantiles
from tradewind.plans import series  # noqa: F401  (it defines the daily series)
from tradewind.plans.customers import _bought, _sql_edges, _sql_value_score
from tradewind.plans.registry import define, dmean, dsum, query
from tradewind.plans.roles import role, table
from tradewind.plans.tables import facts
from tradewind.sources import stage
from tradewind.sources.staging import new_path
from tradewind.sources.tables import (
    load_or_build, read_cleaned, read_csv, read_periods, replace_periods, write_fact_table, write_series,
)

CATEGORY = sales.CATEGORY
_LINE = ("order_id", "order_item_id")

# ---------------------------------------------------------------- repeated rows


@query("SELECT DISTINCT order_id, order_item_id FROM r_order_items")
def dedup_repeated_lines(spark, sf_dir):
    """An order and a line number stand for several items here and there."""
    return clean.drop_duplicate_rows(role(spark, sf_dir, "order_items").select(*_LINE))


define("d_twice", """SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 5 = 0""")


@query("""SELECT COUNT(*) AS row_count, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM d_twice)) AS distinct_rows,
                 COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM d_twice)) AS duplicate_rows
          FROM d_twice""")
def duplicate_profile_whole_rows(spark, sf_dir):
    """All columns, and a part of the rows twice."""
    items = table(spark, sf_dir, "lineitem")
    return profile.duplicate_profile(items.unionByName(items.where("l_orderkey % 5 = 0")))


# ---------------------------------------------------------------- gaps that have to be filled

define("d_recoded", """
    SELECT * EXCLUDE (order_status),
           CASE WHEN month(order_purchase_timestamp) % 2 = 0 THEN order_status ELSE 'delivered' END AS order_status
    FROM d_facts""")


@query(f"""SELECT s.month, s.total_revenue, COALESCE(number_of_cancellations, 0) AS number_of_cancellations
           FROM (SELECT month, {dsum('payment_value')} AS total_revenue FROM d_recoded
                 WHERE month IS NOT NULL GROUP BY month) s
           LEFT JOIN (SELECT month, COUNT(DISTINCT order_id) AS number_of_cancellations FROM d_recoded
                      WHERE order_status = 'canceled' GROUP BY month) c ON s.month = c.month""")
def monthly_sales_few_cancellations(spark, sf_dir):
    """Every other month has no cancelled order."""
    even = F.month("order_purchase_timestamp") % 2 == 0
    return sales.monthly_sales_with_cancellations(facts(spark, sf_dir, "order", "payment").withColumn(
        "order_status", F.when(even, F.col("order_status")).otherwise("delivered")))


define("d_placed", """
    SELECT f.customer_unique_id, f.order_id, CASE WHEN n = 1 THEN 'ONCE' ELSE customer_state END AS customer_state
    FROM d_facts f LEFT JOIN (SELECT customer_unique_id, COUNT(DISTINCT order_id) AS n FROM d_facts GROUP BY 1) c
        ON f.customer_unique_id = c.customer_unique_id""")


@query("""WITH repeats AS (SELECT customer_unique_id FROM d_placed GROUP BY 1 HAVING COUNT(DISTINCT order_id) > 1)
          SELECT customer_state, COUNT(DISTINCT f.customer_unique_id) AS unique_customers,
                 COUNT(DISTINCT r.customer_unique_id) AS repeat_customers,
                 CAST(COUNT(DISTINCT r.customer_unique_id) AS DOUBLE)
                     / COUNT(DISTINCT f.customer_unique_id) * 100 AS repeat_customer_rate
          FROM d_placed f LEFT JOIN repeats r ON f.customer_unique_id = r.customer_unique_id
          WHERE customer_state IS NOT NULL GROUP BY 1""")
def repeat_rate_with_single_orders(spark, sf_dir):
    """Customers with one order live in a state of their own, without any repeat customer."""
    items = facts(spark, sf_dir, "order", "customer")
    once = items.groupBy("customer_unique_id").agg(F.count_distinct("order_id").alias("n")).where("n = 1")
    placed = items.join(once, "customer_unique_id", "left").withColumn(
        "customer_state", F.when(F.col("n") == 1, "ONCE").otherwise(F.col("customer_state")))
    return sales.repeat_rate_by_state(placed)


@query("""SELECT geolocation_zip_code_prefix, geolocation_lat, geolocation_lng FROM r_geolocation
          WHERE geolocation_zip_code_prefix IN (
              SELECT customer_zip_code_prefix FROM r_customers WHERE customer_zip_code_prefix % 3 <> 0)""")
def geo_semi_unknown_zips(spark, sf_dir):
    """The zip prefix of some customers is not known."""
    known = F.when(F.col("customer_zip_code_prefix") % 3 != 0, F.col("customer_zip_code_prefix"))
    customers = role(spark, sf_dir, "customers").withColumn("customer_zip_code_prefix", known)
    return denormalize.only_known_zips(role(spark, sf_dir, "geolocation"), customers, "customer_zip_code_prefix")


define("d_fine_months", f"""
    SELECT p_type || '/' || p_brand || '/' || p_size AS {CATEGORY}, order_purchase_month,
           {dsum('item_total_revenue')} AS monthly_revenue
    FROM d_facts JOIN part ON product_id = p_partkey WHERE order_purchase_month IS NOT NULL GROUP BY 1, 2""")


@query(f"""SELECT {CATEGORY}, {', '.join(
    f'MAX(CASE WHEN order_purchase_month = {m} THEN monthly_revenue END) AS month_{m}' for m in range(1, 13))}
           FROM d_fine_months GROUP BY 1""")
def fine_category_month_pivot(spark, sf_dir):
    """Categories so fine that some months are empty, and stay NULL."""
    names = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat_ws("/", "p_type", "p_brand", F.col("p_size").cast("string")).alias(CATEGORY))
    return sales.category_month_pivot(facts(spark, sf_dir, "order").join(names, "product_id"))


define("d_user_days", f"""
    SELECT user_id, CAST(ts AS DATE) AS order_date, {dsum('value')} AS total_sales FROM events GROUP BY 1, 2""")


@query("""WITH days AS (SELECT user_id, CAST(unnest(generate_series(MIN(order_date), MAX(order_date), INTERVAL 1 DAY))
                                             AS DATE) AS order_date FROM d_user_days GROUP BY 1)
          SELECT days.user_id, days.order_date, COALESCE(total_sales, 0) AS total_sales
          FROM days LEFT JOIN d_user_days d ON days.user_id = d.user_id AND days.order_date = d.order_date""")
def daily_sales_by_user(spark, sf_dir):
    """Many series, each with days of its own missing."""
    daily = ts.daily_sales(role(spark, sf_dir, "visits"), money="value", series=["user_id"])
    return ts.dense_calendar(daily, ["user_id"])


# ---------------------------------------------------------------- edges and limits from the data

define("d_flags", "SELECT l_orderkey, COUNT(DISTINCT l_returnflag) AS flags FROM lineitem GROUP BY 1")


@query(f"""SELECT l_orderkey, {_sql_value_score('flags', 'edges', 4)} AS flag_score
           FROM d_flags, (SELECT {_sql_edges('flags', 4, True)} AS edges FROM d_flags)""")
def merged_edge_scores(spark, sf_dir):
    """Quartiles of which some are equal, so that their bins fall together."""
    flags = stage(table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count_distinct("l_returnflag").alias("flags")), "flags")
    edges = distinct_edges(exact_quantiles(flags, {"flags": even_probabilities(4)})["flags"], on_duplicates="drop")
    return flags.select("l_orderkey", value_score("flags", edges).alias("flag_score"))


@query("""SELECT * FROM d_rfm_v3 WHERE frequency > (SELECT quantile_cont(frequency, 0.9) FROM d_rfm_v3)
              OR monetary > (SELECT quantile_cont(monetary, 0.9) FROM d_rfm_v3)""")
def potential_b2b_top_tenth(spark, sf_dir):
    """Limits from the data, so that both decide for some customers."""
    scored = stage(rfm.rfm_v3(_bought(spark, sf_dir)), "scored")
    limits = exact_quantiles(scored, {"frequency": [0.9], "monetary": [0.9]})
    return rfm.potential_b2b(scored, limits["frequency"][0], limits["monetary"][0])


# ---------------------------------------------------------------- sums that quantising would change

define("d_fine", """
    SELECT user_id, CASE event_id % 4 WHEN 0 THEN 1e-4::DOUBLE WHEN 1 THEN 1::DOUBLE WHEN 2 THEN 1e5::DOUBLE ELSE -1e9::DOUBLE END
                    * value / 7::DOUBLE AS amount, event_id % 4 AS magnitude FROM events""")


@query(f"""SELECT user_id, {dsum('amount')} AS total, {dmean('CASE WHEN magnitude = 0 THEN amount END')} AS small_mean
           FROM d_fine GROUP BY 1""")
def fine_sums(spark, sf_dir):
    """Amounts of magnitudes far apart, with twelve digits and more behind the point."""
    number = F.col("event_id") % 4
    scale = F.when(number == 0, 1e-4).when(number == 1, 1.0).when(number == 2, 1e5).otherwise(-1e9)
    amounts = table(spark, sf_dir, "events").select("user_id", number.alias("n"), (scale * F.col("value") / 7.0).alias("amount"))
    return amounts.groupBy("user_id").agg(
        exact_sum("amount").alias("total"), exact_mean(F.when(F.col("n") == 0, F.col("amount"))).alias("small_mean"))


# ---------------------------------------------------------------- sinks and what reads them

_STORED = (*_LINE, "price", "freight_value", "item_total_revenue", "order_purchase_year", "order_purchase_month")


@query(f"SELECT {', '.join(_STORED)} FROM d_facts")
def fact_table_roundtrip(spark, sf_dir):
    """Written by purchase month and read back."""
    path = new_path(spark, "facts")
    write_fact_table(facts(spark, sf_dir, "order").select(*_STORED), path)
    return read_cleaned(spark, path).select(*_STORED)


@query(f"SELECT {', '.join(_STORED)} FROM d_facts")
def load_cleaned(spark, sf_dir):
    """The cleaned table is there, so nothing is rebuilt."""
    path = new_path(spark, "cleaned")
    write_fact_table(facts(spark, sf_dir, "order").select(*_STORED), path)
    return load_or_build(spark, path, {}).select(*_STORED)


@query("SELECT order_date, total_sales FROM d_daily")
def series_roundtrip(spark, sf_dir):
    """The daily series as CSV and back."""
    path = new_path(spark, "series")
    daily = ts.daily_sales(facts(spark, sf_dir, "order"))
    write_series(daily, path)
    return read_csv(spark, path, daily.select("order_date", "total_sales").schema)


_RELOADED = (1995, 3)


@query(f"""SELECT {', '.join(c for c in _STORED if c != 'price')},
                  CASE WHEN order_purchase_year = {_RELOADED[0]} AND order_purchase_month = {_RELOADED[1]} THEN price * 2
                       ELSE price END AS price
           FROM d_facts WHERE NOT (order_purchase_year = {_RELOADED[0]} AND order_purchase_month = {_RELOADED[1]}
                                   AND order_item_id > 4)""")
def reload_one_month(spark, sf_dir):
    """A month comes again with other prices and fewer items; the files of the other months are left alone."""
    path = new_path(spark, "months")
    write_fact_table(facts(spark, sf_dir, "order").select(*_STORED), path)
    # The new state of the month is staged, since a table cannot be read while it is replaced.
    month = stage(read_periods(spark, path, [_RELOADED]).where("order_item_id <= 4").withColumn("price", F.col("price") * 2), "month")
    replace_periods(month, path, [_RELOADED])
    return read_cleaned(spark, path).select(*_STORED)


@query(f"""SELECT {', '.join(_STORED)} FROM d_facts
           WHERE order_purchase_year = {_RELOADED[0]} AND order_purchase_month = {_RELOADED[1]}""")
def read_one_month(spark, sf_dir):
    """One month of the stored table."""
    path = new_path(spark, "months")
    write_fact_table(facts(spark, sf_dir, "order").select(*_STORED), path)
    return read_periods(spark, path, [_RELOADED]).select(*_STORED)
