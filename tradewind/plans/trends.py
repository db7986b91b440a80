"""Registered queries: sales by period, product, category and place, and baskets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewind.functions import month_start
from tradewind.operators import basket, ranking, sales
from tradewind.operators.distinct import distinct_counts
from tradewind.operators.ordering import exact_quantiles
from tradewind.plans.registry import define, dmean, dsum, query
from tradewind.plans.roles import role
from tradewind.plans.tables import facts
from tradewind.sources import stage

CATEGORY = sales.CATEGORY

# ---------------------------------------------------------------- periods

define("d_month_sales", f"""
    SELECT month, {dsum('item_total_revenue')} AS total_revenue FROM d_facts WHERE month IS NOT NULL GROUP BY month""")
define("d_month_cancellations", """
    SELECT month, COUNT(DISTINCT order_id) AS number_of_cancellations FROM d_facts
    WHERE order_status = 'canceled' AND month IS NOT NULL GROUP BY month""")


@query(f"""SELECT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month,
                 {dsum('l.l_extendedprice + l.l_extendedprice * l.l_tax')} AS total_revenue
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1""")
def monthly_sales(spark, sf_dir):
    return sales.monthly_sales(facts(spark, sf_dir, "order"), sales.REVENUE)


@query(f"""SELECT month, {dsum('payment_value')} AS total_revenue FROM d_facts
           WHERE month IS NOT NULL GROUP BY month""")
def monthly_payments(spark, sf_dir):
    """An order's payment stands on each of its items and counts once per item."""
    return sales.monthly_sales(facts(spark, sf_dir, "order", "payment"), sales.PAID)


@query(f"""SELECT month, {dsum('payment_value')} AS total_revenue
           FROM (SELECT DISTINCT month, order_id, payment_value FROM d_facts WHERE month IS NOT NULL)
           GROUP BY month""")
def monthly_payments_per_order(spark, sf_dir):
    return sales.monthly_sales(facts(spark, sf_dir, "order", "payment"), sales.PAID, grain="order")


@query(f"""SELECT order_purchase_year AS year, {dsum('payment_value')} AS total_revenue FROM d_facts
           WHERE order_purchase_year IS NOT NULL GROUP BY 1""")
def yearly_sales(spark, sf_dir):
    return sales.yearly_sales(facts(spark, sf_dir, "order", "payment"))


@query("""WITH best AS (SELECT month, total_revenue, 'best' AS kind FROM d_month_sales
                        ORDER BY total_revenue DESC, month LIMIT 1),
               worst AS (SELECT month, total_revenue, 'worst' AS kind FROM d_month_sales
                         ORDER BY total_revenue, month LIMIT 1)
          SELECT * FROM best UNION ALL SELECT * FROM worst""")
def best_worst_month(spark, sf_dir):
    monthly = sales.monthly_sales(facts(spark, sf_dir, "order"), sales.REVENUE)
    return ranking.best_and_worst(monthly, "total_revenue", "month")


@query(f"""SELECT s.month, s.total_revenue, COALESCE(number_of_cancellations, 0) AS number_of_cancellations
           FROM (SELECT month, {dsum('payment_value')} AS total_revenue FROM d_facts
                 WHERE month IS NOT NULL GROUP BY month) s
           LEFT JOIN d_month_cancellations c ON s.month = c.month""")
def monthly_sales_cancellations(spark, sf_dir):
    return sales.monthly_sales_with_cancellations(facts(spark, sf_dir, "order", "payment"))


@query("SELECT * FROM d_month_cancellations ORDER BY number_of_cancellations DESC, month LIMIT 1")
def worst_cancel_month(spark, sf_dir):
    monthly = sales.monthly_cancellations(facts(spark, sf_dir, "order"))
    return ranking.top(monthly, "number_of_cancellations", "month", 1)


@query(f"""WITH monthly AS (
               SELECT order_purchase_month, {dmean('price')} AS average_price,
                      COUNT(DISTINCT order_id) AS monthly_orders
               FROM d_facts WHERE order_purchase_month IS NOT NULL GROUP BY 1)
           SELECT *, COALESCE(average_price < lag(average_price) OVER (ORDER BY order_purchase_month)
                      AND monthly_orders > lag(monthly_orders) OVER (ORDER BY order_purchase_month), FALSE)
                     AS is_promotion
           FROM monthly""")
def promo_months(spark, sf_dir):
    return sales.promo_months(facts(spark, sf_dir, "order"))


# ---------------------------------------------------------------- products and categories

define("d_product_sales", f"""
    SELECT product_id, COUNT(order_item_id) AS total_quantity_sold, {dsum('item_total_revenue')} AS total_revenue
    FROM d_facts GROUP BY product_id""")
define("d_category_sales", f"""
    SELECT {CATEGORY}, COUNT(order_item_id) AS total_quantity_sold, {dsum('item_total_revenue')} AS total_revenue
    FROM d_facts WHERE {CATEGORY} IS NOT NULL GROUP BY 1""")
define("d_category_months", f"""
    SELECT {CATEGORY}, order_purchase_month, {dsum('item_total_revenue')} AS monthly_revenue
    FROM d_facts WHERE {CATEGORY} IS NOT NULL AND order_purchase_month IS NOT NULL GROUP BY 1, 2""")


@query("SELECT * FROM d_product_sales")
def product_sales(spark, sf_dir):
    return sales.product_sales(facts(spark, sf_dir))


@query("SELECT * FROM d_category_sales")
def category_sales(spark, sf_dir):
    return sales.category_sales(facts(spark, sf_dir, "product"))


@query("SELECT * FROM d_product_sales ORDER BY total_revenue DESC, product_id LIMIT 10")
def top_products(spark, sf_dir):
    return ranking.top(sales.product_sales(facts(spark, sf_dir)), "total_revenue", "product_id", 10)


@query(f"SELECT * FROM d_category_sales ORDER BY total_revenue DESC, {CATEGORY} LIMIT 10")
def top_categories(spark, sf_dir):
    return ranking.top(sales.category_sales(facts(spark, sf_dir, "product")), "total_revenue", CATEGORY, 10)


@query(f"SELECT * FROM d_category_sales ORDER BY total_revenue DESC, {CATEGORY} LIMIT 1")
def leading_category(spark, sf_dir):
    return ranking.top(sales.category_sales(facts(spark, sf_dir, "product")), "total_revenue", CATEGORY, 1)


@query(f"""WITH leaders AS (SELECT product_id FROM d_product_sales
                            ORDER BY total_revenue DESC, product_id LIMIT 10),
                monthly AS (SELECT product_id, order_purchase_month, {dsum('item_total_revenue')} AS monthly_revenue
                            FROM d_facts WHERE product_id IN (SELECT product_id FROM leaders) GROUP BY 1, 2)
           SELECT * FROM monthly
           QUALIFY row_number() OVER (PARTITION BY product_id
                                      ORDER BY monthly_revenue DESC, order_purchase_month) = 1""")
def product_peak_month(spark, sf_dir):
    return sales.product_peak_month(facts(spark, sf_dir, "order"))


@query("SELECT * FROM d_category_months")
def category_month_sales(spark, sf_dir):
    return sales.category_month_sales(facts(spark, sf_dir, "order", "product"))


@query(f"""SELECT * FROM d_category_months WHERE {CATEGORY} IN (
               SELECT {CATEGORY} FROM d_category_sales ORDER BY total_revenue DESC, {CATEGORY} LIMIT 3)""")
def top_category_months(spark, sf_dir):
    return sales.top_category_months(facts(spark, sf_dir, "order", "product"), 3)


@query(f"""SELECT {CATEGORY}, {', '.join(
    f'MAX(CASE WHEN order_purchase_month = {m} THEN monthly_revenue END) AS month_{m}' for m in range(1, 13))}
           FROM d_category_months GROUP BY 1""")
def category_month_pivot(spark, sf_dir):
    return sales.category_month_pivot(facts(spark, sf_dir, "order", "product"))


@query(f"""WITH leaders AS (SELECT {CATEGORY}, total_revenue FROM d_category_sales
                            ORDER BY total_revenue DESC, {CATEGORY} LIMIT 5)
           SELECT *, round(total_revenue * 100.0 / SUM(total_revenue) OVER (), 8) AS share_percent FROM leaders""")
def category_share(spark, sf_dir):
    share = sales.category_share(facts(spark, sf_dir, "product"))
    return share.withColumn("share_percent", F.round("share_percent", 8))


@query(f"""WITH monthly AS (SELECT month, {CATEGORY}, {dsum('item_total_revenue')} AS revenue FROM d_facts
                            WHERE month IS NOT NULL AND {CATEGORY} IS NOT NULL GROUP BY 1, 2)
           SELECT {CATEGORY},
                  round(COALESCE(SUM(revenue) FILTER (month = (SELECT MAX(month) FROM monthly)), 0)
                      - COALESCE(SUM(revenue) FILTER (month = (SELECT MIN(month) FROM monthly)), 0), 6) AS growth
           FROM monthly GROUP BY 1 ORDER BY growth DESC, 1 LIMIT 10""")
def category_growth(spark, sf_dir):
    growth = sales.category_growth(facts(spark, sf_dir, "order", "product"))
    return ranking.top(growth.withColumn("growth", F.round("growth", 6)), "growth", CATEGORY, 10)


@query("""SELECT 'price' AS column_a, 'price' AS column_b, round(corr(price, price), 8) AS correlation FROM d_facts
          UNION ALL SELECT 'price', 'review_score', round(corr(price, review_score), 8) FROM d_facts
          UNION ALL SELECT 'review_score', 'price', round(corr(review_score, price), 8) FROM d_facts
          UNION ALL SELECT 'review_score', 'review_score', round(corr(review_score, review_score), 8)
          FROM d_facts""")
def price_review_corr(spark, sf_dir):
    matrix = sales.correlation_matrix(facts(spark, sf_dir, "review"), ["price", "review_score"])
    return matrix.withColumn("correlation", F.round("correlation", 8))


_REVIEWED = ["order_id", "order_item_id", "product_id", "price", "review_score"]


@query(f"""SELECT {', '.join(_REVIEWED)} FROM d_facts
           WHERE review_score <= 3 AND price > (SELECT quantile_cont(price, 0.5) FROM d_facts)""")
def price_sensitive(spark, sf_dir):
    prices = stage(role(spark, sf_dir, "order_items").select("price"), "prices")
    (median,) = exact_quantiles(prices, {"price": [0.5]})["price"]
    return sales.price_sensitive(facts(spark, sf_dir, "review"), median).select(_REVIEWED)


@query("""SELECT order_id, order_item_id, product_id, review_score, review_comment_message FROM d_facts
          WHERE review_score <= 3 AND review_comment_message IS NOT NULL""")
def negative_feedback(spark, sf_dir):
    return sales.negative_feedback(facts(spark, sf_dir, "review")).select(
        "order_id", "order_item_id", "product_id", "review_score", "review_comment_message")


# ---------------------------------------------------------------- places

for _place in ("state", "city"):
    define(f"d_{_place}_sales", f"""
        SELECT customer_{_place}, {dsum('payment_value')} AS total_revenue, COUNT(DISTINCT order_id) AS total_orders
        FROM d_facts WHERE customer_{_place} IS NOT NULL GROUP BY 1""")


@query("SELECT * FROM d_state_sales")
def state_sales(spark, sf_dir):
    return sales.state_sales(facts(spark, sf_dir, "order", "customer", "payment"))


@query("SELECT * FROM d_city_sales")
def city_sales(spark, sf_dir):
    return sales.city_sales(facts(spark, sf_dir, "order", "customer", "payment"))


@query("SELECT * FROM d_state_sales ORDER BY total_revenue DESC, customer_state LIMIT 10")
def top_states(spark, sf_dir):
    return ranking.top(state_sales(spark, sf_dir), "total_revenue", "customer_state", 10)


@query("SELECT * FROM d_state_sales ORDER BY total_revenue, customer_state DESC LIMIT 5")
def bottom_states(spark, sf_dir):
    return ranking.bottom(state_sales(spark, sf_dir), "total_revenue", "customer_state", 5)


@query("SELECT * FROM d_city_sales ORDER BY total_revenue DESC, customer_city LIMIT 10")
def top_cities(spark, sf_dir):
    return ranking.top(city_sales(spark, sf_dir), "total_revenue", "customer_city", 10)


@query("SELECT * FROM d_city_sales ORDER BY total_revenue, customer_city DESC LIMIT 5")
def bottom_cities(spark, sf_dir):
    return ranking.bottom(city_sales(spark, sf_dir), "total_revenue", "customer_city", 5)


@query(f"""SELECT customer_state, {dsum('item_total_revenue')} AS total_revenue FROM d_facts
           WHERE customer_state IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def top_states_by_item_revenue(spark, sf_dir):
    per_state = sales.sales_by(facts(spark, sf_dir, "order", "customer"), "customer_state")
    return ranking.top(per_state, "total_revenue", "customer_state", 10)


@query("""SELECT customer_state, COUNT(DISTINCT order_id) AS total_orders FROM d_facts
          WHERE customer_state IS NOT NULL GROUP BY 1""")
def orders_by_state(spark, sf_dir):
    items = facts(spark, sf_dir, "order", "customer").where(F.col("customer_state").isNotNull())
    return items.groupBy("customer_state").agg(F.count_distinct("order_id").alias("total_orders"))


@query("""WITH repeats AS (SELECT customer_unique_id FROM d_facts GROUP BY 1 HAVING COUNT(DISTINCT order_id) > 1)
          SELECT customer_state, COUNT(DISTINCT f.customer_unique_id) AS unique_customers,
                 COUNT(DISTINCT r.customer_unique_id) AS repeat_customers,
                 CAST(COUNT(DISTINCT r.customer_unique_id) AS DOUBLE)
                     / COUNT(DISTINCT f.customer_unique_id) * 100 AS repeat_customer_rate
          FROM d_facts f LEFT JOIN repeats r ON f.customer_unique_id = r.customer_unique_id
          WHERE customer_state IS NOT NULL GROUP BY 1""")
def repeat_rate_by_state(spark, sf_dir):
    return sales.repeat_rate_by_state(facts(spark, sf_dir, "order", "customer"))


@query(f"""WITH leaders AS (SELECT {CATEGORY} FROM d_category_sales
                            ORDER BY total_revenue DESC, {CATEGORY} LIMIT 3),
                per_state AS (SELECT customer_state, {CATEGORY}, {dsum('item_total_revenue')} AS category_revenue
                              FROM d_facts WHERE customer_state IS NOT NULL
                                  AND {CATEGORY} IN (SELECT {CATEGORY} FROM leaders) GROUP BY 1, 2)
           SELECT * FROM per_state
           QUALIFY row_number() OVER (PARTITION BY customer_state
                                      ORDER BY category_revenue DESC, {CATEGORY}) = 1""")
def top_category_per_state(spark, sf_dir):
    return sales.top_category_per_state(facts(spark, sf_dir, "order", "customer", "product"))


@query(f"""SELECT customer_city, COUNT(order_id) AS order_count FROM d_facts
           WHERE {CATEGORY} = 'promo' AND customer_city IS NOT NULL GROUP BY 1""")
def tech_city_orders(spark, sf_dir):
    return sales.city_orders(facts(spark, sf_dir, "order", "customer", "product"), "promo")


# ---------------------------------------------------------------- baskets

@query("""WITH lines AS (SELECT order_id, product_id, COUNT(*) AS copies FROM r_order_items GROUP BY 1, 2),
               pairs AS (SELECT a.product_id AS product_a, b.product_id AS product_b
                         FROM lines a JOIN lines b ON a.order_id = b.order_id AND a.product_id < b.product_id
                         UNION ALL SELECT product_id, product_id FROM lines WHERE copies > 1)
          SELECT product_a, product_b, COUNT(*) AS count FROM pairs GROUP BY 1, 2
          ORDER BY count DESC, product_a, product_b LIMIT 10""")
def basket_pairs(spark, sf_dir):
    return basket.most_common_pairs(role(spark, sf_dir, "order_items"), 10)


# ---------------------------------------------------------------- distinct counts that merge

@query("""
    WITH f AS (SELECT order_id, strftime(month, '%Y-%m-%d') AS month, CAST(order_purchase_year AS VARCHAR) AS year,
                      customer_city AS city, customer_state AS state FROM d_facts)
    SELECT 'time' AS family, 'month' AS grain, month || '|' || year AS path, COUNT(DISTINCT order_id) AS distinct_keys
    FROM f WHERE month IS NOT NULL GROUP BY 3
    UNION ALL SELECT 'time', 'year', year, COUNT(DISTINCT order_id) FROM f WHERE month IS NOT NULL GROUP BY 3
    UNION ALL SELECT 'place', 'city', city || '|' || state, COUNT(DISTINCT order_id)
    FROM f WHERE city IS NOT NULL AND state IS NOT NULL GROUP BY 3
    UNION ALL SELECT 'place', 'state', state, COUNT(DISTINCT order_id)
    FROM f WHERE city IS NOT NULL AND state IS NOT NULL GROUP BY 3""")
def distinct_orders_by_grain(spark, sf_dir):
    """Orders of every month, year, city and state from one reading of the facts."""
    items = facts(spark, sf_dir, "order", "customer").select(
        "order_id", month_start("order_purchase_timestamp").alias("month"),
        F.col("order_purchase_year").alias("year"), F.col("customer_city").alias("city"), F.col("customer_state").alias("state"))
    counts = distinct_counts(items, "order_id", {"time": ["month", "year"], "place": ["city", "state"]})
    return counts.withColumn("path", F.array_join("path", "|"))


@query("""
    WITH f AS (SELECT customer_unique_id, product_category_name AS category, strftime(month, '%Y-%m-%d') AS month,
                      CAST(order_purchase_year AS VARCHAR) AS year FROM d_facts)
    SELECT 'product' AS family, 'category' AS grain, category AS path, COUNT(DISTINCT customer_unique_id) AS distinct_keys
    FROM f WHERE category IS NOT NULL GROUP BY 3
    UNION ALL SELECT 'time', 'month', month || '|' || year, COUNT(DISTINCT customer_unique_id) FROM f WHERE month IS NOT NULL GROUP BY 3
    UNION ALL SELECT 'time', 'year', year, COUNT(DISTINCT customer_unique_id) FROM f WHERE month IS NOT NULL GROUP BY 3""")
def distinct_customers_by_grain(spark, sf_dir):
    """Customers of every category, month and year; a customer is in several of each."""
    items = facts(spark, sf_dir, "order", "customer", "product").select(
        "customer_unique_id", F.col("product_category_name").alias("category"),
        month_start("order_purchase_timestamp").alias("month"), F.col("order_purchase_year").alias("year"))
    counts = distinct_counts(items, "customer_unique_id", {"product": ["category"], "time": ["month", "year"]})
    return counts.withColumn("path", F.array_join("path", "|"))
