"""Registered queries: scores, segments and cohorts of customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewind.functions import elapsed_days
from tradewind.operators import rfm
from tradewind.operators.binning import cut_score, distinct_edges, even_probabilities, value_score
from tradewind.operators.ordering import exact_quantiles, quantiles_and_cuts
from tradewind.plans.registry import define, dmean, dsum, query
from tradewind.plans.roles import role
from tradewind.plans.tables import facts
from tradewind.sources import stage


def _sql_value_score(value: str, edges: str, bins: int, descending: bool = False) -> str:
    above = " + ".join(f"CASE WHEN {i} < len({edges}) AND {value} > {edges}[{i}] THEN 1 ELSE 0 END"
                       for i in range(2, bins + 1))
    return f"CAST(len({edges}) - 1 - ({above}) AS INTEGER)" if descending else f"CAST(1 + {above} AS INTEGER)"


def _sql_rank_score(order_by: str, bins: int) -> str:
    return (f"CAST(greatest(1, ((row_number() OVER (ORDER BY {order_by}) - 1) * {bins} + COUNT(*) OVER () - 2)"
            f" // (COUNT(*) OVER () - 1)) AS INTEGER)")


def _sql_edges(value: str, bins: int, merged: bool = False) -> str:
    edges = f"quantile_cont(CAST({value} AS DOUBLE), {[i / bins for i in range(bins + 1)]})"
    return f"list_sort(list_distinct({edges}))" if merged else edges


def _sql_segment(rules, r: str, f: str, m: str) -> str:
    columns = {"r": r, "f": f, "m": m}
    cases = " ".join(
        f"WHEN {' AND '.join(f'{columns[s]} BETWEEN {low} AND {high}' for s, (low, high) in ranges.items())}"
        f" THEN '{name}'" for name, ranges in rules)
    return f"CASE {cases} ELSE '{rfm.OTHER_SEGMENT}' END"


for _version, _money, _days in (("paid", "payment_value", 1), ("bought", "item_total_revenue", 0)):
    define(f"d_customers_{_version}", f"""
        SELECT *, CAST(date_sub('day', last_purchase_date,
                                MAX(last_purchase_date) OVER () + INTERVAL {_days} DAY) AS INTEGER) AS recency
        FROM (SELECT customer_unique_id, MAX(order_purchase_timestamp) AS last_purchase_date,
                     COUNT(DISTINCT order_id) AS frequency, {dsum(_money)} AS monetary
              FROM d_facts WHERE customer_unique_id IS NOT NULL GROUP BY 1)""")

define("d_rfm_v1", f"""
    SELECT *, concat(R_Score, F_Score, M_Score) AS RFM_Segment,
           {_sql_segment(rfm.SEGMENTS_V1, 'R_Score', 'F_Score', 'M_Score')} AS Customer_Segment
    FROM (SELECT customer_unique_id, recency, frequency, monetary,
                 {_sql_value_score('recency', 'r_edges', 5, descending=True)} AS R_Score,
                 {_sql_value_score('frequency', 'f_edges', 5)} AS F_Score,
                 {_sql_value_score('monetary', 'm_edges', 5)} AS M_Score
          FROM d_customers_paid,
               (SELECT {_sql_edges('recency', 5)} AS r_edges, {_sql_edges('frequency', 5, True)} AS f_edges,
                       {_sql_edges('monetary', 5, True)} AS m_edges FROM d_customers_paid))""")
define("d_rfm_v2", f"""
    SELECT *, concat(R_score, F_score, M_score) AS RFM_score,
           {_sql_segment(rfm.SEGMENTS_V2, 'R_score', 'F_score', 'M_score')} AS RFM_segment
    FROM (SELECT customer_unique_id, last_purchase_date, frequency, monetary AS monetary_value, recency,
                 {_sql_value_score('recency', 'r_edges', 5, descending=True)} AS R_score,
                 {_sql_rank_score('frequency, customer_unique_id', 5)} AS F_score,
                 {_sql_rank_score('monetary, customer_unique_id', 5)} AS M_score
          FROM d_customers_paid, (SELECT {_sql_edges('recency', 5)} AS r_edges FROM d_customers_paid))""")
define("d_rfm_v3", f"""
    SELECT *, concat(r_score, f_score, m_score) AS rfm_segment
    FROM (SELECT customer_unique_id AS customer_id, recency, frequency, monetary,
                 {_sql_value_score('recency', 'r_edges', 4, descending=True)} AS r_score,
                 {_sql_rank_score('frequency, customer_unique_id', 4)} AS f_score,
                 {_sql_value_score('monetary', 'm_edges', 4)} AS m_score
          FROM d_customers_bought,
               (SELECT {_sql_edges('recency', 4)} AS r_edges, {_sql_edges('monetary', 4)} AS m_edges
                FROM d_customers_bought))""")


def _paid(spark, sf_dir):
    return facts(spark, sf_dir, "order", "customer", "payment")


def _bought(spark, sf_dir):
    return facts(spark, sf_dir, "order", "customer")


# ---------------------------------------------------------------- scores

@query("""SELECT user_id, CAST(date_sub('day', MAX(ts), (SELECT MAX(ts) FROM events) + INTERVAL 1 DAY) AS INTEGER)
                     AS recency FROM events GROUP BY user_id""")
def recency_days(spark, sf_dir):
    """Whole 24-hour days since the last visit."""
    last = stage(role(spark, sf_dir, "visits").groupBy("user_id").agg(
        F.max("order_purchase_timestamp").alias("last")), "last")
    reference = last.agg(F.max("last")).scalar() + F.expr("INTERVAL '1' DAY")
    return last.select("user_id", elapsed_days(F.col("last"), reference).alias("recency"))


@query(f"""SELECT c_custkey,
                  {_sql_value_score('c_acctbal', 'edges', 5)} AS balance_score,
                  {_sql_value_score('c_acctbal', 'edges', 5, descending=True)} AS reverse_score
           FROM customer, (SELECT {_sql_edges('c_acctbal', 5)} AS edges FROM customer)""")
def rfm_value_scores(spark, sf_dir):
    customers = stage(spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_acctbal"), "customers")
    edges = distinct_edges(exact_quantiles(customers, {"c_acctbal": even_probabilities(5)})["c_acctbal"])
    return customers.select(
        "c_custkey", value_score("c_acctbal", edges).alias("balance_score"),
        value_score("c_acctbal", edges, descending=True).alias("reverse_score"))


@query(f"""SELECT o_orderkey, {_sql_rank_score('o_totalprice, o_orderkey', 5)} AS price_score FROM orders""")
def rfm_rank_scores(spark, sf_dir):
    orders = stage(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice"), "orders")
    cuts = quantiles_and_cuts(orders, {}, ["o_totalprice"], "o_orderkey", 5)[1]["o_totalprice"]
    return orders.select("o_orderkey", cut_score("o_totalprice", "o_orderkey", cuts).alias("price_score"))


@query("SELECT * FROM d_rfm_v1")
def rfm_v1(spark, sf_dir):
    return rfm.rfm_v1(_paid(spark, sf_dir))


@query("SELECT * FROM d_rfm_v2")
def rfm_v2(spark, sf_dir):
    return rfm.rfm_v2(_paid(spark, sf_dir))


@query("SELECT * FROM d_rfm_v3")
def rfm_v3(spark, sf_dir):
    return rfm.rfm_v3(_bought(spark, sf_dir))


# ---------------------------------------------------------------- segments

@query("SELECT Customer_Segment, COUNT(*) AS Number_of_Customers FROM d_rfm_v1 GROUP BY 1")
def rfm_segments_v1(spark, sf_dir):
    return rfm.segment_counts(rfm_v1(spark, sf_dir), "Customer_Segment")


@query("SELECT customer_unique_id, RFM_score, RFM_segment FROM d_rfm_v2")
def rfm_segments_v2(spark, sf_dir):
    return rfm_v2(spark, sf_dir).select("customer_unique_id", "RFM_score", "RFM_segment")


@query("SELECT RFM_segment, COUNT(*) AS Number_of_Customers FROM d_rfm_v2 GROUP BY 1")
def segment_counts(spark, sf_dir):
    return rfm.segment_counts(rfm_v2(spark, sf_dir))


@query("""SELECT RFM_segment, COUNT(*) AS Number_of_Customers,
                 COUNT(*) * 100.0 / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS share_percent
          FROM d_rfm_v2 GROUP BY 1""")
def segment_share(spark, sf_dir):
    return rfm.segment_share(rfm_v2(spark, sf_dir))


@query(f"""SELECT RFM_segment, {dmean('recency')} AS Avg_Recency, {dmean('frequency')} AS Avg_Frequency,
                  {dmean('monetary_value')} AS Avg_Monetary_Value, COUNT(customer_unique_id) AS Num_Customers
           FROM d_rfm_v2 GROUP BY 1""")
def segment_profile(spark, sf_dir):
    return rfm.segment_profile(rfm_v2(spark, sf_dir))


@query("""SELECT customer_state, COUNT(DISTINCT f.customer_unique_id) AS Unique_High_Value_Customers
          FROM d_facts f JOIN d_rfm_v2 s ON f.customer_unique_id = s.customer_unique_id
          WHERE RFM_segment IN ('Champions', 'Loyal Customers', 'Big Spenders') AND customer_state IS NOT NULL
          GROUP BY 1""")
def high_value_by_state(spark, sf_dir):
    return rfm.high_value_by_state(_bought(spark, sf_dir), rfm_v2(spark, sf_dir))


def _sql_crosstab(rows: str, columns: str) -> str:
    prefix = columns[0]
    cells = ", ".join(f"COUNT(*) FILTER ({columns} = {i}) AS {prefix}{i}" for i in range(1, 6))
    shown = ", ".join(f"COALESCE({prefix}{i}, 0) AS {prefix}{i}" for i in range(1, 6))
    return f"""SELECT CAST(score AS INTEGER) AS {rows}, {shown}
               FROM range(1, 6) AS axis(score)
               LEFT JOIN (SELECT {rows}, {cells} FROM d_rfm_v2 GROUP BY 1) counted ON counted.{rows} = score"""


@query(_sql_crosstab("R_score", "F_score"))
def rf_crosstab(spark, sf_dir):
    return rfm.score_crosstab(rfm_v2(spark, sf_dir), "R_score", "F_score")


@query(_sql_crosstab("F_score", "M_score"))
def fm_crosstab(spark, sf_dir):
    return rfm.score_crosstab(rfm_v2(spark, sf_dir), "F_score", "M_score")


_POINTS = "customer_unique_id, recency, frequency, monetary_value, R_score, M_score, RFM_segment"


@query(f"SELECT {_POINTS} FROM d_rfm_v2 WHERE RFM_segment IN ('Champions', 'Lost Customers')")
def segment_points(spark, sf_dir):
    return rfm.segment_points(rfm_v2(spark, sf_dir), ["Champions", "Lost Customers"])


@query(f"SELECT {_POINTS} FROM d_rfm_v2")
def customer_points(spark, sf_dir):
    return rfm.segment_points(rfm_v2(spark, sf_dir))


# ---------------------------------------------------------------- cohorts

@query("SELECT * FROM d_rfm_v3 WHERE rfm_segment = '444'")
def top_rfm_customers(spark, sf_dir):
    return rfm.top_customers(rfm_v3(spark, sf_dir))


@query("SELECT * FROM d_rfm_v3 WHERE frequency > 10 OR monetary > 5000")
def potential_b2b(spark, sf_dir):
    return rfm.potential_b2b(rfm_v3(spark, sf_dir))


@query("""SELECT 'at_risk' AS cohort, COUNT(*) AS customers FROM d_rfm_v3 WHERE recency > 90
          UNION ALL SELECT 'lost', COUNT(*) FROM d_rfm_v3 WHERE recency > 180
          UNION ALL SELECT 'loyal', COUNT(*) FROM d_rfm_v3 WHERE frequency > 3 AND recency < 30""")
def churn_cohorts(spark, sf_dir):
    # The cohorts need no score.
    return rfm.churn_cohorts(rfm.customer_metrics(_bought(spark, sf_dir), "item_total_revenue", 0))


for _cohort, _condition in (("at_risk", "recency > 90"), ("lost", "recency > 180"),
                            ("loyal", "frequency > 3 AND recency < 30")):
    define(f"d_{_cohort}", f"SELECT * FROM d_rfm_v3 WHERE {_condition}")


@query("SELECT * FROM d_at_risk")
def at_risk_customers(spark, sf_dir):
    return rfm.at_risk(rfm_v3(spark, sf_dir))


@query("SELECT * FROM d_lost")
def lost_customers(spark, sf_dir):
    return rfm.at_risk(rfm_v3(spark, sf_dir), 180)


@query("SELECT * FROM d_loyal")
def loyal_customers(spark, sf_dir):
    return rfm.loyal(rfm_v3(spark, sf_dir))
