"""Recency, frequency, monetary value: scores, segments and cohorts of customers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import elapsed_days, exact_mean, exact_sum
from tradewind.operators.binning import cut_score, distinct_edges, even_probabilities, value_score
from tradewind.operators.ordering import exact_quantiles, quantiles_and_cuts
from tradewind.operators.ranking import value_counts, with_share
from tradewind.sources.staging import stage

CUSTOMER = "customer_unique_id"

# Fixed values: (segment, {score: (lowest, highest)}); the first rule that fits decides.
SEGMENTS_V1 = (
    ("Champions", {"r": (5, 5), "f": (5, 5), "m": (5, 5)}),
    ("Loyal Customers", {"r": (5, 5), "f": (5, 5)}),
    ("New High-Value", {"r": (5, 5), "m": (5, 5)}),
    ("Promising", {"r": (5, 5), "f": (3, 5)}),
    ("Potential Loyalists", {"r": (4, 5), "f": (4, 5)}),
    ("At-Risk", {"r": (1, 2), "f": (4, 5), "m": (4, 5)}),
    ("Lost Customers", {"r": (1, 2), "f": (1, 2), "m": (1, 2)}),
    ("Hibernating", {"r": (1, 2)}),
)
SEGMENTS_V2 = (
    ("Champions", {"r": (5, 5), "f": (5, 5), "m": (5, 5)}),
    ("Loyal Customers", {"r": (5, 5), "f": (5, 5)}),
    ("Big Spenders", {"r": (5, 5), "m": (5, 5)}),
    ("New Customers", {"r": (5, 5), "f": (3, 5)}),
    ("Promising", {"r": (4, 5), "f": (4, 5)}),
    ("At Risk", {"r": (1, 2), "f": (4, 5)}),
    ("Lost Customers", {"r": (1, 2), "f": (1, 2)}),
    ("Potential Loyalists", {"r": (4, 5), "m": (4, 5)}),
)
OTHER_SEGMENT = "Others"
HIGH_VALUE_SEGMENTS = ("Champions", "Loyal Customers", "Big Spenders")


def segment(rules: Sequence[tuple[str, Mapping[str, tuple[int, int]]]], scores: Mapping[str, str]) -> Column:
    """The name of the first rule all of whose score ranges hold; `scores` maps r, f, m to columns."""
    chosen = F
    for name, ranges in rules:
        fits = reduce(lambda a, b: a & b, [F.col(scores[s]).between(*span) for s, span in ranges.items()])
        chosen = chosen.when(fits, name)
    return chosen.otherwise(OTHER_SEGMENT)


def customer_metrics(
    df: DataFrame, money: str, offset_days: int, customer: str = CUSTOMER,
    moment: str = "order_purchase_timestamp", order: str = "order_id",
) -> DataFrame:
    """One staged row per customer: last purchase, recency, frequency, monetary value.

    Recency counts from the latest purchase of the whole table plus `offset_days`. It is
    the latest of the last purchases, so the facts are read once only.
    """
    customers = df.where(F.col(customer).isNotNull()).groupBy(customer).agg(
        F.max(moment).alias("last_purchase_date"),
        F.count_distinct(order).alias("frequency"),
        exact_sum(money, wide=money == "payment_value").alias("monetary"),
    )
    customers = stage(customers, "customers")
    latest = customers.agg(F.max("last_purchase_date")).first()[0]
    if latest is None:
        return customers.withColumn("recency", F.lit(None).cast("int"))
    reference = F.lit(latest + timedelta(days=offset_days)).cast("timestamp_ntz")
    return customers.withColumn("recency", elapsed_days("last_purchase_date", reference))


def _edges(df: DataFrame, columns: Sequence[str], bins: int) -> dict[str, list[float]]:
    return exact_quantiles(df, {name: even_probabilities(bins) for name in columns})


def _code(*scores: str) -> Column:
    return F.concat(*[F.col(score).cast("string") for score in scores])


def rfm_v1(df: DataFrame, bins: int = 5, **columns: str) -> DataFrame:
    """All three scores are value bins.

    Equal edges are merged for frequency and money, whose highest score is then lower
    than `bins`; for recency they raise.
    """
    metrics = customer_metrics(df, "payment_value", 1, **columns)
    edges = _edges(metrics, ["recency", "frequency", "monetary"], bins)
    scored = metrics.withColumns({
        "R_Score": value_score("recency", distinct_edges(edges["recency"]), descending=True),
        "F_Score": value_score("frequency", distinct_edges(edges["frequency"], "drop")),
        "M_Score": value_score("monetary", distinct_edges(edges["monetary"], "drop")),
    })
    return scored.select(
        columns.get("customer", CUSTOMER), "recency", "frequency", "monetary", "R_Score", "F_Score", "M_Score",
        _code("R_Score", "F_Score", "M_Score").alias("RFM_Segment"),
        segment(SEGMENTS_V1, {"r": "R_Score", "f": "F_Score", "m": "M_Score"}).alias("Customer_Segment"))


def rfm_v2(df: DataFrame, bins: int = 5, **columns: str) -> DataFrame:
    """Recency in value bins; frequency and money in bins of ranks, ties by customer."""
    customer = columns.get("customer", CUSTOMER)
    metrics = customer_metrics(df, "payment_value", 1, **columns)
    edges, cuts = quantiles_and_cuts(
        metrics, {"recency": even_probabilities(bins)}, ["frequency", "monetary"], customer, bins)
    scored = metrics.withColumns({
        "R_score": value_score("recency", distinct_edges(edges["recency"]), descending=True),
        "F_score": cut_score("frequency", customer, cuts["frequency"]),
        "M_score": cut_score("monetary", customer, cuts["monetary"]),
    })
    return scored.select(
        customer, "last_purchase_date", "frequency", F.col("monetary").alias("monetary_value"), "recency",
        "R_score", "F_score", "M_score", _code("R_score", "F_score", "M_score").alias("RFM_score"),
        segment(SEGMENTS_V2, {"r": "R_score", "f": "F_score", "m": "M_score"}).alias("RFM_segment"))


def rfm_v3(df: DataFrame, bins: int = 4, **columns: str) -> DataFrame:
    """Item revenue as money, recency from the latest purchase itself, four bins."""
    customer = columns.get("customer", CUSTOMER)
    metrics = customer_metrics(df, "item_total_revenue", 0, **columns)
    even = even_probabilities(bins)
    edges, cuts = quantiles_and_cuts(metrics, {"recency": even, "monetary": even}, ["frequency"], customer, bins)
    scored = metrics.withColumns({
        "r_score": value_score("recency", distinct_edges(edges["recency"]), descending=True),
        "f_score": cut_score("frequency", customer, cuts["frequency"]),
        "m_score": value_score("monetary", distinct_edges(edges["monetary"])),
    })
    return scored.select(
        F.col(customer).alias("customer_id"), "recency", "frequency", "monetary", "r_score", "f_score", "m_score",
        _code("r_score", "f_score", "m_score").alias("rfm_segment"))


def segment_profile(rfm: DataFrame) -> DataFrame:
    """Mean recency, frequency and money, and the number of customers, per segment (v2)."""
    return rfm.groupBy("RFM_segment").agg(
        exact_mean("recency").alias("Avg_Recency"), exact_mean("frequency").alias("Avg_Frequency"),
        exact_mean("monetary_value").alias("Avg_Monetary_Value"), F.count(CUSTOMER).alias("Num_Customers"))


def segment_counts(rfm: DataFrame, column: str = "RFM_segment") -> DataFrame:
    return value_counts(rfm, column, "Number_of_Customers")


def segment_share(rfm: DataFrame, column: str = "RFM_segment") -> DataFrame:
    return with_share(segment_counts(rfm, column), "Number_of_Customers")


def high_value_by_state(df: DataFrame, rfm: DataFrame, segments: Sequence[str] = HIGH_VALUE_SEGMENTS) -> DataFrame:
    """Distinct customers of the given segments per state.

    The facts are reduced to customer and state before they meet the segments.
    """
    places = df.select(CUSTOMER, "customer_state").where(F.col("customer_state").isNotNull()).distinct()
    chosen = rfm.where(F.col("RFM_segment").isin(list(segments))).select(CUSTOMER)
    return (
        places.join(chosen, CUSTOMER, "left_semi").groupBy("customer_state")
        .agg(F.count(CUSTOMER).alias("Unique_High_Value_Customers"))
    )


def score_crosstab(rfm: DataFrame, rows: str, columns: str, bins: int = 5, prefix: str | None = None) -> DataFrame:
    """Customers by two scores: a row per score 1..bins, a column per score, 0 where nobody is."""
    prefix = prefix or columns[0]
    scores = list(range(1, bins + 1))
    counted = rfm.groupBy(rows).pivot(columns, scores).agg(F.count(F.lit(1)))
    axis = rfm.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias(rows))
    return (
        axis.join(counted, rows, "left").na.fill(0)
        .withColumnsRenamed({str(score): f"{prefix}{score}" for score in scores})
    )


def segment_points(rfm: DataFrame, segments: Sequence[str] | None = None) -> DataFrame:
    """The coordinates of the customers of some segments, or of all."""
    points = rfm if segments is None else rfm.where(F.col("RFM_segment").isin(list(segments)))
    return points.select(CUSTOMER, "recency", "frequency", "monetary_value", "R_score", "M_score", "RFM_segment")


def top_customers(rfm: DataFrame, code: str = "444") -> DataFrame:
    return rfm.where(F.col("rfm_segment") == code)


def potential_b2b(rfm: DataFrame, min_frequency: int = 10, min_monetary: float = 5000) -> DataFrame:
    return rfm.where((F.col("frequency") > min_frequency) | (F.col("monetary") > min_monetary))


def at_risk(rfm: DataFrame, days: int = 90) -> DataFrame:
    """Customers without a purchase for more than `days` days; 180 gives the lost ones."""
    return rfm.where(F.col("recency") > days)


def loyal(rfm: DataFrame, min_frequency: int = 3, days: int = 30) -> DataFrame:
    return rfm.where((F.col("frequency") > min_frequency) & (F.col("recency") < days))


def churn_cohorts(rfm: DataFrame) -> DataFrame:
    """Sizes of the at-risk, lost and loyal cohorts, counted in one pass."""
    recency, frequency = F.col("recency"), F.col("frequency")
    counts = rfm.agg(
        F.count_if(recency > 90).alias("at_risk"), F.count_if(recency > 180).alias("lost"),
        F.count_if((frequency > 3) & (recency < 30)).alias("loyal"))
    return counts.unpivot([], ["at_risk", "lost", "loyal"], "cohort", "customers")
