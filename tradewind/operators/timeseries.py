"""Daily series: totals, dense calendar, weekly and monthly resampling, hold-out split.

A series is one row per day, so whatever runs over a whole series is bounded by the
calendar, not by the data. `series` names key columns for several series at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions import exact_sum, month_end, week_end


def daily_sales(df: DataFrame, moment: str = "order_purchase_timestamp", money: str = "item_total_revenue",
                series: Sequence[str] = ()) -> DataFrame:
    day = F.to_date(moment).alias("order_date")
    return df.where(F.col(moment).isNotNull()).groupBy(*series, day).agg(exact_sum(money).alias("total_sales"))


def dense_calendar(daily: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Every day from the first to the last of a series; 0 where there was none."""
    span = daily.groupBy(*series).agg(F.min("order_date").alias("_first"), F.max("order_date").alias("_last"))
    days = span.where(F.col("_first").isNotNull()).select(
        *series, F.explode(F.sequence("_first", "_last", F.expr("INTERVAL 1 DAY"))).alias("order_date"))
    return days.join(daily, [*series, "order_date"], "left").na.fill(0.0, subset=["total_sales"])


def _resampled(daily: DataFrame, label: Column, series: Sequence[str]) -> DataFrame:
    return daily.groupBy(*series, label.alias("order_date")).agg(exact_sum("total_sales").alias("total_sales"))


def weekly_sales(daily: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Sums of a dense series by week, labelled by the Sunday that ends it."""
    return _resampled(daily, week_end("order_date"), series)


def monthly_sales(daily: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Sums of a dense series by month, labelled by its last day."""
    return _resampled(daily, month_end("order_date"), series)


def with_split(daily: DataFrame, fraction: float = 0.8, series: Sequence[str] = ()) -> DataFrame:
    """Mark the first `fraction` of the days of a series as 'train', the rest as 'test'."""
    whole = Window.partitionBy(*series)
    place = F.row_number().over(whole.orderBy("order_date"))
    size = F.floor(F.count("*").over(whole) * F.lit(fraction))
    return daily.withColumn("split", F.when(place <= size, "train").otherwise("test"))
