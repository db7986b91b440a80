"""The three ways through the operators, from raw files to results."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators import forecast as hw
from tradewind.operators import timeseries as ts
from tradewind.operators.clean import clean
from tradewind.operators.denormalize import denormalize
from tradewind.sources import read_cleaned, read_raw_tables, stage, write_fact_table


def build_cleaned_table(spark: SparkSession, raw_paths: Mapping[str, str], cleaned_path: str) -> DataFrame:
    """Raw CSV files to the cleaned table, written as Parquet by month.

    The reviews of an order are joined in the order of their file.
    """
    tables = read_raw_tables(spark, raw_paths, {"reviews": "review_sequence"})
    write_fact_table(clean(denormalize(tables, review_sequence="review_sequence")), cleaned_path)
    return read_cleaned(spark, cleaned_path)


@dataclass
class SalesForecast:
    daily: DataFrame        # dense days with their split
    models: DataFrame       # fitted parameters and states
    fits: DataFrame         # one-step fits of the training days
    test: DataFrame         # actual and predicted, test days
    accuracy: DataFrame     # RMSE and MAPE over the test days
    future: DataFrame       # forecast after the last day
    summary: DataFrame      # totals and peaks of the future


def forecast_sales(facts: DataFrame, horizon: int = 365, fraction: float = 0.8) -> SalesForecast:
    """Daily revenue, 80/20 split, fit, test predictions and a forecast.

    The model is not refitted on the test days: the future starts after them, counted
    from the end of the training days.
    """
    daily = stage(ts.with_split(ts.dense_calendar(ts.daily_sales(facts)), fraction), "daily")
    train, test = daily.where("split = 'train'"), daily.where("split = 'test'")
    models = stage(hw.fit(train), "models")
    test_days = test.count()
    future = hw.forecast(models, test_days + horizon, test_days + 1)
    comparison = hw.compare(test, hw.forecast(models, max(test_days, 1)))
    return SalesForecast(
        daily.orderBy(F.col("order_date")), models, hw.fitted(train, models), comparison,
        hw.accuracy(comparison), future, hw.summary(future))
