"""Cleaning of the wide table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import normalized
from tradewind.operators.fingerprint import distinct_rows
from tradewind.operators.ordering import exact_quantiles
from tradewind.sources.staging import stage

# The columns that each step of the cleaning takes.
PAYMENT_COLUMNS = ("payment_sequential", "payment_type", "payment_installments", "payment_value")
MOMENT_COLUMNS = (
    "shipping_limit_date", "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
)
REQUIRED_MOMENTS = ("order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date")
MEDIAN_COLUMNS = (
    "product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g",
    "product_length_cm", "product_height_cm", "product_width_cm", "review_score",
    "customer_lat", "customer_lng", "seller_lat", "seller_lng",
)
TEXT_COLUMNS = (
    "product_category_name_english", "product_category_name", "customer_city", "customer_state",
    "seller_city", "seller_state", "payment_type", "order_status",
)
UNSIGNED_COLUMNS = ("price", "freight_value", "payment_value", "payment_installments", "review_score")
SIZE_COLUMNS = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
CAPPED_COLUMNS = ("price", "freight_value", "payment_value")


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One of each group of rows that are equal in all columns. `df` should be staged, or be a scan."""
    return distinct_rows(df)


def coerce_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """TIMESTAMP_NTZ; a text that is no timestamp becomes NULL."""
    return df.withColumns({name: F.col(name).try_cast("timestamp_ntz") for name in columns})


def coerce_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """DOUBLE; a text that is no number becomes NULL, and so does NaN."""
    numbers = {name: F.col(name).try_cast("double") for name in columns}
    return df.withColumns({name: F.when(~F.isnan(number), number) for name, number in numbers.items()})


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(values))


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill each column with its own median. `df` should be staged."""
    medians = exact_quantiles(df, {name: [0.5] for name in columns})
    return df.withColumns({
        name: F.coalesce(F.col(name).cast("double"), F.lit(median).cast("double"))
        for name, (median,) in medians.items()
    })


def normalize_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({name: normalized(name) for name in columns})


def make_positive(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({name: F.abs(name) for name in columns})


def zero_to_one(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """0 and NULL become 1 in every column that holds a value of 0 or less.

    Negative values stay. `df` should be staged: the minima are read first.
    """
    lowest = df.agg(*[F.min(name).alias(name) for name in columns]).first()
    return df.withColumns({
        name: F.when(F.col(name).isNull() | (F.col(name) == 0), 1).otherwise(F.col(name))
        .cast(df.schema[name].dataType)
        for name in columns if lowest[name] is not None and lowest[name] <= 0
    })


def iqr_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(Q1 - 1.5*IQR, Q3 + 1.5*IQR) per column that has values. `df` should be staged."""
    quartiles = exact_quantiles(df, {name: [0.25, 0.75] for name in columns})
    return {
        name: (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        for name, (q1, q3) in quartiles.items() if q1 is not None
    }


def cap_outliers(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Pull values outside the bounds to the nearer bound; NULL stays NULL."""
    return df.withColumns({
        name: F.when(F.col(name).isNotNull(), F.least(F.greatest(F.col(name), F.lit(low)), F.lit(high)))
        for name, (low, high) in bounds.items()
    })


def with_calendar(df: DataFrame, moment: str = "order_purchase_timestamp",
                  prefix: str = "order_purchase") -> DataFrame:
    """Year, month, day, day of week (Monday is 0) and hour."""
    return df.withColumns({
        f"{prefix}_year": F.year(moment),
        f"{prefix}_month": F.month(moment),
        f"{prefix}_day": F.dayofmonth(moment),
        f"{prefix}_day_of_week": F.weekday(moment),
        f"{prefix}_hour": F.hour(moment),
    })


def with_item_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("item_total_revenue", F.col("price") + F.col("freight_value"))


def clean(wide: DataFrame) -> DataFrame:
    """The cleaned table: 47 columns for the 41 of the wide one.

    The medians need the joined rows, so these are staged once rather than computed
    several times. Repeated rows, if there are any, are left out in a second staged table.
    """
    # The title is taken from the message, and the message keeps its NULLs; so the titles need not be joined and staged.
    columns = wide.columns
    if "review_comment_title" not in columns:
        columns.insert(columns.index("review_comment_message"), "review_comment_title")
    rows = drop_missing(wide.drop("review_comment_title"), PAYMENT_COLUMNS)
    rows = drop_missing(coerce_timestamps(rows, MOMENT_COLUMNS), REQUIRED_MOMENTS)
    rows = fill_median(stage(rows, "complete"), MEDIAN_COLUMNS)
    rows = fill_constants(rows, {"product_category_name": "unknown", "product_category_name_english": "unknown"})
    rows = rows.withColumn("review_comment_title", F.coalesce("review_comment_message", F.lit("no_comment"))).select(*columns)
    rows = make_positive(normalize_text(drop_duplicate_rows(rows), TEXT_COLUMNS), UNSIGNED_COLUMNS)
    rows = zero_to_one(rows, SIZE_COLUMNS)
    rows = cap_outliers(rows, iqr_bounds(rows, CAPPED_COLUMNS))
    return with_item_revenue(with_calendar(rows))
