"""Profiles of a table: shape, types, missing values, duplicate rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.fingerprint import duplicate_counts


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, and the number of rows of the table."""
    columns = F.array(*[
        F.struct(F.lit(field.name).alias("column_name"), F.lit(field.dataType.simpleString()).alias("data_type"))
        for field in df.schema.fields
    ])
    return (
        df.agg(F.count("*").alias("row_count"))
        .select(F.explode(columns).alias("column"), "row_count").select("column.*", "row_count")
    )


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: how many values are missing. One pass over the table."""
    counted = df.agg(*[F.count_if(F.col(f"`{name}`").isNull()).alias(name) for name in df.columns])
    return counted.unpivot([], df.columns, "column_name", "null_count")


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Rows, distinct rows, and the surplus. `df` is read twice."""
    return duplicate_counts(df)
