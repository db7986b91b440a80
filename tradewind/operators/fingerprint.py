"""Repeated rows by fingerprint: what is shuffled does not depend on the width of a row.

Every row gets 128 bits from all its columns, in two halves. Only the first half is counted;
rows for which it occurs once are repeated nowhere. The few others are compared in full, so two
different rows with one fingerprint stay two rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.sources.staging import stage

_HIGH, _LOW = "_fingerprint_high", "_fingerprint_low"
_SALT = 0x5DEECE66D


def fingerprint(columns: list[str]) -> tuple[Column, Column]:
    """Two BIGINTs of the values of `columns`; rows that GROUP BY takes for equal have equal ones."""
    values = [F.col(f"`{name}`") for name in columns]
    # A hash leaves NULLs out, so it is told where they are.
    masks = [
        sum((F.when(value.isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, value in enumerate(values[at:at + 60])), F.lit(0))
        for at in range(0, len(values), 60)]
    return F.xxhash64(*values, *masks), F.xxhash64(F.lit(_SALT), *masks, *values)


def with_fingerprint(df: DataFrame) -> DataFrame:
    high, low = fingerprint(df.columns)
    return df.withColumns({_HIGH: high, _LOW: low})


def _counted(df: DataFrame) -> DataFrame:
    """Rows per fingerprint; equal ones are combined before the shuffle."""
    return with_fingerprint(df).groupBy(_HIGH).agg(F.count("*").alias("_rows"))


def _split(df: DataFrame, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose fingerprint is not among `repeated`, and the distinct ones of the others."""
    marked = with_fingerprint(df).drop(_LOW)
    alone = marked.join(repeated, _HIGH, "left_anti").drop(_HIGH)
    return alone, marked.join(repeated, _HIGH, "left_semi").drop(_HIGH).dropDuplicates()


def distinct_rows(df: DataFrame) -> DataFrame:
    """`df` with one of each group of equal rows: `df` itself if it has no repeated row, a staged table otherwise.

    `df` is read twice or more and should be staged, or be a scan.
    """
    repeated = stage(_counted(df).where("_rows > 1").select(_HIGH), "repeated")
    if repeated.isEmpty():
        return df
    alone, others = _split(df, repeated)
    return stage(alone.unionByName(others), "distinct")


def duplicate_counts(df: DataFrame) -> DataFrame:
    """One row: `row_count`, `distinct_rows` and `duplicate_rows`, the rows beyond the first of their kind."""
    counted = stage(_counted(df), "counted")
    repeated = counted.where("_rows > 1").select(_HIGH)
    _, others = _split(df, repeated)
    alone = counted.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"), F.count_if(F.col("_rows") == 1).alias("_alone"))
    # Two sums of one row each, side by side.
    sides = alone.select("row_count", "_alone", F.lit(0).cast("bigint").alias("_others")).unionByName(
        others.agg(F.lit(0).cast("bigint").alias("row_count"), F.lit(0).cast("bigint").alias("_alone"), F.count("*").alias("_others")))
    return sides.agg(*[F.sum(name).alias(name) for name in sides.columns]).select(
        "row_count", (F.col("_alone") + F.col("_others")).alias("distinct_rows"),
        (F.col("row_count") - F.col("_alone") - F.col("_others")).alias("duplicate_rows"))
