"""Rankings. Ties are broken by the key columns, so every ranking is deterministic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def ranked(df: DataFrame, by: str, key: str | Sequence[str]) -> DataFrame:
    return df.orderBy(F.desc(by), *_names(key))


def top(df: DataFrame, by: str, key: str | Sequence[str], k: int) -> DataFrame:
    """The k rows with the highest `by`: a per-task heap, not a sort of all rows."""
    return ranked(df, by, key).limit(k)


def bottom(df: DataFrame, by: str, key: str | Sequence[str], k: int) -> DataFrame:
    """The last k rows of the ranking, in ranking order."""
    lowest = df.orderBy(F.asc(by), *[F.desc(name) for name in _names(key)]).limit(k)
    return ranked(lowest, by, key)


def best_and_worst(df: DataFrame, by: str, key: str) -> DataFrame:
    """The row with the highest and the one with the lowest `by`, marked by `kind`.

    Among equal values the first key wins both times. One aggregation finds both, so `df`
    is computed once.
    """
    row = F.struct(*df.columns).alias("row")
    found = df.where(F.col(by).isNotNull()).agg(
        F.min(F.struct(-F.col(by), F.col(key), row)).alias("best"),
        F.min(F.struct(F.col(by), F.col(key), row)).alias("worst"))
    kinds = F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.col(kind)["row"].alias("row")) for kind in ("best", "worst")])
    return (
        found.where("best IS NOT NULL").select(F.explode(kinds).alias("_found"))
        .select("_found.row.*", "_found.kind")
    )


def best_per_group(df: DataFrame, group: str, by: str, key: str | Sequence[str]) -> DataFrame:
    """The row with the highest `by` of each group.

    Spark keeps only the leading row of a group in every task before the shuffle, so
    the size of a group does not matter.
    """
    order = Window.partitionBy(group).orderBy(F.desc(by), *_names(key))
    return df.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")


def value_counts(df: DataFrame, column: str, count: str = "count") -> DataFrame:
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(count))
    return ranked(counted, count, column)


def with_share(df: DataFrame, value: str, share: str = "share_percent") -> DataFrame:
    """Each row's percentage of the total over the rows of `df`.

    `df` is a finished ranking of a few rows: they meet in one task, which saves computing
    the ranking a second time for its total.
    """
    total = F.sum(F.col(value).cast("decimal(38,6)")).over(Window.partitionBy()).cast("double")
    return df.withColumn(share, F.try_divide(F.col(value) * 100.0, total))
