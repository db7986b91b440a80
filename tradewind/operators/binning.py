"""Quantile scores: bins over values and bins over ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def even_probabilities(bins: int) -> list[float]:
    """0, 1/bins, ..., 1."""
    return [i / bins for i in range(bins + 1)]


def distinct_edges(edges: Sequence[float], on_duplicates: str = "raise") -> list[float]:
    """Edges of value bins. Equal neighbours raise, or are merged with `on_duplicates='drop'`."""
    merged = sorted(set(edges))
    if on_duplicates == "raise" and len(merged) < len(edges):
        raise ValueError(f"bin edges are not unique: {list(edges)}")
    if len(merged) < 2:
        raise ValueError(f"no bin is left between the edges {list(edges)}")
    return merged


def value_score(value: Column | str, edges: Sequence[float], descending: bool = False) -> Column:
    """1..k by the right-closed bin of `value`; the lowest edge belongs to the first bin.

    `descending` gives the lowest values the highest score.
    """
    value = F.col(value) if isinstance(value, str) else value
    above = sum((F.when(value > edge, 1).otherwise(0) for edge in edges[1:-1]), F.lit(0))
    score = F.lit(len(edges) - 1) - above if descending else above + 1
    return F.when(value.isNotNull(), score).cast("int")


def rank_score(row_number: Column | str, rows: int, bins: int) -> Column:
    """1..bins by the quantile bin of a rank 1..`rows`.

    The rank r lies in bin ceil(bins*(r-1)/(rows-1)), and rank 1 in the first. `ntile`
    would spread the remainder of rows/bins differently. A single row scores 1.
    """
    row_number = F.col(row_number) if isinstance(row_number, str) else row_number
    if rows == 1:
        return F.when(row_number.isNotNull(), 1).cast("int")
    above = F.lit(bins).cast("bigint") * (row_number - 1)
    return F.greatest(F.lit(1), F.ceil(above / F.lit(rows - 1))).cast("int")


def cut_score(value: Column | str, by: Column | str, cuts: Sequence[tuple[float, object]]) -> Column:
    """1..k by the rank bin of a row, from the last (value, by) of each bin but the highest.

    The same bins as `rank_score`, without a rank: rows are compared with the cuts. A cut
    without `by` lies above all rows of its value. NULL for a row without a value or `by`.
    """
    value, by = (F.col(column) if isinstance(column, str) else column for column in (value, by))
    number = value.cast("double")
    score = F.lit(1)
    for last, last_by in cuts:
        above = number > F.lit(last)
        if last_by is not None:
            above = above | ((number == F.lit(last)) & (by > F.lit(last_by)))
        score = score + F.when(above, 1).otherwise(0)
    return F.when(value.isNotNull() & by.isNotNull(), score).cast("int")
