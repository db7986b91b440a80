"""Exact global positions, quantiles and rank scores without a global sort in one task.

A window without PARTITION BY, and the exact `percentile` aggregate, both bring a
whole column into one task. Quantiles and the limits of rank bins are selected by counting
(`selection.py`), which moves no row.

Where every row needs its number, the table is range-partitioned, at every size: each
task sorts its own range, and only the size of each range is gathered. The ranged rows are
staged together with the number of their range, so the pass that sizes the ranges and the
pass that uses the sizes see the same ranges even if an executor is lost in between.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.operators.selection import Lane, Selected, order_statistics
from tradewind.sources.staging import stage

# monotonically_increasing_id() is the partition number shifted by 33 bits plus the
# position of the row in its partition.
_POSITION_BITS = 33


def with_row_number(
    df: DataFrame, order_by: Sequence[Column | str], name: str = "row_number",
) -> DataFrame:
    """Number all rows 1..n by `order_by`, which has to identify a row."""
    order = [F.col(column) if isinstance(column, str) else column for column in order_by]
    placed = (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = stage(placed, "ranged").withColumn("_range", F.shiftright("_place", _POSITION_BITS))
    lower = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("_range").agg(F.count("*").alias("_rows")).select(
        "_range", F.coalesce(F.sum("_rows").over(lower), F.lit(0)).alias("_before"))
    position = F.col("_place") - F.shiftleft("_range", _POSITION_BITS)
    return (
        placed.join(F.broadcast(before), "_range")  # one row per shuffle partition
        .withColumn(name, F.col("_before") + position + 1)
        .select(*df.columns, name)
    )


def exact_quantiles(
    df: DataFrame, probabilities: Mapping[str, Sequence[float]], weight: str | None = None,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of several columns, NULLs left out.

    `probabilities` maps a column to the wanted probabilities. The result, a handful of
    numbers, is returned to the driver. A column without values gives None. With a column
    `weight` a row counts that often. `df` should be staged.
    """
    return quantiles_and_cuts(df, probabilities, weight=weight)[0]


def quantiles_and_cuts(
    df: DataFrame, probabilities: Mapping[str, Sequence[float]], ranked: Sequence[str] = (), by: str | None = None,
    bins: int = 5, weight: str | None = None,
) -> tuple[dict[str, list[float | None]], dict[str, list[tuple[float, object]]]]:
    """Quantiles of some columns, and for others the cuts between `bins` bins of their ranks, in the same passes.

    Ranks count from the least value, equal values by the column `by`, which is BIGINT or text and
    tells rows apart. The cut above a bin is its last (value, by), for `rank_score`; `by` is None
    where the bin ends with the last of equal values. Values are taken as DOUBLE. `weight` is
    for the quantiles only.
    """
    def around(wanted: Sequence[float]):
        return lambda rows: [at for p in wanted for at in _neighbours(p * (rows - 1))]

    def last_of_bins(rows: int) -> list[int]:
        # Rank r, from 1, lies in bin ceil(bins * (r - 1) / (rows - 1)), and rank 1 in the first.
        return [k * (rows - 1) // bins for k in range(1, bins)] if rows > 1 else []

    times = F.col(weight) if weight else None
    lanes = [Lane(F.col(name).cast("double"), around(wanted), times) for name, wanted in probabilities.items()]
    identified = F.col(by).isNotNull() if by else F.lit(True)
    lanes += [Lane(F.when(identified, F.col(name).cast("double")), last_of_bins) for name in ranked]
    found = order_statistics(df, lanes)
    quantiles = {
        name: [_interpolated(selected, p) for p in wanted]
        for (name, wanted), selected in zip(probabilities.items(), found)}
    ranks = dict(zip(ranked, found[len(probabilities):]))
    # Where equal values lie on both sides of a cut, the ids decide.
    ties: dict[tuple[str, float], list[int]] = {}
    for name, selected in ranks.items():
        for position, value in selected.at.items():
            if position < value.before + value.rows - 1:
                ties.setdefault((name, value.key), []).append(position - value.before)
    inside = order_statistics(df, [
        Lane(F.when(F.col(name).cast("double") == F.lit(value), F.col(by)), lambda rows, wanted=wanted: wanted)
        for (name, value), wanted in ties.items()])
    ids = {key: selected.at for key, selected in zip(ties, inside)}

    def cut(name: str, position: int) -> tuple[float, object]:
        value = ranks[name].at[position]
        last = position == value.before + value.rows - 1
        return value.key, None if last else ids[name, value.key][position - value.before].key

    # A bin may be empty; then its cut is that of the bin below.
    return quantiles, {name: [cut(name, at) for at in last_of_bins(selected.rows)] for name, selected in ranks.items()}


def _interpolated(found: Selected, p: float) -> float | None:
    if not found.rows:
        return None
    at = p * (found.rows - 1)
    low, high = _neighbours(at)
    below, above = found.at[low].key, found.at[high].key
    return below if below == above else (high - at) * below + (at - low) * above


def _neighbours(at: float) -> tuple[int, int]:
    return math.floor(at), math.ceil(at)
