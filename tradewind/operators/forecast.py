"""Additive Holt-Winters smoothing of many series side by side.

A smoothing is sequential in time but independent between series. A series is one row
with its days in an array (bounded by the calendar, not by the sales behind it), and
the recursion is a fold over that array. With level l, trend b and the seasonal value s
of one period ago:

    l' = alpha (y - s) + (1 - alpha) (l + b)
    b' = beta (l' - l) + (1 - beta) b
    s' = gamma (y - l - b) + (1 - gamma) s

A series is fitted to the least sum of squared one-step errors. By default its starting
states are estimated together with the parameters (`estimate.py`). With `start='means'` it starts
from the means of the first two periods, and its parameters are the best of a coarse grid
and of a fine one around the winner.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import year_month
from tradewind.operators import estimate

ALPHAS = (0.05, 0.1, 0.2, 0.4, 0.6, 0.8)
BETAS = (0.0, 0.01, 0.05, 0.1, 0.2)
GAMMAS = (0.0, 0.05, 0.1, 0.2, 0.4, 0.6)
FINE_STEPS = ((-0.04, -0.02, 0.0, 0.02, 0.04), (-0.01, -0.005, 0.0, 0.005, 0.01),
              (-0.04, -0.02, 0.0, 0.02, 0.04))
PERIOD = 7

_START = ("_level", "_trend", "_season")


def _series_rows(train: DataFrame, period: int, series: Sequence[str]) -> DataFrame:
    """A row per series: its values in date order, starting states, and why it cannot be fitted."""
    days = F.sort_array(F.collect_list(F.struct("order_date", "total_sales")))
    rows = train.groupBy(*series).agg(days.alias("_days"), F.count("*").cast("int").alias("n_train"),
                                      F.max("order_date").alias("last_date"))
    values = F.transform("_days", lambda day: day["total_sales"])

    def mean_of(start: int) -> Column:
        return F.aggregate(F.slice("_values", start, period), F.lit(0.0), lambda a, x: a + x) / period

    long_enough = F.col("n_train") >= 2 * period
    level = mean_of(1)
    return rows.where("n_train > 0").withColumn("_values", values).drop("_days").withColumns({
        "_level": F.when(long_enough, level),
        "_trend": F.when(long_enough, (mean_of(period + 1) - level) / period),
        "_season": F.when(long_enough, F.transform(F.slice("_values", 1, period), lambda y: y - level)),
        "reason": F.when(~long_enough, "series is shorter than two periods"),
    })


def _smooth(period: int, alpha: Column, beta: Column, gamma: Column, keep_fits: bool = False) -> Column:
    """The states after the last day, the squared error, and on request the one-step fits."""
    start = F.struct(
        F.col("_level").alias("level"), F.col("_trend").alias("trend"), F.col("_season").alias("season"),
        F.lit(0.0).alias("sse"), *([F.array().cast("array<double>").alias("fits")] if keep_fits else []))

    def step(state: Column, y: Column) -> Column:
        past = state["season"][0]
        expected = state["level"] + state["trend"]
        level = alpha * (y - past) + (1 - alpha) * expected
        error = y - (expected + past)
        fields = [
            level.alias("level"),
            (beta * (level - state["level"]) + (1 - beta) * state["trend"]).alias("trend"),
            F.concat(F.slice(state["season"], 2, period - 1),
                     F.array(gamma * (y - expected) + (1 - gamma) * past)).alias("season"),
            (state["sse"] + error * error).alias("sse"),
        ]
        if keep_fits:
            fields.append(F.concat(state["fits"], F.array(expected + past)).alias("fits"))
        return F.struct(*fields)

    return F.aggregate("_values", start, step)


def _starting_at(rows: DataFrame, found: Column) -> DataFrame:
    """Rows with parameters and starting states as found by a function over the values; NULL for short series."""
    return rows.withColumn("_found", found).select(
        *[F.col(name) for name in rows.columns if name not in _START], "_found.*")


def _grid_search(period: int, coarse: Sequence[Sequence[float]], fine: Sequence[Sequence[float]] | None):
    """A column function from the values of a series to the best parameters of the grid.

    The recursion cannot be vectorised over time, and folding an array once per parameter
    set costs some microseconds per day and set in interpreted expressions. Arrow batches
    of series, with NumPy running all sets of all series side by side, cost a small part of that.
    """
    @F.pandas_udf("alpha DOUBLE, beta DOUBLE, gamma DOUBLE")
    def best(values: pd.Series, long_enough: pd.Series) -> pd.DataFrame:
        found = pd.DataFrame(None, index=values.index, columns=["alpha", "beta", "gamma"], dtype="float64")
        for at, padded, days in estimate.blocks(list(values[long_enough])):
            found.loc[values.index[long_enough][at]] = estimate.best_of_grid(padded, days, period, coarse, fine)[0]
        return found

    return best


_FOUND = "alpha DOUBLE, beta DOUBLE, gamma DOUBLE, _level DOUBLE, _trend DOUBLE, _season ARRAY<DOUBLE>, grid_sse DOUBLE"


def _estimation(period: int, coarse: Sequence[Sequence[float]], fine: Sequence[Sequence[float]] | None,
                given: Sequence[float] | None = None):
    """A column function from the values of a series to its parameters and starting states.

    With `given` parameters only the states are estimated, and there is no `grid_sse`.
    """
    @F.pandas_udf(_FOUND)
    def best(values: pd.Series, long_enough: pd.Series) -> pd.DataFrame:
        rows = [(None,) * 7] * len(values)
        chosen = [i for i, enough in enumerate(long_enough) if enough]
        series = [values.iloc[i] for i in chosen]
        if given is None:
            parameters, states, errors = estimate.estimated(series, period, coarse, fine)
        else:
            parameters, states = [given] * len(series), estimate.states_for(series, period, given)
            errors = [None] * len(series)
        for i, p, x, e in zip(chosen, parameters, states, errors):
            rows[i] = (*map(float, p), float(x[0]), float(x[1]), x[2:].tolist(), e)
        found = pd.DataFrame(rows, columns=[field.split()[0] for field in _FOUND.split(", ")])
        return found.astype({name: "float64" for name in found.columns if name != "_season"})

    return best


def _spread(rows: DataFrame, series: Sequence[str]) -> DataFrame:
    """Series over all tasks: a row is small, but its search is not, so partitions must not be merged by their bytes."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, *series) if series else rows


def fit(
    train: DataFrame, series: Sequence[str] = (), period: int = PERIOD,
    alphas: Sequence[float] = ALPHAS, betas: Sequence[float] = BETAS, gammas: Sequence[float] = GAMMAS,
    fine_steps: Sequence[Sequence[float]] | None = FINE_STEPS, start: str = "estimated",
) -> DataFrame:
    """A model row per dense training series.

    A series too short to fit has NULL parameters and a `reason`. With `start='estimated'` the
    column `grid_sse` has the error of `start='means'`, which `sse` does not exceed.
    """
    rows = _spread(_series_rows(train, period, series), series)
    enough = F.col("reason").isNull()
    if start == "means":
        found = _grid_search(period, (alphas, betas, gammas), fine_steps)("_values", enough)
        return _models(rows.withColumn("_best", found).select("*", "_best.*"), series, period)
    if start != "estimated":
        raise ValueError(f"start is 'estimated' or 'means', not {start!r}")
    found = _estimation(period, (alphas, betas, gammas), fine_steps)("_values", enough)
    return _models(_starting_at(rows, found), series, period)


def smooth(
    train: DataFrame, alpha: float, beta: float, gamma: float, series: Sequence[str] = (), period: int = PERIOD,
    start: str = "means",
) -> DataFrame:
    """Model rows with given parameters, from the means of the first periods or from estimated states."""
    rows = _series_rows(train, period, series)
    if start == "estimated":
        found = _estimation(period, (), None, (alpha, beta, gamma))("_values", F.col("reason").isNull())
        return _models(_starting_at(_spread(rows, series), found).drop("grid_sse"), series, period)
    if start != "means":
        raise ValueError(f"start is 'estimated' or 'means', not {start!r}")
    return _models(rows.withColumns({"alpha": F.lit(alpha), "beta": F.lit(beta), "gamma": F.lit(gamma)}), series, period)


def _models(rows: DataFrame, series: Sequence[str], period: int) -> DataFrame:
    state = F.when(F.col("reason").isNull(), _smooth(period, F.col("alpha"), F.col("beta"), F.col("gamma")))
    return rows.withColumn("_state", state).select(
        *series, "alpha", "beta", "gamma", "_state.level", "_state.trend", "_state.season", "_state.sse",
        "n_train", "last_date", "reason",
        *[F.when(F.col("reason").isNull(), F.col(name)).alias(f"start{name}") for name in _START],
        *[name for name in ("grid_sse",) if name in rows.columns])


def fitted(train: DataFrame, models: DataFrame, series: Sequence[str] = (), period: int = PERIOD) -> DataFrame:
    """The one-step fits of the training days the models were fitted to."""
    fittable = models.where("reason IS NULL").select(
        *series, "last_date", "alpha", "beta", "gamma", *[F.col(f"start{name}").alias(name) for name in _START])
    rows = _series_rows(train, period, series).drop("reason", *_START).join(fittable, [*series, "last_date"])
    fits = _smooth(period, F.col("alpha"), F.col("beta"), F.col("gamma"), keep_fits=True)["fits"]
    return (
        rows.select(*series, "last_date", "n_train", F.posexplode(fits).alias("_at", "fitted"))
        .select(*series, F.date_add("last_date", F.col("_at") + 1 - F.col("n_train")).alias("order_date"), "fitted")
    )


def forecast(models: DataFrame, last_step: int | Column, first_step: int | Column = 1,
             series: Sequence[str] = (), period: int = PERIOD) -> DataFrame:
    """Forecasts `first_step`..`last_step` days after the last training day."""
    first, last = (F.lit(step) if isinstance(step, int) else step for step in (first_step, last_step))
    steps = models.where("reason IS NULL").withColumn("_h", F.explode(F.sequence(first, last)))
    season = F.get("season", (F.col("_h") - 1) % period)
    return steps.select(
        *series, F.date_add("last_date", F.col("_h")).alias("order_date"),
        (F.col("level") + F.col("_h") * F.col("trend") + season).alias("predicted"))


def compare(test: DataFrame, predicted: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Actual and predicted values of the days that have both."""
    actual = test.select(*series, "order_date", F.col("total_sales").alias("actual"))
    both = actual.join(predicted, [*series, "order_date"])
    return both.na.drop(subset=["actual", "predicted"])


def accuracy(comparison: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """RMSE, and MAPE in percent over the days with an actual value other than 0 (0 without any)."""
    error = F.col("actual") - F.col("predicted")
    share = F.abs(error / F.nullif("actual", F.lit(0.0)))
    return comparison.groupBy(*series).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.coalesce(F.avg(share) * 100, F.lit(0.0)).alias("mape"))


def summary(predicted: DataFrame, series: Sequence[str] = (), min_days: int = 30) -> DataFrame:
    """Total, direction, and the months with the highest and the lowest forecast.

    The months are left NULL for a forecast of fewer than `min_days` days. Of equal
    months the earlier one is taken.
    """
    monthly = predicted.groupBy(*series, year_month("order_date").alias("month")).agg(
        F.sum("predicted").alias("_sum"), F.count("*").alias("_days"),
        F.min(F.struct("order_date", "predicted")).alias("_first"),
        F.max(F.struct("order_date", "predicted")).alias("_last"))
    whole = monthly.groupBy(*series).agg(
        F.sum("_sum").alias("total_forecast"), F.sum("_days").alias("_days"),
        F.min("_first").alias("_first"), F.max("_last").alias("_last"),
        F.min(F.struct(-F.col("_sum"), F.col("month").alias("month"), F.col("_sum").alias("sum"))).alias("_peak"),
        F.min(F.struct("_sum", F.col("month").alias("month"), F.col("_sum").alias("sum"))).alias("_trough"))
    enough = F.col("_days") >= min_days
    rising = F.col("_last.predicted") > F.col("_first.predicted")
    return whole.where("_days > 0").select(
        *series, "total_forecast", F.col("_first.predicted").alias("first_value"),
        F.col("_last.predicted").alias("last_value"),
        F.when(rising, "increasing").otherwise("decreasing").alias("direction"),
        F.when(enough, F.col("_peak.month")).alias("peak_month"),
        F.when(enough, F.col("_peak.sum")).alias("peak_value"),
        F.when(enough, F.col("_trough.month")).alias("trough_month"),
        F.when(enough, F.col("_trough.sum")).alias("trough_value"))
