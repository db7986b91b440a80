import datetime as dt
import itertools
import math

import numpy as np
import pytest

from tradewind.operators import estimate
from tradewind.operators import forecast as hw
from tradewind.operators import ranking
from tradewind.operators import timeseries as ts

D = dt.date


def daily(spark, values, start=D(2018, 1, 1)):
    return spark.createDataFrame(
        [(start + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)], "order_date DATE, total_sales DOUBLE")


def test_gaps_become_zero(spark, rows):
    df = spark.createDataFrame([(D(2018, 1, 1), 1.0), (D(2018, 1, 4), 2.0)], "order_date DATE, total_sales DOUBLE")
    assert [row[1] for row in rows(ts.dense_calendar(df))] == [1.0, 0.0, 0.0, 2.0]


def test_gaps_of_several_series(spark, rows):
    df = spark.createDataFrame([("a", D(2018, 1, 1), 1.0), ("a", D(2018, 1, 3), 2.0), ("b", D(2018, 1, 9), 3.0)],
                               "s STRING, order_date DATE, total_sales DOUBLE")
    assert rows(ts.dense_calendar(df, ["s"])) == [
        ("a", D(2018, 1, 1), 1.0), ("a", D(2018, 1, 2), 0.0), ("a", D(2018, 1, 3), 2.0), ("b", D(2018, 1, 9), 3.0)]


def test_weeks_end_on_sunday_and_months_on_their_last_day(spark, rows):
    df = spark.createDataFrame([(D(2018, 1, 7), 1.0), (D(2018, 1, 8), 2.0), (D(2018, 2, 1), 4.0)],
                               "order_date DATE, total_sales DOUBLE")
    assert rows(ts.weekly_sales(df)) == [(D(2018, 1, 7), 1.0), (D(2018, 1, 14), 2.0), (D(2018, 2, 4), 4.0)]
    assert rows(ts.monthly_sales(df)) == [(D(2018, 1, 31), 3.0), (D(2018, 2, 28), 4.0)]


@pytest.mark.parametrize("n, train", [(1, 0), (5, 4), (11, 8), (35, 28)])
def test_split(spark, n, train):
    marked = ts.with_split(daily(spark, range(n)))
    assert marked.where("split = 'train'").count() == train


def test_arg_max_takes_the_first_of_equal_values(spark):
    df = spark.createDataFrame([("b", 5.0), ("a", 5.0), ("d", 1.0), ("c", 1.0)], "k STRING, v DOUBLE")
    assert [tuple(r) for r in ranking.best_and_worst(df, "v", "k").collect()] == [("a", 5.0, "best"), ("c", 1.0, "worst")]


def recursion(values, alpha, beta, gamma, m=7):
    level = sum(values[:m]) / m
    trend = (sum(values[m:2 * m]) / m - level) / m
    season = [v - level for v in values[:m]]
    fits, sse = [], 0.0
    for y in values:
        s, expected = season.pop(0), level + trend
        fits.append(expected + s)
        sse += (y - fits[-1]) ** 2
        new = alpha * (y - s) + (1 - alpha) * expected
        season.append(gamma * (y - expected) + (1 - gamma) * s)
        level, trend = new, beta * (new - level) + (1 - beta) * trend
    return level, trend, season, sse, fits


VALUES = [100 + 0.5 * i + 20 * math.sin(2 * math.pi * i / 7) + (i * 37 % 11) for i in range(90)]


def test_smoothing(spark):
    train = daily(spark, VALUES)
    models = hw.smooth(train, 0.3, 0.1, 0.2)
    level, trend, season, sse, fits = recursion(VALUES, 0.3, 0.1, 0.2)
    row = models.first()
    assert (row.level, row.trend, row.sse) == pytest.approx((level, trend, sse))
    assert row.season == pytest.approx(season)
    ours = hw.fitted(train, models).orderBy("order_date").collect()
    assert [r.fitted for r in ours] == pytest.approx(fits)
    assert (ours[0].order_date, ours[-1].order_date) == (D(2018, 1, 1), D(2018, 3, 31))
    ahead = hw.forecast(models, 16, 3).orderBy("order_date").collect()
    assert [r.predicted for r in ahead] == pytest.approx([level + h * trend + season[(h - 1) % 7] for h in range(3, 17)])
    assert ahead[0].order_date == D(2018, 4, 3)


def test_fit_has_the_least_error_of_its_grid(spark):
    model = hw.fit(daily(spark, VALUES), fine_steps=None, start="means").first()
    errors = {(a, b, g): recursion(VALUES, a, b, g)[3] for a in hw.ALPHAS for b in hw.BETAS for g in hw.GAMMAS}
    assert (model.alpha, model.beta, model.gamma) == min(errors, key=errors.get)
    assert hw.fit(daily(spark, VALUES), start="means").first().sse <= model.sse


def test_fit_of_several_series(spark):
    a, b, short = daily(spark, VALUES), daily(spark, VALUES[::-1]), daily(spark, VALUES[:13])
    train = a.selectExpr("'a' AS s", "*").union(b.selectExpr("'b' AS s", "*")).union(short.selectExpr("'c' AS s", "*"))
    models = {row.s: row for row in hw.fit(train, ["s"]).collect()}
    assert models["a"].sse == pytest.approx(hw.fit(a).first().sse)
    assert models["c"].alpha is None and "two periods" in models["c"].reason
    assert {r.s for r in hw.forecast(hw.fit(train, ["s"]), 2, series=["s"]).collect()} == {"a", "b"}


def test_accuracy_skips_days_without_sales(spark):
    def scores(pairs):
        df = spark.createDataFrame([(float(a), float(p)) for a, p in pairs], "actual DOUBLE, predicted DOUBLE")
        return tuple(hw.accuracy(df).first())

    assert scores([(0, 3), (10, 14)]) == pytest.approx((math.sqrt(12.5), 40.0))
    assert scores([(0, 3), (0, 4)])[1] == 0.0


def test_summary_of_a_short_forecast_has_no_months(spark):
    predicted = daily(spark, range(10)).withColumnRenamed("total_sales", "predicted")
    row = hw.summary(predicted).first()
    assert (row.total_forecast, row.direction, row.peak_month) == (45.0, "increasing", None)


# ---------------------------------------------------------------- estimated starting states

def fits_from(values, parameters, states, m=7):
    """One-step errors of the recursion from given states: level, trend, m seasons."""
    (alpha, beta, gamma), level, trend, season = parameters, states[0], states[1], list(states[2:])
    errors = []
    for y in values:
        s, expected = season.pop(0), level + trend
        errors.append(y - expected - s)
        new = alpha * (y - s) + (1 - alpha) * expected
        season.append(gamma * (y - expected) + (1 - gamma) * s)
        level, trend = new, beta * (new - level) + (1 - beta) * trend
    return np.array(errors)


def least_squares(values, parameters, m=7):
    """The best states and error by running the recursion from every unit vector."""
    base = fits_from(values, parameters, np.zeros(m + 2))
    units = np.eye(m + 2)[:m + 1]
    units[2:, -1] = -1
    slopes = np.array([base - fits_from(values, parameters, unit) for unit in units]).T
    found, *_ = np.linalg.lstsq(slopes, base, rcond=1e-12)
    return np.append(found, -found[2:].sum()), ((base - slopes @ found) ** 2).sum()


@pytest.mark.parametrize("parameters", [(0.3, 0.1, 0.2), (0.0, 0.0, 0.0), (1.0, 1.0, 1.0), (0.05, 0.9, 0.6)])
def test_states_are_the_least_squares_ones(parameters):
    series = [np.array(VALUES[:n]) for n in (14, 15, 50, 90)]
    for values, states in zip(series, estimate.states_for(series, 7, parameters)):
        best, error = least_squares(values, parameters)
        assert (fits_from(values, parameters, states) ** 2).sum() == pytest.approx(error, rel=1e-7, abs=1e-6)
        assert states[2:].sum() == pytest.approx(0, abs=1e-8)


def test_derivatives_are_those_of_small_steps():
    values, days, parameters = np.array([VALUES]), np.array([90]), np.array([[0.3, 0.1, 0.2]])
    states = estimate.best_states(values, days, 7, parameters)[0]
    products, slopes = estimate.derivatives(values, days, 7, parameters, states)

    def errors(p, x):
        return fits_from(VALUES, p, np.append(x, -x[2:].sum()))

    start, step = np.concatenate([parameters[0], states[0]]), 1e-6
    by_hand = np.array([(errors((start + step * unit)[:3], (start + step * unit)[3:])
                         - errors((start - step * unit)[:3], (start - step * unit)[3:])) / (2 * step) for unit in np.eye(len(start))])
    assert products[0] == pytest.approx(by_hand @ by_hand.T, rel=1e-4, abs=1e-4)
    assert slopes[0] == pytest.approx(by_hand @ errors(start[:3], start[3:]), rel=1e-3, abs=1e-2)


def test_estimated_fit_against_a_dense_grid():
    rng = np.random.default_rng(4)
    level = np.cumsum(rng.normal(size=80))
    series = [np.array(VALUES), 50 + level * 3 + 8 * np.sin(np.arange(80) * 2 * np.pi / 7) + rng.normal(size=80),
              rng.normal(size=40) * 1e6, np.zeros(20), np.full(33, 7.0), np.array(VALUES[:14])]
    found, states, from_grid = estimate.estimated(series, 7, (hw.ALPHAS, hw.BETAS, hw.GAMMAS), hw.FINE_STEPS)
    ticks = np.linspace(0, 1, 9)
    for values, parameters, start, grid in zip(series, found, states, from_grid):
        own = (fits_from(values, parameters, start) ** 2).sum()
        size = 1e-9 * (1 + (values ** 2).sum())
        # Beyond gamma = 1 - alpha old states grow, and the least error is that of an unstable recursion.
        every = min(least_squares(values, p)[1] for p in itertools.product(ticks, ticks, ticks) if p[0] + p[2] <= 1)
        assert own <= every * 1.001 + size and own <= grid + size
        assert (parameters >= 0).all() and (parameters <= 1).all()


def test_estimated_fit_of_several_series(spark):
    a, b, short = daily(spark, VALUES), daily(spark, VALUES[40:]), daily(spark, VALUES[:13])
    train = a.selectExpr("'a' AS s", "*").union(b.selectExpr("'b' AS s", "*")).union(short.selectExpr("'c' AS s", "*"))
    models = {row.s: row for row in hw.fit(train, ["s"]).collect()}
    assert models["c"].alpha is None and models["c"].start_season is None and "two periods" in models["c"].reason
    for name, values in (("a", VALUES), ("b", VALUES[40:])):
        row = models[name]
        errors = fits_from(values, (row.alpha, row.beta, row.gamma), [row.start_level, row.start_trend, *row.start_season])
        assert row.sse == pytest.approx((errors ** 2).sum()) and row.sse <= row.grid_sse
        fits = hw.fitted(train, hw.fit(train, ["s"]), ["s"]).where(f"s = '{name}'").orderBy("order_date").collect()
        assert [y - f.fitted for y, f in zip(values, fits)] == pytest.approx(errors.tolist())
    with pytest.raises(ValueError):
        hw.fit(a, start="none")


def test_estimated_fit_of_nothing(spark):
    assert hw.fit(daily(spark, []).selectExpr("'a' AS s", "*"), ["s"]).collect() == []
    assert hw.fit(daily(spark, VALUES[:13])).first().reason is not None
