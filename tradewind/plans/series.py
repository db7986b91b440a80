"""Registered queries: daily series and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewind.operators import forecast as hw
from tradewind.operators import timeseries as ts
from tradewind.plans.registry import define, dsum, query
from tradewind.plans.roles import role
from tradewind.plans.tables import facts
from tradewind.sources import stage

define("d_daily", f"""
    SELECT CAST(order_purchase_timestamp AS DATE) AS order_date, {dsum('price + freight_value')} AS total_sales
    FROM r_order_items i JOIN r_orders o ON i.order_id = o.order_id
    WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1""")
define("d_dense", """
    SELECT days.order_date, COALESCE(total_sales, 0) AS total_sales
    FROM (SELECT CAST(unnest(generate_series(MIN(order_date), MAX(order_date), INTERVAL 1 DAY)) AS DATE) AS order_date
          FROM d_daily) days
    LEFT JOIN d_daily ON d_daily.order_date = days.order_date""")
define("d_split", """
    SELECT *, row_number() OVER (ORDER BY order_date) AS t,
           CASE WHEN row_number() OVER (ORDER BY order_date) <= floor(COUNT(*) OVER () * 0.8)
                THEN 'train' ELSE 'test' END AS split FROM d_dense""")


def _daily(spark, sf_dir):
    return ts.daily_sales(facts(spark, sf_dir, "order"))


def _split(spark, sf_dir):
    return ts.with_split(ts.dense_calendar(_daily(spark, sf_dir)))


@query("SELECT * FROM d_daily")
def daily_sales(spark, sf_dir):
    return _daily(spark, sf_dir)


@query("SELECT * FROM d_dense")
def daily_sales_dense(spark, sf_dir):
    return ts.dense_calendar(_daily(spark, sf_dir))


@query(f"""
    WITH daily AS (SELECT event_type, CAST(ts AS DATE) AS order_date, {dsum('value')} AS total_sales
                   FROM events GROUP BY 1, 2),
         days AS (SELECT event_type, CAST(unnest(generate_series(MIN(order_date), MAX(order_date), INTERVAL 1 DAY))
                                          AS DATE) AS order_date
                  FROM daily GROUP BY 1)
    SELECT days.event_type, days.order_date, COALESCE(total_sales, 0) AS total_sales
    FROM days LEFT JOIN daily ON days.event_type = daily.event_type AND days.order_date = daily.order_date""")
def daily_sales_by_series(spark, sf_dir):
    daily = ts.daily_sales(role(spark, sf_dir, "visits"), money="value", series=["event_type"])
    return ts.dense_calendar(daily, ["event_type"])


@query(f"""SELECT CAST(date_trunc('week', order_date) AS DATE) + 6 AS order_date, {dsum('total_sales')} AS total_sales
           FROM d_dense GROUP BY 1""")
def weekly_sales(spark, sf_dir):
    return ts.weekly_sales(ts.dense_calendar(_daily(spark, sf_dir)))


@query(f"SELECT last_day(order_date) AS order_date, {dsum('total_sales')} AS total_sales FROM d_dense GROUP BY 1")
def monthly_sales_ts(spark, sf_dir):
    return ts.monthly_sales(ts.dense_calendar(_daily(spark, sf_dir)))


@query("SELECT order_date, total_sales, split FROM d_split")
def train_test_split(spark, sf_dir):
    return _split(spark, sf_dir)


# ---------------------------------------------------------------- Holt-Winters

# The recursion as a recursive relation: a row per day (and parameter set).
_PERIOD = 7
_GIVEN = (0.3, 0.1, 0.2)


def _mean(first: int) -> str:
    total = "0.0"
    for day in range(first, first + _PERIOD):
        total = f"({total} + v[{day}])"
    return f"{total} / {_PERIOD}"


define("d_start", f"""
    SELECT CAST({_mean(1)} AS DOUBLE) AS l, CAST(({_mean(8)} - {_mean(1)}) / {_PERIOD} AS DOUBLE) AS b, v
    FROM (SELECT list(total_sales ORDER BY t) AS v FROM d_split WHERE split = 'train')""")


def _recursion(name: str, parameters: str) -> None:
    seasons = [f"s{i}" for i in range(_PERIOD)]
    shifted = ", ".join(f"s{i + 1} AS s{i}" for i in range(_PERIOD - 1))
    CTE = f"""/*recursive*/
    SELECT alpha, beta, gamma, CAST(0 AS BIGINT) AS t, l, b,
           {', '.join(f'v[{i + 1}] - l AS s{i}' for i in range(_PERIOD))},
           CAST(0 AS DOUBLE) AS sse, CAST(NULL AS DOUBLE) AS fit
    FROM d_start, ({parameters}) p
    UNION ALL
    SELECT alpha, beta, gamma, t, l2, beta * (l2 - l) + (1 - beta) * b, {shifted},
           gamma * (y - (l + b)) + (1 - gamma) * s0, sse + (y - (l + b + s0)) * (y - (l + b + s0)), l + b + s0
    FROM (SELECT r.alpha, r.beta, r.gamma, d.t, r.l, r.b, {', '.join('r.' + s for s in seasons)}, r.sse,
                 d.total_sales AS y, r.alpha * (d.total_sales - r.s0) + (1 - r.alpha) * (r.l + r.b) AS l2
          FROM {name} r JOIN d_split d ON d.t = r.t + 1 WHERE d.split = 'train')"""
    define(name, CTE)


def _values(values) -> str:
    return ", ".join(f"(CAST({value!r} AS DOUBLE))" for value in values)


_recursion("d_given", f"SELECT CAST({_GIVEN[0]} AS DOUBLE) AS alpha, CAST({_GIVEN[1]} AS DOUBLE) AS beta,"
                      f" CAST({_GIVEN[2]} AS DOUBLE) AS gamma")
_recursion("d_coarse", f"SELECT alpha, beta, gamma FROM (VALUES {_values(hw.ALPHAS)}) AS a(alpha),"
                       f" (VALUES {_values(hw.BETAS)}) AS b(beta), (VALUES {_values(hw.GAMMAS)}) AS c(gamma)")
define("d_coarse_best", "SELECT * FROM d_coarse WHERE t = (SELECT MAX(t) FROM d_coarse)"
                        " ORDER BY sse, alpha, beta, gamma LIMIT 1")
_recursion("d_fine", "SELECT DISTINCT " + ", ".join(
    f"least(greatest(w.{name} + {name}_step, 0.0), 1.0) AS {name}" for name in ("alpha", "beta", "gamma"))
    + " FROM d_coarse_best w, " + ", ".join(
    f"(VALUES {_values(steps)}) AS {name}_steps({name}_step)"
    for name, steps in zip(("alpha", "beta", "gamma"), hw.FINE_STEPS)))
define("d_model", "SELECT * FROM d_given WHERE t = (SELECT MAX(t) FROM d_given)")
define("d_predicted", f"""
    SELECT (SELECT MAX(order_date) FROM d_split WHERE split = 'train') + CAST(h AS INTEGER) AS order_date, h,
           l + h * b + [{', '.join(f's{i}' for i in range(_PERIOD))}][(h - 1) % {_PERIOD} + 1] AS predicted
    FROM d_model, range(1, (SELECT COUNT(*) FROM d_split WHERE split = 'test') + 366) AS steps(h)""")
define("d_test_days", "SELECT COUNT(*) AS n FROM d_split WHERE split = 'test'")
define("d_future", "SELECT order_date, predicted FROM d_predicted WHERE h > (SELECT n FROM d_test_days)")
define("d_compared", """
    SELECT p.order_date, d.total_sales AS actual, p.predicted
    FROM d_predicted p JOIN d_split d ON d.order_date = p.order_date WHERE d.split = 'test'""")


def _given(spark, sf_dir):
    """The staged split series and a model with given parameters."""
    daily = stage(_split(spark, sf_dir), "daily")
    return daily, hw.smooth(daily.where("split = 'train'"), *_GIVEN)


def _future(spark, sf_dir):
    daily, models = _given(spark, sf_dir)
    test_days = daily.where("split = 'test'").count()
    return hw.forecast(models, test_days + 365, test_days + 1)


def _compared(spark, sf_dir):
    daily, models = _given(spark, sf_dir)
    test = daily.where("split = 'test'")
    return hw.compare(test, hw.forecast(models, test.count()))


@query("""SELECT round(alpha, 6) AS alpha, round(beta, 6) AS beta, round(gamma, 6) AS gamma, round(l, 3) AS level,
                 round(b, 3) AS trend, round(sqrt(sse / t), 3) AS train_rmse, CAST(t AS INTEGER) AS n_train
          FROM d_fine WHERE t = (SELECT MAX(t) FROM d_fine) ORDER BY sse, d_fine.alpha, d_fine.beta, d_fine.gamma
          LIMIT 1""")
def hw_grid_fit(spark, sf_dir):
    daily = stage(_split(spark, sf_dir), "daily")
    model = hw.fit(daily.where("split = 'train'"), start="means")
    return model.select(
        *[F.round(name, 6).alias(name) for name in ("alpha", "beta", "gamma")], F.round("level", 3).alias("level"),
        F.round("trend", 3).alias("trend"), F.round(F.sqrt(F.col("sse") / F.col("n_train")), 3).alias("train_rmse"),
        "n_train")


@query("""SELECT d.order_date, round(fit, 4) AS fitted FROM d_given g JOIN d_split d ON d.t = g.t WHERE g.t > 0""")
def hw_fitted(spark, sf_dir):
    daily, models = _given(spark, sf_dir)
    fits = hw.fitted(daily.where("split = 'train'"), models)
    return fits.withColumn("fitted", F.round("fitted", 4))


@query("SELECT order_date, round(predicted, 4) AS predicted FROM d_predicted")
def hw_forecast(spark, sf_dir):
    """The test days and the 365 days after them, all counted from the end of training."""
    daily, models = _given(spark, sf_dir)
    test_days = daily.where("split = 'test'").count()
    return hw.forecast(models, test_days + 365).withColumn("predicted", F.round("predicted", 4))


@query("""SELECT round(sqrt(AVG((actual - predicted) * (actual - predicted))), 4) AS rmse,
                 round(COALESCE(AVG(abs((actual - predicted) / NULLIF(actual, 0))) * 100, 0), 4) AS mape
          FROM d_compared""")
def forecast_metrics(spark, sf_dir):
    scores = hw.accuracy(_compared(spark, sf_dir))
    return scores.select(F.round("rmse", 4).alias("rmse"), F.round("mape", 4).alias("mape"))


@query("""WITH monthly AS (SELECT strftime(order_date, '%Y-%m') AS month, SUM(predicted) AS total FROM d_future
                           GROUP BY 1),
               edge AS (SELECT SUM(predicted) AS total, arg_min(predicted, order_date) AS first_value,
                               arg_max(predicted, order_date) AS last_value FROM d_future),
               peak AS (SELECT * FROM monthly ORDER BY total DESC, month LIMIT 1),
               trough AS (SELECT * FROM monthly ORDER BY total, month LIMIT 1)
          SELECT round(edge.total, 2) AS total_forecast, round(first_value, 4) AS first_value,
                 round(last_value, 4) AS last_value,
                 CASE WHEN last_value > first_value THEN 'increasing' ELSE 'decreasing' END AS direction,
                 peak.month AS peak_month, round(peak.total, 2) AS peak_value,
                 trough.month AS trough_month, round(trough.total, 2) AS trough_value
          FROM edge, peak, trough""")
def forecast_summary(spark, sf_dir):
    summary = hw.summary(_future(spark, sf_dir))
    return summary.withColumns(
        {name: F.round(name, 2) for name in ("total_forecast", "peak_value", "trough_value")}
        | {name: F.round(name, 4) for name in ("first_value", "last_value")})
