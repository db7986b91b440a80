"""Registered queries: smoothing of many series with estimated starting states.

The comparison SQL solves the least-squares problem of the starting states by itself, for
given parameters. For searched parameters it states what has to hold of every fit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators import forecast as hw
from tradewind.operators import timeseries as ts
from tradewind.plans.registry import define, dsum, query
from tradewind.plans.series import _GIVEN, _PERIOD
from tradewind.plans.tables import facts
from tradewind.sources import stage

NATION, TYPE = "customer_state", "product_category_name"
# The days of the short series that is added to the nations.
SHORT_DAYS = 10


def _split_by(spark, sf_dir, key: str, part: str) -> DataFrame:
    """The staged split of the dense daily revenue of every value of `key`."""
    items = facts(spark, sf_dir, "order", part).where(F.col(key).isNotNull())
    dense = ts.dense_calendar(ts.daily_sales(items, series=[key]), [key])
    return stage(ts.with_split(dense, series=[key]), "daily")


def _split_ctes(name: str, key: str) -> str:
    """Define the split series by `key` as relation `name` (key, order_date, total_sales, t, split)."""
    define(f"{name}_daily", f"""
        SELECT {key}, CAST(order_purchase_timestamp AS DATE) AS order_date, {dsum('item_total_revenue')} AS total_sales
        FROM d_facts WHERE {key} IS NOT NULL AND order_purchase_timestamp IS NOT NULL GROUP BY 1, 2""")
    define(name, f"""
        SELECT days.{key}, days.order_date, COALESCE(total_sales, 0) AS total_sales,
               row_number() OVER (PARTITION BY days.{key} ORDER BY days.order_date) AS t,
               CASE WHEN row_number() OVER (PARTITION BY days.{key} ORDER BY days.order_date)
                         <= floor(COUNT(*) OVER (PARTITION BY days.{key}) * 0.8) THEN 'train' ELSE 'test' END AS split
        FROM (SELECT {key}, CAST(unnest(generate_series(MIN(order_date), MAX(order_date), INTERVAL 1 DAY)) AS DATE) AS order_date
              FROM {name}_daily GROUP BY 1) days
        LEFT JOIN {name}_daily d ON d.{key} = days.{key} AND d.order_date = days.order_date""")
    return name


_split_ctes("d_nations", NATION)

# Coefficients of the unknown starting states (level, trend, all seasons but the last) in the
# states of day t; they are the same for every series.
_UNKNOWN = _PERIOD + 1
_A, _B, _G = (f"CAST({value!r} AS DOUBLE)" for value in _GIVEN)


def _list(expression: str) -> str:
    return f"[{expression} FOR k IN range(1, {_UNKNOWN + 1})]"


def _unit(place: int) -> str:
    return "[" + ", ".join("1.0::DOUBLE" if k == place else "0.0::DOUBLE" for k in range(1, _UNKNOWN + 1)) + "]"


_SEASONS = ", ".join([_unit(3 + i) for i in range(_PERIOD - 1)]
                     + ["[" + ", ".join(["0.0::DOUBLE"] * 2 + ["-1.0::DOUBLE"] * (_PERIOD - 1)) + "]"])
define("d_coefficients", f"""/*recursive*/
    SELECT CAST(0 AS BIGINT) AS t, {_unit(1)} AS l, {_unit(2)} AS b, [{_SEASONS}] AS s, {_unit(0)} AS f
    UNION ALL
    SELECT t, l2, {_list(f'{_B} * (l2[k] - l[k]) + (1 - {_B}) * b[k]')},
           list_concat(s[2:], [{_list(f'-{_G} * (l[k] + b[k]) + (1 - {_G}) * s[1][k]')}]),
           {_list('l[k] + b[k] + s[1][k]')}
    FROM (SELECT t + 1 AS t, l, b, s, {_list(f'-{_A} * s[1][k] + (1 - {_A}) * (l[k] + b[k])')} AS l2
          FROM d_coefficients WHERE t < (SELECT MAX(t) FROM d_nations WHERE split = 'train'))""")


def _run(name: str, start: str) -> None:
    """The recursion over the training days of every nation from `start` (key, l, b, s)."""
    define(name, f"""/*recursive*/
        SELECT {NATION}, CAST(0 AS BIGINT) AS t, l, b, s, CAST(NULL AS DOUBLE) AS y, CAST(NULL AS DOUBLE) AS fit FROM ({start})
        UNION ALL
        SELECT {NATION}, t, l2, {_B} * (l2 - l) + (1 - {_B}) * b,
               list_concat(s[2:], [{_G} * (y - (l + b)) + (1 - {_G}) * s[1]]), y, l + b + s[1]
        FROM (SELECT r.{NATION}, d.t, r.l, r.b, r.s, d.total_sales AS y,
                     {_A} * (d.total_sales - r.s[1]) + (1 - {_A}) * (r.l + r.b) AS l2
              FROM {name} r JOIN d_nations d ON d.{NATION} = r.{NATION} AND d.t = r.t + 1 WHERE d.split = 'train')""")


_ZEROS = "[" + ", ".join(["0.0::DOUBLE"] * _PERIOD) + "]"
_run("d_zero_start", f"SELECT DISTINCT {NATION}, 0.0::DOUBLE AS l, 0.0::DOUBLE AS b, {_ZEROS} AS s FROM d_nations")
# The normal equations, a row per nation and equation, then eliminated unknown by unknown.
define("d_cells", f"""
    SELECT z.{NATION}, i, j, SUM(c.f[i] * CASE WHEN j > {_UNKNOWN} THEN z.y - z.fit ELSE c.f[j] END) AS cell
    FROM d_zero_start z JOIN d_coefficients c ON c.t = z.t, range(1, {_UNKNOWN + 1}) a(i), range(1, {_UNKNOWN + 2}) e(j)
    WHERE z.t > 0 GROUP BY 1, 2, 3""")
define("d_system", f"""
    SELECT {NATION}, list(row ORDER BY i) AS m
    FROM (SELECT {NATION}, i, list(cell ORDER BY j) AS row FROM d_cells GROUP BY 1, 2) GROUP BY 1""")
_COLUMNS = f"range(1, {_UNKNOWN + 2})"
define("d_eliminated", f"""/*recursive*/
    SELECT {NATION}, 0 AS p, m FROM d_system
    UNION ALL
    SELECT {NATION}, p + 1, [CASE WHEN i = p + 1 THEN [m[p + 1][j] / m[p + 1][p + 1] FOR j IN {_COLUMNS}]
        ELSE [m[i][j] - m[i][p + 1] / m[p + 1][p + 1] * m[p + 1][j] FOR j IN {_COLUMNS}] END
        FOR i IN range(1, {_UNKNOWN + 1})]
    FROM d_eliminated WHERE p < {_UNKNOWN}""")
define("d_states", f"""
    SELECT {NATION}, m[1][{_UNKNOWN + 1}] AS l, m[2][{_UNKNOWN + 1}] AS b,
           list_concat([m[i][{_UNKNOWN + 1}] FOR i IN range(3, {_UNKNOWN + 1})],
                       [-list_sum([m[i][{_UNKNOWN + 1}] FOR i IN range(3, {_UNKNOWN + 1})])]) AS s
    FROM d_eliminated WHERE p = {_UNKNOWN}""")
_run("d_from_states", "SELECT * FROM d_states")
define("d_nation_models", f"""
    SELECT {NATION}, COUNT(fit) AS n, SUM((y - fit) * (y - fit)) AS sse, arg_max(l, t) AS l, arg_max(b, t) AS b,
           arg_max(s, t) AS s FROM d_from_states GROUP BY 1""")
define("d_nation_compared", f"""
    SELECT d.{NATION}, d.order_date, d.total_sales AS actual, l + (d.t - n) * b + s[(d.t - n - 1) % {_PERIOD} + 1] AS predicted
    FROM d_nations d JOIN d_nation_models m ON d.{NATION} = m.{NATION} WHERE split = 'test'""")


def _nation_models(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    daily = _split_by(spark, sf_dir, NATION, "customer")
    return daily, hw.smooth(daily.where("split = 'train'"), *_GIVEN, series=[NATION], start="estimated")


@query(f"""SELECT m.{NATION}, CAST(n AS INTEGER) AS n_train, round(e.l, 2) AS start_level, round(e.b, 2) AS start_trend,
                  round(e.s[1], 2) AS first_season, round(e.s[{_PERIOD}], 2) AS last_season, round(sqrt(m.sse / n), 2) AS train_rmse
           FROM d_nation_models m JOIN d_states e ON m.{NATION} = e.{NATION}""")
def hw_states_by_nation(spark, sf_dir):
    """Least-squares starting states of the daily revenue of every nation, parameters given."""
    _, models = _nation_models(spark, sf_dir)
    return models.select(
        NATION, "n_train", F.round("start_level", 2).alias("start_level"), F.round("start_trend", 2).alias("start_trend"),
        F.round(F.col("start_season")[0], 2).alias("first_season"),
        F.round(F.col("start_season")[_PERIOD - 1], 2).alias("last_season"),
        F.round(F.sqrt(F.col("sse") / F.col("n_train")), 2).alias("train_rmse"))


@query(f"""SELECT {NATION}, t, round(fit, 2) AS fitted FROM d_from_states WHERE t > 0""")
def hw_fitted_by_nation(spark, sf_dir):
    """In-sample fits of every nation from its estimated states."""
    daily, models = _nation_models(spark, sf_dir)
    fits = hw.fitted(daily.where("split = 'train'"), models, [NATION])
    first = daily.groupBy(NATION).agg(F.min("order_date").alias("first"))
    return fits.join(first, NATION).select(
        NATION, (F.date_diff("order_date", "first") + 1).cast("bigint").alias("t"), F.round("fitted", 2).alias("fitted"))


@query(f"""SELECT {NATION}, round(sqrt(AVG((actual - predicted) * (actual - predicted))), 2) AS rmse,
                  round(COALESCE(AVG(abs((actual - predicted) / NULLIF(actual, 0))) * 100, 0), 2) AS mape
           FROM d_nation_compared GROUP BY 1""")
def forecast_metrics_by_nation(spark, sf_dir):
    """Hold-out accuracy of every nation."""
    daily, models = _nation_models(spark, sf_dir)
    test = stage(daily.where("split = 'test'"), "test")
    steps = test.groupBy(NATION).agg(F.count("*").cast("int").alias("steps"))
    predicted = hw.forecast(models.join(steps, NATION), F.col("steps"), series=[NATION])
    scores = hw.accuracy(hw.compare(test, predicted, [NATION]), [NATION])
    return scores.select(NATION, F.round("rmse", 2).alias("rmse"), F.round("mape", 2).alias("mape"))


def _certified(train: DataFrame, key: str) -> DataFrame:
    """What has to hold of every fit, said of the returned parameters and states by another recursion.

    `sse` comes from a fold of the returned starting states in built-in expressions, not from
    the search; it is compared with the error of the grid, and with what the neighbouring parameters
    give from the same states.
    """
    models = stage(hw.fit(train, [key]), "models")
    near = 1 + 1e-9
    season_sum = F.aggregate("start_season", F.lit(0.0), lambda a, x: a + x)
    return models.select(
        key, "n_train", "reason",
        F.col("alpha").between(0, 1).alias("alpha_in_range"), F.col("beta").between(0, 1).alias("beta_in_range"),
        F.col("gamma").between(0, 1).alias("gamma_in_range"),
        (F.col("sse") <= F.col("grid_sse") * near).alias("not_above_grid"),
        (F.abs(season_sum) <= 1e-6 * (1 + F.abs("start_level"))).alias("seasons_sum_to_zero"))


_HOLDS = """CASE WHEN enough THEN NULL ELSE 'series is shorter than two periods' END AS reason,
            CASE WHEN enough THEN TRUE END AS alpha_in_range, CASE WHEN enough THEN TRUE END AS beta_in_range,
            CASE WHEN enough THEN TRUE END AS gamma_in_range, CASE WHEN enough THEN TRUE END AS not_above_grid,
            CASE WHEN enough THEN TRUE END AS seasons_sum_to_zero"""


def _register_fit(name: str, key: str, train: Callable, relation: str) -> None:
    @query(f"""SELECT {key}, n_train, {_HOLDS}
               FROM (SELECT {key}, CAST(COUNT(*) AS INTEGER) AS n_train, COUNT(*) >= {2 * _PERIOD} AS enough
                     FROM ({relation}) GROUP BY 1)""", name)
    def run(spark, sf_dir):
        return _certified(train(spark, sf_dir), key)


def _nations_and_a_short_one(spark, sf_dir) -> DataFrame:
    train = _split_by(spark, sf_dir, NATION, "customer").where("split = 'train'").drop("split")
    days = train.select("order_date").distinct().orderBy("order_date").limit(SHORT_DAYS)
    return train.unionByName(days.select(F.lit("NEW").alias(NATION), "order_date", F.lit(1.0).alias("total_sales")))


def _types(spark, sf_dir) -> DataFrame:
    return _split_by(spark, sf_dir, TYPE, "product").where("split = 'train'").drop("split")


_split_ctes("d_types", TYPE)
_register_fit("hw_fit_by_nation", NATION, _nations_and_a_short_one, f"""
    SELECT {NATION}, order_date FROM d_nations WHERE split = 'train'
    UNION ALL (SELECT DISTINCT 'NEW', order_date FROM d_nations WHERE split = 'train' ORDER BY order_date LIMIT {SHORT_DAYS})""")
_register_fit("hw_fit_by_part_type", TYPE, _types, f"SELECT {TYPE}, order_date FROM d_types WHERE split = 'train'")
