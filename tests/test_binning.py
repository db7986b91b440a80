"""Quantiles, positions and scores against pandas, on the small and on the ranged way."""

import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradewind.operators.binning import distinct_edges, even_probabilities, rank_score, value_score
from tradewind.operators.ordering import exact_quantiles, with_row_number
from tradewind.sources import stage

pytestmark = pytest.mark.usefixtures("many_ranges")


def numbers(n, kind):
    rng = random.Random(n)
    if kind == "ties":
        return [float(rng.choice([1, 1, 1, 2, 3, 5, 8])) for _ in range(n)]
    if kind == "hot":
        return [7.0 if rng.random() < 0.4 else round(rng.uniform(0, 100), 2) for _ in range(n)]
    return [round(rng.lognormvariate(3, 2), 4) for _ in range(n)]


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id BIGINT, v DOUBLE").repartition(5)


@pytest.mark.parametrize("kind", ["plain", "ties", "hot"])
@pytest.mark.parametrize("bins", [4, 5])
def test_value_scores_are_those_of_qcut(spark, kind, bins):
    values = numbers(503, kind)
    df = stage(frame(spark, values + [None, None]))
    edges = distinct_edges(exact_quantiles(df, {"v": even_probabilities(bins)})["v"], "drop")
    scored = dict(df.select("id", value_score("v", edges)).collect())
    binned = pd.qcut(pd.Series(values), bins, labels=False, duplicates="drop") + 1
    assert [scored[i] for i in range(len(values))] == binned.tolist()
    assert scored[len(values)] is None
    reverse = dict(df.select("id", value_score("v", edges, descending=True)).collect())
    assert [reverse[i] for i in range(len(values))] == [int(binned.max()) + 1 - b for b in binned]


@pytest.mark.parametrize("n, bins", [(5, 5), (6, 4), (7, 5), (11, 4), (250, 5)])
def test_rank_scores_are_those_of_qcut_over_ranks(spark, n, bins):
    values = numbers(n, "ties")
    df = stage(frame(spark, values))
    numbered = with_row_number(df, ["v", "id"], "place")
    scored = dict(numbered.select("id", rank_score("place", n, bins)).collect())
    expected = pd.qcut(pd.Series(values).rank(method="first"), bins, labels=False) + 1
    assert [scored[i] for i in range(n)] == expected.tolist()


def test_a_single_row_scores_one(spark):
    df = with_row_number(stage(frame(spark, [3.0])), ["v"], "place")
    assert df.select(rank_score("place", 1, 5)).first()[0] == 1


def test_ranged_numbers_are_complete(spark):
    df = stage(frame(spark, numbers(1000, "hot")))
    window = F.row_number().over(Window.orderBy("v", "id")).cast("bigint")
    small = {tuple(row) for row in df.withColumn("n", window).collect()}
    placed = with_row_number(df, ["v", "id"], "n")
    assert small == {tuple(row) for row in placed.collect()}
    assert len(placed.inputFiles()) > 1


def test_ranged_quantiles_of_several_columns_equal_the_aggregate(spark):
    data = [(float(i % 7), round(i * 1.37, 3), None, 5.0 if i % 3 else None) for i in range(400)]
    df = stage(spark.createDataFrame(data, "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE"))
    wanted = {"a": [0.25, 0.5, 0.75], "b": [0.0, 0.1, 0.5, 1.0], "c": [0.5], "d": [0.5]}
    row = df.agg(*[F.percentile(name, F.array(*map(F.lit, p))).alias(name) for name, p in wanted.items()]).first()
    assert exact_quantiles(df, wanted) == {name: list(row[name] or [None] * len(p)) for name, p in wanted.items()}
    assert exact_quantiles(df, wanted)["c"] == [None]


def test_duplicate_edges():
    with pytest.raises(ValueError, match="not unique"):
        distinct_edges([1.0, 1.0, 2.0])
    assert distinct_edges([1.0, 1.0, 2.0], "drop") == [1.0, 2.0]
    with pytest.raises(ValueError, match="no bin"):
        distinct_edges([1.0, 1.0], "drop")
