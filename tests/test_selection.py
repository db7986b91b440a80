"""Selection by counting digits against sorted lists."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tradewind.operators import selection
from tradewind.operators.binning import cut_score
from tradewind.operators.ordering import exact_quantiles, quantiles_and_cuts
from tradewind.operators.selection import Lane, order_statistics
from tradewind.sources import stage

rng = random.Random(8)
DOUBLES = (
    [rng.gauss(0, 1) * 10 ** rng.randint(-300, 300) for _ in range(400)] + [0.0, -0.0, 5e-324, -5e-324, 1e308, -1e308]
    + [float("inf"), float("-inf"), float("nan"), float("nan")] + [7.25] * 300 + [1 + i * 2 ** -52 for i in range(200)]
    + [round(rng.uniform(0, 50), 2) for _ in range(500)])
LONGS = [rng.randint(-2 ** 63, 2 ** 63 - 1) for _ in range(300)] + list(range(500)) + [10 ** 18 + i for i in range(300)] + [
    -2 ** 63, 2 ** 63 - 1] + [42] * 200
TEXTS = ["", "a", "a\x00", "a\x00b", "ab", "é", "日本", "\U0001f600", "z" * 300] + [
    f"customer-{i:09d}" for i in range(600)] + ["same"] * 200 + ["".join(rng.choice("ab\x00é") for _ in range(rng.randint(0, 9))) for _ in range(400)]


def ordered(values):
    if isinstance(values[0], str):
        return sorted(values, key=str.encode)
    return sorted(values, key=lambda v: (v != v, v))


@pytest.mark.parametrize("kind, values", [("DOUBLE", DOUBLES), ("BIGINT", LONGS), ("STRING", TEXTS)])
@pytest.mark.parametrize("few, split", [(2000, 4096), (5, 4096)])
def test_every_position(spark, monkeypatch, kind, values, few, split):
    monkeypatch.setattr(selection, "FEW", few)
    values = random.Random(1).sample(values, len(values))
    df = stage(spark.createDataFrame([(v,) for v in values] + [(None,)] * 3, f"v {kind}").repartition(6))
    wanted = sorted({*range(0, len(values), 37), 0, 1, len(values) - 1, len(values) // 2})
    (got,) = order_statistics(df, [Lane(F.col("v"), lambda rows: wanted)])
    expected = ordered(values)
    assert got.rows == len(values) and set(got.at) == set(wanted)
    for position, found in got.at.items():
        key = expected[position]
        assert found.key == key or (key != key and found.key != found.key)
        same = [i for i, v in enumerate(expected) if v == key or (v != v and key != key)]
        assert (found.before, found.rows) == (same[0], len(same))


def test_lanes_with_conditions_and_without_rows(spark):
    df = spark.range(1000).withColumn("v", (F.col("id") % 10).cast("double"))
    even = F.when(F.col("id") % 2 == 0, F.col("v"))
    nothing = F.when(F.col("id") < 0, F.col("v"))
    got = order_statistics(df, [Lane(F.col("v"), lambda n: [n - 1]), Lane(even, lambda n: [n - 1]), Lane(nothing, lambda n: [0])])
    assert [g.rows for g in got] == [1000, 500, 0]
    assert (got[0].at[999].key, got[1].at[499].key, got[2].at) == (9.0, 8.0, {})
    assert order_statistics(df, []) == []


@pytest.mark.parametrize("ids", ["BIGINT", "STRING"])
@pytest.mark.parametrize("n, bins", [(1, 5), (2, 5), (3, 5), (5, 5), (6, 4), (7, 5), (11, 4), (3000, 5)])
def test_cut_scores_are_those_of_qcut_over_ranks(spark, n, bins, ids):
    rng = random.Random(n)
    values = [float(rng.choice([1, 1, 1, 1, 2, 3, 5])) if n < 3000 else rng.choice([1.0, 1.0, 1.0, round(rng.uniform(0, 9), 1)])
              for _ in range(n)]
    names = list(range(n)) if ids == "BIGINT" else [f"id-{i:06d}" for i in range(n)]
    df = stage(spark.createDataFrame(list(zip(names, values)), f"id {ids}, v DOUBLE").repartition(4))
    _, cuts = quantiles_and_cuts(df, {}, ["v"], "id", bins)
    got = dict(df.select("id", cut_score("v", "id", cuts["v"])).collect())
    expected = [0] if n == 1 else pd.qcut(pd.Series(values).rank(method="first"), bins, labels=False)
    assert [got[name] for name in names] == [int(b) + 1 for b in expected]


def test_nothing_to_rank(spark):
    df = spark.createDataFrame([(1, None), (None, 2.0)], "id BIGINT, v DOUBLE")
    quantiles, cuts = quantiles_and_cuts(df, {"v": [0.5]}, ["v"], "id")
    assert quantiles["v"] == [2.0] and cuts["v"] == []
    assert {row[0] for row in df.select(cut_score("v", "id", [])).collect()} == {None}


def test_rows_are_not_exchanged(spark):
    """Only counts by digit cross the shuffle: no column of the table but the keys is read, and no key is an exchange key."""
    seen = []
    wide = stage(spark.range(5000).withColumns({"v": F.rand(1) * 100, "text": F.repeat(F.lit("x"), 50)}))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        original = type(wide).collect

        def collect(df):
            seen.append(df._jdf.queryExecution().executedPlan().toString())
            return original(df)

        type(wide).collect = collect
        exact_quantiles(wide, {"v": [0.5]})
    finally:
        type(wide).collect = original
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert seen
    for text in seen:
        assert "rangepartitioning" not in text and "Sort" not in text.replace("SortAggregate", "")
        assert "partial_count" in text and "ReadSchema: struct<v:double>" in text
        assert all("lane" in line or "place" in line for line in text.splitlines() if "Exchange hashpartitioning" in line)


def test_quantiles_of_many_magnitudes(spark):
    values = [v for v in DOUBLES if math.isfinite(v)]
    df = stage(spark.createDataFrame([(v,) for v in values], "v DOUBLE").repartition(3))
    p = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    expected = df.agg(F.percentile("v", F.array(*map(F.lit, p)))).first()[0]
    assert exact_quantiles(df, {"v": p})["v"] == expected
