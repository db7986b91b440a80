"""Repeated rows by fingerprint against plain distinct rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tradewind.operators import fingerprint, profile
from tradewind.operators.clean import drop_duplicate_rows
from tradewind.sources import stage

SCHEMA = "a INT, b STRING, c DOUBLE, d ARRAY<INT>"
ROWS = [(1, "x", 1.0, [1]), (1, "x", 1.0, [1]), (None, "x", 1.0, [1]), (1, None, 1.0, None), (None, None, None, None),
        (None, None, None, None), (2, "x", 0.0, []), (2, "x", -0.0, []), (3, "y", float("nan"), [1, 2]),
        (3, "y", float("nan"), [1, 2]), (3, "y", None, [1, 2]), (4, "", 1.0, [None]), (4, None, 1.0, [None])]


def key(row):
    return tuple(str(0.0 if v == 0 and isinstance(v, float) else v) for v in row)


@pytest.mark.parametrize("forced", [False, True])
def test_distinct_rows(spark, monkeypatch, forced):
    """Also with all rows forced to a few fingerprints."""
    if forced:
        monkeypatch.setattr(fingerprint, "fingerprint", lambda columns: (F.coalesce(F.col("a") % 2, F.lit(7)).cast("bigint"), F.lit(1)))
    df = stage(spark.createDataFrame(ROWS + [(i, "z", 1.0, None) for i in range(100, 160)], SCHEMA).repartition(4))
    expected = Counter(key(row) for row in df.collect())
    assert Counter(key(row) for row in drop_duplicate_rows(df).collect()) == Counter(dict.fromkeys(expected, 1))
    assert tuple(profile.duplicate_profile(df).first()) == (sum(expected.values()), len(expected), sum(expected.values()) - len(expected))


def test_rows_that_are_all_different_stay_as_they_are(spark):
    df = stage(spark.range(1000).withColumn("text", F.repeat(F.lit("x"), 100)))
    assert drop_duplicate_rows(df) is df
    assert tuple(profile.duplicate_profile(df).first()) == (1000, 1000, 0)


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert drop_duplicate_rows(df).collect() == []
    assert tuple(profile.duplicate_profile(df).first()) == (0, 0, 0)


def test_only_fingerprints_are_shuffled(spark):
    df = stage(spark.range(1000).withColumns({f"text{i}": F.repeat(F.lit("x"), 100) for i in range(5)}))
    text = fingerprint._counted(df)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in text.splitlines() if "Exchange" in line and "(" in line]
    assert exchanges and all("text" not in line.split("plan_id")[0].split("ENSURE")[0] for line in exchanges)
    assert all("hashpartitioning(_fingerprint_high" in line for line in exchanges)


def test_many_columns_with_nulls_tell_their_places(spark):
    names = [f"c{i}" for i in range(130)]
    rows = [tuple(1 if i == at else None for i in range(130)) for at in range(130)]
    df = fingerprint.with_fingerprint(spark.createDataFrame(rows, ", ".join(f"{n} INT" for n in names)))
    assert df.select("_fingerprint_high").distinct().count() == 130 == df.select("_fingerprint_low").distinct().count()


def test_half_a_fingerprint_is_shuffled_and_rows_that_share_it_are_compared(spark, monkeypatch):
    df = stage(spark.createDataFrame([(i % 50, i % 2) for i in range(200)], "a INT, b INT"))
    text = fingerprint._counted(df)._jdf.queryExecution().executedPlan().toString()
    assert all("_low" not in line for line in text.splitlines() if "Exchange" in line)
    high, low = fingerprint.fingerprint(df.columns)
    monkeypatch.setattr(fingerprint, "fingerprint", lambda columns: (F.pmod(high, F.lit(3)), low))
    assert sorted(map(tuple, drop_duplicate_rows(df).collect())) == sorted({(i % 50, i % 2) for i in range(200)})
