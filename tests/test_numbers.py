import math
import random

import pytest
from pyspark.sql import functions as F

from tradewind.functions import exact_mean, exact_sum


@pytest.mark.parametrize("wide", [False, True])
def test_sums_do_not_depend_on_the_order(spark, wide):
    rng = random.Random(3)
    values = [round(rng.uniform(-1e6, 1e6), 4) for _ in range(5000)] + [None]
    expected = math.fsum(v for v in values if v is not None)
    for parts in (1, 3, 8):
        df = spark.createDataFrame([(v,) for v in values], "v DOUBLE").repartition(parts)
        assert df.agg(exact_sum("v", wide)).first()[0] == expected
        assert df.agg(exact_mean("v")).first()[0] == expected / 5000


def test_sums_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v DOUBLE")
    assert tuple(df.agg(exact_sum("v"), exact_mean("v")).first()) == (0.0, None)


def test_wide_sums(spark):
    df = spark.range(100).select(F.lit(4e17).alias("v"))
    assert df.agg(exact_sum("v", wide=True)).first()[0] == 4e19
    with pytest.raises(Exception, match="OVERFLOW"):
        df.agg(exact_sum("v")).first()


def mixed(n, seed):
    rng = random.Random(seed)
    return [round(rng.uniform(-1, 1), 12) * 10.0 ** rng.randint(-4, 12) for _ in range(n)]


@pytest.mark.parametrize("values", [
    mixed(3000, 1), [0.1] * 1000, [1e15, 0.1, -1e15, 0.3], [2.0 ** 52, 0.5, 2.0 ** -19], [2.0 ** 53, 1.0, 2.0 ** -15],
    [2.0 ** 60, 127.0, 2.0 ** -10], [2.0 ** 60, 128.0], [-(2.0 ** 60), -128.0, -(2.0 ** -10)], [-(2.0 ** 54), -1.0, -0.5, -0.25, 0.75], [-0.0], [5e-324, 1.0],
    [-1e-3, 1.0, -1.0], [-(2.0 ** 53), -1.0, 2.0 ** -12]], ids=range(13))
def test_sums_are_rounded_once(spark, values):
    """As math.fsum has them, and bit for bit the same over ten partitionings."""
    expected = math.fsum(v for v in values if abs(v) > 1e-300)
    for parts in range(1, 11):
        random.Random(parts).shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v DOUBLE").repartition(parts)
        row = df.agg(exact_sum("v"), exact_sum("v", wide=True), exact_mean("v")).first()
        assert tuple(row) == (expected, expected, expected / len(values))


@pytest.mark.parametrize("value", [float("nan"), float("inf"), 1e19])
def test_sums_fail_rather_than_wrap(spark, value):
    with pytest.raises(Exception, match="OVERFLOW|CAST_INVALID"):
        spark.createDataFrame([(value,)], "v DOUBLE").agg(exact_sum("v")).first()
