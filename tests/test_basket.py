"""The most common pairs against counting all pairs of every order."""

import random
from collections import Counter
from itertools import combinations

import pytest

from tradewind.operators.basket import most_common_pairs


def expected(orders, k):
    counts = Counter()
    for products in orders.values():
        counts.update(set(combinations(sorted(products), 2)))
    return sorted(((a, b, n) for (a, b), n in counts.items()), key=lambda row: (-row[2], row[0], row[1]))[:k]


def baskets(seed, orders, products, largest):
    rng = random.Random(seed)
    result = {}
    for order in range(orders):
        size = largest if rng.random() < 0.1 else rng.randint(1, 5)
        result[order] = [min(int(rng.expovariate(8 / products)), products) for _ in range(size)]
    return result


def found(spark, orders, k, **options):
    lines = [(o, p) for o, products in orders.items() for p in products]
    df = spark.createDataFrame(lines, "order_id INT, product_id INT")
    return [tuple(row) for row in most_common_pairs(df, k, **options).collect()]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("large_order, probes", [(1000, 100), (8, 5), (3, 2)])
def test_pairs(spark, seed, large_order, probes):
    orders = baskets(seed, 120, 40, 30)
    assert found(spark, orders, 10, large_order=large_order, probes=probes) == expected(orders, 10)


def test_one_order_with_a_third_of_all_lines(spark):
    rng = random.Random(9)
    orders = {o: [rng.randint(0, 60) for _ in range(4)] for o in range(200)}
    orders[999] = list(range(400))
    assert found(spark, orders, 10, large_order=50, probes=10) == expected(orders, 10)


def test_only_large_orders(spark):
    """All counts are at most the number of large orders: their pairs decide the result."""
    orders = {1: list(range(0, 60)), 2: list(range(30, 100)), 3: [5, 5]}
    assert found(spark, orders, 12, large_order=10, probes=3) == expected(orders, 12)


def test_self_pairs(spark):
    assert found(spark, {1: [1, 1, 2]}, 10) == [(1, 1, 1), (1, 2, 1)]
