"""Ranks without a task that sees all numbers."""

import random

import pytest

from headway.sources import reports


@pytest.mark.parametrize(("n", "low", "high"), [(1, 5, 5), (19, -3, 3), (20, 0, 10**12), (2_000, -(10**6), 10**6), (3_000, 7, 8)])
def test_nearest_rank(spark, n, low, high):
    rng = random.Random(n)
    numbers = sorted(rng.randint(low, high) for _ in range(n))
    df = spark.createDataFrame([(x,) for x in numbers] + [(None,)], "v long")
    row = reports.latency_summary(df, "v", high - 1).first()
    rank = max(1, -(-n * 95 // 100))
    total = sum(numbers)
    mean = abs(total) // n * (1 if total >= 0 else -1)
    assert tuple(row) == (numbers[0], mean, numbers[rank - 1], numbers[-1], n, numbers[-1] <= high - 1)


def test_no_numbers(spark):
    assert reports.latency_summary(spark.createDataFrame([(None,)], "v int"), "v", 1).collect() == []
