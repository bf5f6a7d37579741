"""The keyed permutation of an epoch, and sums that do not depend on the order of rows."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.exact import exact_mean, exact_sum
from corpusloom.operators import mixing
from corpusloom.operators import permutation as perm


def by_hand(x, n, seed, epoch):
    """The rule in Python integers."""
    a = math.isqrt(n) + 1
    b = (n + a - 1) // a

    def hashed(digit, salt):
        keyed = (digit * perm.MULTIPLIERS[0] + salt[0]) % perm.KEY_MODULUS >> perm.KEY_SHIFT
        return (keyed * perm.MULTIPLIERS[1] + salt[1]) % perm.MIX_MODULUS >> perm.MIX_SHIFT

    while True:
        high, low = divmod(x, b)
        for i, salt in enumerate(perm.salts(seed, epoch)):
            if i % 2 == 0:
                high = (high + hashed(low, salt)) % a
            else:
                low = (low + hashed(high, salt)) % b
        x = high * b + low
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_every_position_once_and_back(spark, n):
    size = F.lit(n).cast("bigint")
    rows = spark.range(n).select("id", perm.permuted(F.col("id"), size, 7, 3).alias("p"))
    rows = rows.select("*", perm.unpermuted(F.col("p"), size, 7, 3).alias("back")).collect()
    assert {r.id: r.p for r in rows} == {i: by_hand(i, n, 7, 3) for i in range(n)}
    assert sorted(r.p for r in rows) == list(range(n)) and all(r.back == r.id for r in rows)


def test_large_ranges_and_unrelated_epochs(spark):
    n = 10**15 + 7
    ids = [0, 1, 2, 10**9, n - 1, n // 2] + [random.Random(1).randrange(n) for _ in range(200)]
    frame = spark.createDataFrame([(i,) for i in ids], "id bigint")
    size = F.lit(n).cast("bigint")
    rows = frame.select("id", perm.permuted(F.col("id"), size, 42, 9).alias("p")).collect()
    assert all(r.p == by_hand(r.id, n, 42, 9) for r in rows)
    orders = [[by_hand(i, 2000, 42, epoch) for i in range(2000)] for epoch in (1, 2)]
    steps = {(y - x) % 2000 for x, y in zip(*orders)}
    assert len(steps) > 1000                # neither a rotation of the other
    runs = sum(abs(x - y) == 1 for x, y in zip(orders[0], orders[0][1:]))
    assert runs < 20                        # neighbours part


def test_an_epoch_goes_on_where_it_stopped(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RUN", 4)
    rows = [("train", i, 50) for i in range(50)] + [("test", i, 3) for i in range(3)]
    indexed = spark.createDataFrame(rows, "split string, idx bigint, n_rows bigint")
    whole = {(r.split, r.position): r.idx for r in mixing.shuffle_epoch(indexed, 42, 1).collect()}
    sizes = indexed.select("split", "n_rows").distinct()
    for start in (0, 7, 49, 50):
        left = mixing.resume_epoch(sizes, 42, 1, F.lit(start)).collect()
        assert {(r.split, r.position): r.idx for r in left} == {k: v for k, v in whole.items() if k[1] >= start}


def test_the_shuffle_is_arithmetic(spark):
    indexed = spark.range(100).select(F.lit("train").alias("split"), F.col("id").alias("idx"), F.lit(100).cast("bigint").alias("n_rows"))
    plan = mixing.shuffle_epoch(indexed, 42, 1)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Sort", "Window"))


def test_sums_are_equal_to_the_last_bit(spark):
    r = random.Random(3)
    values = [r.choice([1e-9, 1.0, 1e6, 1e12]) * r.gauss(0, 1) for _ in range(5000)]
    frame = spark.createDataFrame(list(enumerate(values)), "i bigint, x double")
    found = set()
    for parts in (1, 8, 200):
        row = frame.repartition(parts, "i").agg(exact_sum(F.col("x")).alias("s"), exact_mean(F.col("x"), F.col("i")).alias("m")).first()
        found.add((row.s, row.m))
    assert len(found) == 1
    assert found.pop()[0] == pytest.approx(math.fsum(values), rel=1e-12)


def test_sums_of_values_that_are_no_numbers(spark):
    nan, inf = float("nan"), float("inf")
    cases = {"none": [None], "some": [None, 1.5, -0.25], "inf": [1.0, inf], "nan": [1.0, nan], "large": [3e18, 1.0], "negative": [-1e17, 0.5]}
    rows = [(name, v) for name, values in cases.items() for v in values]
    got = {r.k: r.s for r in spark.createDataFrame(rows, "k string, x double").groupBy("k").agg(exact_sum(F.col("x")).alias("s")).collect()}
    assert got["none"] is None and got["some"] == 1.25 and got["inf"] == inf and math.isnan(got["nan"])
    assert got["large"] == 3e18 and got["negative"] == -1e17 + 0.5
