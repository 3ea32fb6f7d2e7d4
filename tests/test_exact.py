"""Order-independent sums: the same bits over any partitioning, and the correctly rounded value."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from plotwise.functions import exact as X
from plotwise.operators import grouped as G
from plotwise.operators import impute as I


def data(seed=0, n=4000):
    rng = random.Random(seed)
    draw = [lambda: rng.uniform(-100, 100), lambda: rng.uniform(0, 1e-3), lambda: rng.gauss(0, 1e9), lambda: round(rng.uniform(0, 100), 1) * 1.2, lambda: None]
    return [(i % 7 if i % 3 else 0, draw[rng.randrange(5)](), rng.uniform(0, 50), i) for i in range(n)]


def bits(rows):
    return sorted((tuple(v.hex() if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("n", [7, 200])
def test_same_bits_over_any_partitions(spark, n):
    df = spark.createDataFrame(data(), "g int, x double, t double, i int")
    aggs = [X.sum_exact("x").alias("s"), X.mean_exact("x").alias("m"), X.slope_exact("x", "t").alias("b")]
    one = bits(df.coalesce(1).groupBy("g").agg(*aggs).collect())
    assert bits(df.orderBy(F.rand(n)).repartition(n).groupBy("g").agg(*aggs).collect()) == one
    for op in (lambda d: G.group_sum_strict(d, ["g"], "x", "out"), lambda d: G.group_mean(d, ["g"], "x", "out"), lambda d: G.pooled_group_mean(d, ["g"], ["x", "t"], "out"),
               lambda d: I.group_mean_impute(d, ["g"], "x", d.filter("x is null").select("g").distinct())):
        cols = lambda d: op(d).select("g", op(d).columns[-1]).distinct()  # noqa: E731, B023
        assert bits(cols(df.orderBy(F.rand(n)).repartition(n)).collect()) == bits(cols(df.coalesce(1)).collect())


def test_correctly_rounded(spark):
    rows = data(3)
    want = {}
    for g, x, *_ in rows:
        if x is not None:  # what lies below 2**-52 of a value is cut off
            want.setdefault(g, []).append(Fraction(math.floor(Fraction(x) * 2**52), 2**52))
    df = spark.createDataFrame(rows, "g int, x double, t double, i int")
    got = {r.g: r.s for r in df.groupBy("g").agg(X.sum_exact("x").alias("s")).collect()}
    assert got == {g: float(sum(v)) for g, v in want.items()}
    assert got[0] == pytest.approx(math.fsum(x for g, x, *_ in rows if g == 0 and x is not None), rel=1e-15)


def test_edges(spark):
    rows = [("none", None), ("zero", 0.0), ("zero", None), ("big", 2.0**60), ("big", 1.5), ("inf", math.inf), ("inf", 1.0), ("neg", -0.1), ("neg", -0.2), ("mix", 1e15), ("mix", -1e15), ("mix", 0.25), ("tiny", 2.0**-52), ("tiny", 2.0**-60)]
    got = {r.g: (r.s, r.m) for r in spark.createDataFrame(rows, "g string, x double").groupBy("g").agg(X.sum_exact("x").alias("s"), X.mean_exact("x").alias("m")).collect()}
    assert got["none"] == (None, None) and got["zero"] == (0.0, 0.0) and got["big"][0] == 2.0**60 and got["inf"][0] == math.inf
    assert got["neg"][0] == -0.30000000000000004 and got["mix"][0] == 0.25 and got["tiny"][0] == 2.0**-52


def test_over_a_window(spark):
    df = spark.createDataFrame(data(5, 300), "g int, x double, t double, i int")
    w = Window.partitionBy("g")
    over = {(r.g, r.s) for r in df.select("g", X.sum_exact("x", w).alias("s")).collect()}
    assert over == {tuple(r) for r in df.groupBy("g").agg(X.sum_exact("x")).collect()}


def test_slope_needs_two_pairs(spark):
    rows = [("a", 1.0, 1.0), ("b", 1.0, 1.0), ("b", 3.0, 1.0), ("c", 1.0, 1.0), ("c", None, 2.0), ("c", 5.0, 3.0)]
    got = {r.g: r.b for r in spark.createDataFrame(rows, "g string, y double, x double").groupBy("g").agg(X.slope_exact("y", "x").alias("b")).collect()}
    assert got == {"a": None, "b": None, "c": 2.0}
