"""Distributed exact quantiles equal Spark's percentile."""

import random

import pytest
from pyspark.sql import functions as F

from riskspark.functions.quantiles import exact_quantiles

FR = [i * 0.1 for i in range(11)] + [0.95, 0.5]


def test_equals_percentile_grouped(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, round(rnd.random() * 100, 2), float(rnd.randint(0, 5))]))
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r.q for r in exact_quantiles(df, "x", FR, by=["g"], buckets=7).collect()}
    exp = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("x", F.array(*[F.lit(f) for f in FR])).alias("q")).collect()}
    assert set(got) == set(exp)
    for g in exp:
        assert got[g] == pytest.approx(exp[g], rel=0, abs=0)


def test_global_and_empty(spark):
    df = spark.createDataFrame([(float(i % 17),) for i in range(1001)], "x double")
    got = exact_quantiles(df, "x", FR, buckets=5).collect()[0].q
    exp = df.agg(F.percentile("x", F.array(*[F.lit(f) for f in FR]))).collect()[0][0]
    assert got == exp
    empty = df.where("x < 0")
    assert exact_quantiles(empty, "x", FR).collect()[0].q is None
