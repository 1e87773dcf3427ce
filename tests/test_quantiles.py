from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.quantiles import exact_quantiles

POINTS = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}


def _check(rows, groups):
    got = {row["g"]: row for row in rows}
    assert set(got) == set(groups)
    for group, values in groups.items():
        for name, p in POINTS.items():
            assert got[group][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12), (group, name)


def test_matches_numpy_on_assorted_groups(spark):
    rng = random.Random(7)
    groups = {
        "one": [3.25],
        "two": [1.0, 2.0],
        "ties": [5.0] * 9 + [7.0] * 2,
        "signs": [-2.5, -1e-3, 0.0, 1e-3, 2.5, -1e9, 1e9],
        "tiny": [5e-324, 1e-310, 1e-300, 2e-300, -5e-324],
        "huge": [1e300, 1.5e308, -1e308, 3.0],
        "powers": [2.0**n for n in range(-40, 40)],
        "near": [8.0 - 2**-50 * n for n in range(50)] + [8.0 + 2**-49 * n for n in range(50)],
        "cents": [round(rng.uniform(0, 2000), 2) for _ in range(700)],
        None: [1.0, 4.0, 9.0],
    }
    data = [(g, v) for g, values in groups.items() for v in values] + [("cents", None), ("empty", None)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "g string, v double")
    _check(exact_quantiles(df, ["g"], "v", POINTS).collect(), groups)


def test_hot_key_and_continuous_values(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("g"),
        (F.rand(3) * 1000).alias("v"),
    )
    rows = df.collect()
    df = spark.createDataFrame(rows, "g string, v double")
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    _check(exact_quantiles(df, ["g"], "v", POINTS).collect(), groups)


def test_weights_and_no_keys(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (10.0, 4), (None, 5)], "v double, n bigint")
    row = exact_quantiles(df, [], "v", POINTS, weight="n").collect()[0]
    for name, p in POINTS.items():
        assert row[name] == pytest.approx(np.quantile([1, 1, 1, 2, 10, 10, 10, 10], p))


def test_infinities_and_nan_sort_outside(spark):
    df = spark.createDataFrame([(float("-inf"),), (1.0,), (float("inf"),)], "v double")
    row = exact_quantiles(df, [], "v", {"lo": 0.0, "mid": 0.5, "hi": 1.0}).collect()[0]
    assert (row["lo"], row["mid"], row["hi"]) == (-math.inf, 1.0, math.inf)


def test_no_values(spark):
    df = spark.createDataFrame([(1, None)], "g bigint, v double")
    assert exact_quantiles(df, ["g"], "v", {"mid": 0.5}).collect() == []
    assert exact_quantiles(df, [], "v", {"mid": 0.5}).collect()[0]["mid"] is None
