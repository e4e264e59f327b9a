"""Exact medians against numpy, with few rows a task may hold."""

import numpy as np
import pytest

from gridprep.operators.medians import exact_medians


def check(spark, groups, small):
    rows = [(k, float(v) if v is not None else None) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "unit string, v double").repartition(5)
    got = {r.unit: (r.median, r.n) for r in exact_medians(df, ["unit"], "v", small).collect()}
    want = {}
    for k, vs in groups.items():
        own = np.array([v for v in vs if v is not None])
        if len(own):
            want[k] = (float(np.median(own)), len(own))
    assert got == pytest.approx(want) if not want else {k: (pytest.approx(m), n) for k, (m, n) in want.items()} == got


def test_groups_of_all_sizes(spark):
    rng = np.random.default_rng(2)
    groups = {
        "even": rng.normal(size=4000), "odd": rng.normal(size=4001) * 1e-3, "one": [5.0], "none": [None, None], None: rng.normal(size=900),
        "ties": np.repeat([1.0, 2.0, 2.0, 9.0], 700), "two": np.repeat([0.0, 1.0], 1500), "steep": np.exp(rng.normal(size=3000) * 40),
        "signs": np.concatenate((-np.exp(rng.normal(size=1500) * 20), np.exp(rng.normal(size=1500) * 20))), "few": [3.0, None, 1.0],
    }
    check(spark, groups, 100)


def test_small_groups_take_the_short_way(spark):
    check(spark, {"a": [1, 2, 3], "b": [4, 1]}, 50_000)
    assert exact_medians(spark.createDataFrame([], "unit string, v double"), ["unit"], "v").collect() == []


def test_several_keys(spark):
    rng = np.random.default_rng(7)
    rows = [(int(rng.integers(3)), "ab"[rng.integers(2)], float(rng.integers(500))) for _ in range(6000)]
    df = spark.createDataFrame(rows, "year int, unit string, v double")
    got = {(r.year, r.unit): r.median for r in exact_medians(df, ["year", "unit"], "v", 200).collect()}
    assert got == {(y, u): float(np.median([v for a, b, v in rows if (a, b) == (y, u)])) for y in range(3) for u in "ab"}
