"""Radix selection, class cuts and synthetic keys at sizes that used to take another path."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from staymill.operators import neighbours as N
from staymill.operators import split as SP
from staymill.plans.distributed import exact_quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.5001, 0.99, 1.0]


def test_quantiles_of_close_negative_and_infinite_values(spark):
    rng = np.random.default_rng(5)
    cols = {
        "close": 1.0 + rng.integers(0, 9, 4001) * 2.0**-52,  # apart in their last bits only
        "signed": rng.normal(size=4001) * 10.0 ** rng.integers(-300, 300, 4001),
        "ends": np.where(rng.random(4001) < 0.01, np.inf, np.where(rng.random(4001) < 0.01, -np.inf, rng.normal(size=4001))),
        "hot": np.where(rng.random(4001) < 0.9, -0.0, rng.integers(-3, 3, 4001)),
    }
    df = spark.createDataFrame(list(zip(*[map(float, v) for v in cols.values()])), ", ".join(f"{c} double" for c in cols))
    got = exact_quantiles(df, list(cols), PROBS)
    for c, v in cols.items():
        v = np.sort(v)
        for p, x in zip(PROBS, got[c]):
            low, high = int(np.floor(p * 4000)), int(np.ceil(p * 4000))
            assert x == v[low] if low == high or v[low] == v[high] else v[low] <= x <= v[high]


def test_quantiles_take_nulls_nan_and_whole_numbers(spark):
    df = spark.createDataFrame([(1, None, None), (2, float("nan"), None), (10, 3.0, None), (None, 1.0, None)], "i int, d double, e double")
    got = exact_quantiles(df, ["i", "d", "e"], [0.0, 0.5, 1.0])
    assert got["i"] == [1.0, 2.0, 10.0] and got["e"] == [None] * 3
    assert got["d"][:2] == [1.0, 3.0] and np.isnan(got["d"][2])


@pytest.mark.parametrize("classes", [3, 900])
def test_split_of_many_classes(spark, classes):
    """The quotas are exact for every class, and the plan does not grow with the number of classes."""
    df = spark.range(20_000).selectExpr("id as k", f"if(id % {classes} = 1, null, cast(id % {classes} as string)) as c")
    began = time.time()
    got = {(r["c"], r["split"]): r["count"] for r in SP.split_stratified(df, "c", 0.25, key="k").groupBy("c", "split").count().collect()}
    assert time.time() - began < 40
    want = SP._allocate({r["c"]: r["count"] for r in df.groupBy("c").count().collect()}, 0.25)
    assert {c: n for (c, s), n in got.items() if s == "test"} == {c: n for c, n in want.items() if n}
    assert sum(got.values()) == 20_000


def test_synthetic_keys_of_large_ids(spark):
    rows = [(9_200_000_000_000_000_000 + i, [float(i), 0.0], 1) for i in range(3)] + [(i, [float(i), 1.0], 0) for i in range(50)]
    made = N.smote(spark.createDataFrame(rows, "k long, v array<double>, y int"), "v", "y", "k", k=2).collect()
    assert sorted(r["synthetic"] for r in made) == list(range(-47, 0))
    assert {r["base"] for r in made} == {r[0] for r in rows[:3]}
