import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldcast.operators import report as R
from yieldcast.operators.quantiles import quantiles

PROBS = [0.0, 0.05, 0.5, 0.95, 1.0]


def values():
    rng = random.Random(4)
    ties = [1.0] * 700 + [2.0] * 5
    skew = [math.exp(rng.gauss(0, 8)) for _ in range(800)]
    near = [0.1 + k * 1e-17 for k in range(300)] + [0.1 + 2.0 ** -50] * 300
    return {"ties": ties, "skew": skew, "near": near, "one": [3.5], "signs": [-1e308, 1e308, 0.0] * 50, None: [float(k) for k in range(100)]}


@pytest.mark.parametrize("few, ranges", [(10_000, 1024), (20, 64)])
def test_equal_to_percentile_on_ties_skew_and_null_keys(spark, few, ranges):
    rows = [(k, v, 7) for k, vs in values().items() for v in vs] + [("skew", None, 7), ("skew", math.nan, 7), ("gone", None, 7)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x double, n int").repartition(4)
    got = {r["g"]: r for r in quantiles(df, ["g"], "x", PROBS, few, ranges).collect()}
    clean = df.where("x is not null and not isnan(x)")
    want = {r["g"]: r["q"] for r in clean.groupBy("g").agg(F.percentile("x", PROBS).alias("q")).collect()}
    assert got.keys() == want.keys()
    for g, q in want.items():
        assert [got[g][f"q{i}"] for i in range(len(PROBS))] == pytest.approx(q, rel=1e-15) and got[g]["n"] == len(values()[g])


def test_whole_table_infinite_and_empty(spark):
    df = spark.createDataFrame([(float(k % 997),) for k in range(5000)] + [(math.inf,)] * 3 + [(-math.inf,)], "x double")
    r = quantiles(df, [], "x", PROBS, few=10, ranges=32).collect()
    xs = np.sort([k % 997 for k in range(5000)] + [math.inf] * 3 + [-math.inf])
    assert len(r) == 1 and r[0]["n"] == 5004 and r[0]["q0"] == -math.inf and r[0]["q4"] == math.inf
    assert r[0]["q2"] == (xs[2501] + xs[2502]) / 2
    none = quantiles(df.limit(0), [], "x", [0.5]).collect()
    assert [tuple(x) for x in none] == [(0, None)]
    assert quantiles(df.limit(0).withColumn("g", F.lit(1)), ["g"], "x", [0.5]).count() == 0


def test_report_uses_it(spark):
    df = spark.createDataFrame([(k / 1000 - 0.5, 0.4 + 0.2 * (k % 2)) for k in range(1001)], "deviation double, p_nonzero double")
    r = R.deviation_quantiles(df).first()
    xs = [k / 1000 - 0.5 for k in range(1001) if k % 2]
    assert r["q05"] == pytest.approx(np.quantile(xs, 0.05)) and r["q95"] == pytest.approx(np.quantile(xs, 0.95))
    assert r["mean_abs"] == pytest.approx(np.mean(np.abs(xs))) and r["mean_signed"] == pytest.approx(np.mean(xs))
