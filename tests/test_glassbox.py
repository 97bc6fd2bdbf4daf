"""The additive model against a cyclic booster that keeps every row's residual."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldcast.models import booster as BO
from yieldcast.models import glassbox as G


def frame(spark, rows=900, seed=5):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(rows):
        a, b, c, d = float(rng.normal()), float(rng.integers(0, 5)), str(rng.choice(["x", "y", "z"])), float(rng.normal())
        y = np.sin(2 * a) + 0.4 * b + (c == "z") + float(rng.normal()) * 0.3
        out.append((None if k % 13 == 0 else a, b, None if k % 29 == 0 else c, d, float(y), float(y > 1.0), 1.0 + k % 2))
    return spark.createDataFrame(out, "a double, b double, c string, d double, y double, z double, w double")


def plain(prepared, rate, max_rounds, patience, bags):
    """Tables and intercept by boosting rows, bag by bag."""
    binning, logistic = prepared.binning, prepared.objective == "logistic"
    blocks = prepared.blocks.collect()
    size = G.sizes(binning)
    terms = [(f,) for f in range(len(size))]
    bins = np.concatenate([G.term_bins(b["codes"], terms, size, binning.slots) for b in blocks], axis=1)
    y, w = (np.concatenate([b[k][0] for b in blocks]) for k in ("y", "w"))
    bag = np.concatenate([G._bags(b, bags) for b in blocks])
    mean = (w * y).sum() / w.sum()
    base = np.log(mean / (1 - mean)) if logistic else mean
    total = [np.zeros(s) for s in size]
    for k in range(bags):
        fit = bag != k
        tables, margin, done = [np.zeros(s) for s in size], np.full(len(y), base), 0

        def loss():
            v = BO.losses("logistic", margin, y) if logistic else 0.5 * (y - margin) ** 2
            return (w * v)[~fit].sum() / w[~fit].sum()

        best, every = (loss(), 0, [t.copy() for t in tables]), G.REFRESH if logistic else 1
        while done < max_rounds:
            r = (w * (y - BO._sigmoid(margin)) if logistic else w * (y - margin))[fit]
            h = (0.25 * w if logistic else w)[fit]
            for _ in range(every):
                for f, s in enumerate(size):
                    at = bins[f, fit]
                    step = rate * np.bincount(at, weights=r, minlength=s) / (np.bincount(at, weights=h, minlength=s) + G.RIDGE)
                    tables[f] += step
                    r = r - h * step[at]
            margin = base + sum(t[bins[f]] for f, t in enumerate(tables))
            done += every
            now = loss()
            if now < best[0]:
                best = (now, done, [t.copy() for t in tables])
            elif done - best[1] >= patience:
                break
        for f in range(len(size)):
            total[f] += best[2][f] / bags
    for f, s in enumerate(size):
        n = np.bincount(bins[f], minlength=s)
        shift = (total[f] * n).sum() / n.sum()
        total[f] -= shift
        base += shift
    return total, base


@pytest.mark.parametrize("label, kind", [("y", "regressor"), ("z", "classifier")])
def test_tables_equal_a_plain_cyclic_booster(spark, label, kind):
    with G.prepare_additive(frame(spark), ["a", "b", "d"], label, kind, "w", bins=8) as p:
        model = G.fit_prepared(p, bags=2, rate=0.1, max_rounds=60, patience=20)
        tables, base = plain(p, 0.1, 60, 20, 2)
        assert model.intercept == pytest.approx(base, abs=1e-4)
        for got, want in zip(model.tables, tables):
            assert np.allclose(got, want, atol=1e-4)
        assert max(model.rounds) > 0


def test_early_stopping_keeps_the_best_round(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(rng.normal()), float(rng.normal())) for _ in range(120)], "a double, y double")
    with G.prepare_additive(df, ["a"], "y", "regressor", bins=16) as p:
        assert max(G.fit_prepared(p, rate=0.5, max_rounds=400, patience=10).rounds) < 100


@pytest.mark.parametrize("label, kind", [("y", "regressor"), ("z", "classifier")])
def test_xor_of_two_weak_features_ranks_first_of_all_pairs(spark, label, kind):
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(2500):
        x = rng.normal(size=6)
        y = 1.2 * x[0] + 0.8 * x[1] + 1.5 * ((x[4] > 0) != (x[5] > 0)) + rng.normal() * 0.5
        rows.append((*map(float, x), float(y), float(y > 0.7)))
    names = [f"f{i}" for i in range(6)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names) + ", y double, z double")
    table = G.interactions(df, names, label, kind, pairs=3).collect()
    assert (table[0]["feature_a"], table[0]["feature_b"]) == ("f4", "f5") and table[0]["gain"] > 5 * table[1]["gain"]
    assert table[0]["importance"] == max(r["importance"] for r in table) and len(table) == 3
    with G.prepare_additive(df, names, label, kind) as p:
        assert len(G.screen_pairs(p, G.fit_prepared(p, max_rounds=20))) == 15


def test_quadrant_gain_tries_every_cut():
    rng = np.random.default_rng(3)
    r, h = rng.normal(size=(5, 4)), rng.uniform(1, 3, size=(5, 4))
    best = max(sum(q.sum() ** 2 / (v.sum() + G.RIDGE) for q, v in ((r[:i, :j], h[:i, :j]), (r[:i, j:], h[:i, j:]), (r[i:, :j], h[i:, :j]), (r[i:, j:], h[i:, j:])))
               for i in range(1, 5) for j in range(1, 4))
    assert G.quadrant_gain(r, h) == pytest.approx(best - r.sum() ** 2 / (h.sum() + G.RIDGE))


def test_contributions_add_up_and_tables_read_well(spark):
    df = frame(spark, 400)
    with G.prepare_additive(df, ["a", "b", "c"], "y", "regressor", "w", bins=6) as p:
        model = G.with_pairs(p, G.fit_prepared(p, max_rounds=30), [(0, 1)], max_rounds=10)
    odd = spark.createDataFrame([(None, float("nan"), "unseen", None, None, None, None), (float("inf"), -1.0, None, None, None, None, None)], df.schema)
    rows = df.limit(50).unionAll(odd).withColumn("id", F.monotonically_increasing_id()).persist()
    long = G.contributions(model, rows, ["id"])
    assert {r[0] for r in long.select("feature").distinct().collect()} == {"a", "b", "c", "a__x__b", "intercept"}
    worst = (long.groupBy("id").agg(F.sum("contribution").alias("s")).join(G.margin(model, rows).select("id", "margin"), "id")
             .select(F.max(F.abs(F.col("s") - F.col("margin"))), F.count("*")).first())
    assert worst[0] < 1e-9 and worst[1] == 52
    assert G.importance(model).count() == 4
    shape = G.shape_function(model, "c").collect()
    assert [r["category"] for r in shape] == ["x", "y", "z", None] and sum(r["n"] for r in shape) == 400
    numeric = G.shape_function(model, "a").collect()
    assert numeric[0]["lower"] == float("-inf") and numeric[-1]["lower"] is None and numeric[-1]["n"] == sum(k % 13 == 0 for k in range(400))
    with pytest.raises(ValueError):
        G.shape_function(model, "absent")
