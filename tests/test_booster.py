"""The boosted learner against a plain one that tries every split of every node, row by row."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldcast.models import booster as BO
from yieldcast.models import train as T

ROWS = 500


def frame(spark, rows=ROWS, seed=3, noise=0.3):
    """Two numeric columns with missing values, a category and a label that depends on all; the last fifth validates."""
    rng = np.random.default_rng(seed)
    out = []
    for k in range(rows):
        a, b, c = float(rng.normal()), float(rng.integers(0, 6)), str(rng.choice(["x", "y", "z", "w"]))
        y = (a > 0.2) * 2.0 - (b > 3) * 1.5 * (c in "xz") + (0.7 if k % 7 == 0 else 0.0) + float(rng.normal()) * noise
        out.append((None if k % 7 == 0 else a, float("nan") if k % 31 == 0 else b, None if k % 53 == 0 else c, y, float(y > 0.5), 1.0 + k % 3, k >= rows * 4 // 5))
    return spark.createDataFrame(out, "a double, b double, c string, y double, z double, w double, is_valid boolean")


def prepared(spark, objective, df=None):
    label = "z" if objective == "logistic" else "y"
    return T.prepare(frame(spark) if df is None else df, ["a", "b"], ["c"], [label], objective, ["w"])


def arrays(p):
    blocks = p.blocks.collect()
    return (np.concatenate([b["codes"] for b in blocks], axis=1), np.concatenate([b["y"][0] for b in blocks]),
            np.concatenate([b["w"][0] for b in blocks]), np.concatenate([b["valid"] for b in blocks]))


class Plain:
    """One split at a time, every subset that a split may send left, exact sums."""

    def __init__(self, p, objective, slots):
        self.p, self.objective, self.slots = BO.DEFAULTS | p, objective, slots

    def weight(self, g, h):
        p = self.p
        w = -math.copysign(max(abs(g) - p["reg_alpha"], 0), g) / (h + p["reg_lambda"])
        return max(-p["max_delta_step"], min(p["max_delta_step"], w)) if p["max_delta_step"] else w

    def score(self, g, h):
        w = self.weight(g, h)
        return -(2 * g * w + (h + self.p["reg_lambda"]) * w * w + 2 * self.p["reg_alpha"] * abs(w))

    def best(self, codes, g, h, category):
        found = (-math.inf, None, None)
        for f in range(codes.shape[0]):
            order = list(range(self.slots - 1))
            if category[f]:
                def ratio(s):
                    at = codes[f] == s
                    return g[at].sum() / (h[at].sum() + self.p["reg_lambda"]) if h[at].sum() > 0 else math.inf
                order.sort(key=ratio)
            for missing in ((), (self.slots - 1,)):
                for cut in range(1, self.slots):
                    left = np.isin(codes[f], [*order[:cut], *missing])
                    if h[left].sum() < self.p["min_child_weight"] or h[~left].sum() < self.p["min_child_weight"] or not left.any() or left.all():
                        continue
                    gain = self.score(g[left].sum(), h[left].sum()) + self.score(g[~left].sum(), h[~left].sum()) - self.score(g.sum(), h.sum())
                    if gain > found[0] + 1e-9:
                        found = (gain, f, left)
        return found

    def tree(self, codes, g, h, category, depth):
        out = np.full(codes.shape[1], self.p["learning_rate"] * self.weight(g.sum(), h.sum()))
        if depth < self.p["max_depth"]:
            gain, f, left = self.best(codes, g, h, category)
            if f is not None and gain >= max(self.p["gamma"], 1e-6):
                for side in (left, ~left):
                    out[side] = self.tree(codes[:, side], g[side], h[side], category, depth + 1)
        return out

    def fit(self, codes, y, w, category, rounds):
        mean = (w * y).sum() / w.sum()
        margin = np.full(len(y), math.log(mean / (1 - mean)) if self.objective == "logistic" else mean)
        for _ in range(rounds):
            g, h = BO.gradients(self.objective, margin, y, w)
            margin = margin + self.tree(codes, g, h, category, 0)
        return margin


@pytest.mark.parametrize("objective, params", [
    ("squared", {"max_depth": 3, "learning_rate": 0.3}),
    ("squared", {"max_depth": 4, "learning_rate": 0.2, "reg_alpha": 6.0, "reg_lambda": 0.0, "gamma": 2.0, "min_child_weight": 12}),
    ("logistic", {"max_depth": 3, "learning_rate": 0.5, "reg_lambda": 5.0, "min_child_weight": 4}),
    ("logistic", {"max_depth": 3, "learning_rate": 0.5, "max_delta_step": 0.3, "reg_alpha": 0.5, "gamma": 0.4}),
])
def test_equals_a_plain_booster(spark, objective, params):
    with prepared(spark, objective) as p:
        codes, y, w, valid = arrays(p)
        model = BO.boost(p.blocks, p.binning, objective, params, 4)
        want = Plain(params, objective, p.binning.slots).fit(codes[:, ~valid], y[~valid], w[~valid], p.binning.is_category, 4)
        assert np.allclose(model.margin(codes[:, ~valid]), want, atol=1e-5)
        assert any(t.side[0, -1] or not t.side[0, -1] for t in model.trees) and len(model.trees) == 4


@pytest.mark.parametrize("name, value", [("gamma", 1e9), ("reg_lambda", 1e9), ("reg_alpha", 1e9), ("min_child_weight", 1e9), ("max_delta_step", 1e-9)])
def test_every_parameter_acts(spark, name, value):
    with prepared(spark, "squared") as p:
        codes, *_ = arrays(p)
        model = BO.boost(p.blocks, p.binning, "squared", {"max_depth": 2, "learning_rate": 1.0, name: value}, 1)
        spread = np.ptp(model.margin(codes))
        assert spread < 1e-3 < np.ptp(BO.boost(p.blocks, p.binning, "squared", {"max_depth": 2, "learning_rate": 1.0}, 1).margin(codes))


def test_a_fit_does_not_depend_on_partitions(spark):
    params = {"max_depth": 4, "learning_rate": 0.3, "subsample": 0.7, "colsample_bytree": 0.7}
    with prepared(spark, "logistic", frame(spark, 3000).repartition(6)) as p:
        fits = []
        for parts in (1, 5):
            blocks = p.blocks.flatMap(lambda b: [{k: (v if v is None else v[..., at]) for k, v in b.items()} for at in np.array_split(np.arange(len(b["keys"])), 3)])
            fits.append(BO.boost(blocks.repartition(parts), p.binning, "logistic", params, 12, patience=50))
        one, many = fits
        assert one.history == many.history and len(one.trees) == len(many.trees) > 0
        for s, t in zip(one.trees, many.trees):
            assert all(np.array_equal(x, y) for x, y in zip(vars(s).values(), vars(t).values()))


def test_a_tree_count_far_beyond_the_first_small_gain(spark):
    """At a small step each round lowers the loss by far less than a thousandth; training must not end there."""
    with prepared(spark, "squared", frame(spark, 800, noise=0.05)) as p:
        model = BO.boost(p.blocks, p.binning, "squared", {"max_depth": 2, "learning_rate": 0.005}, 75, patience=50)
        assert len(model.trees) > 60 and len(model.history) == 76
        assert model.history[len(model.trees)] == min(model.history)


def test_training_waits_for_a_dip_after_a_plateau_and_cuts_at_the_best_round(spark):
    """Fitted rows teach a wrong level first: the validation loss rises, then falls below its start."""
    rows = [(float(k % 2), 2.0 if k % 2 else 0.0, k % 10 == 9) for k in range(400)]
    df = spark.createDataFrame(rows, "a double, y double, is_valid boolean")
    with T.prepare(df, ["a"], [], ["y"], "squared") as p:
        losses = []
        patient = BO.boost(p.blocks, p.binning, "squared", {"max_depth": 1, "learning_rate": 0.3}, 40, patience=10,
                           watch=lambda r, v: losses.append(v))
        # all validation rows have a = 1, so a model that has learnt the two levels is best
        assert patient.history[len(patient.trees)] == min(patient.history) and len(patient.trees) > 3
        assert losses == patient.history[:len(losses)]
    noise = spark.createDataFrame([(float(k % 5), float((k * 7919) % 13), k % 3 == 0) for k in range(300)], "a double, y double, is_valid boolean")
    with T.prepare(noise, ["a"], [], ["y"], "squared") as p:
        model = BO.boost(p.blocks, p.binning, "squared", {"max_depth": 3, "learning_rate": 1.0}, 200, patience=8)
        assert len(model.history) - 1 == len(model.trees) + 8       # it went on for 8 rounds and cut them


def test_carried_margins_equal_those_from_all_trees(spark, monkeypatch):
    monkeypatch.setattr(BO, "REBASE", 3)
    monkeypatch.setattr(BO, "WHOLE", 2)
    with prepared(spark, "squared") as p:
        params = {"max_depth": 3, "learning_rate": 0.3}
        short = BO.boost(p.blocks, p.binning, "squared", params, 14)
    monkeypatch.setattr(BO, "REBASE", 1000)
    with prepared(spark, "squared") as p:
        codes, *_ = arrays(p)
        assert np.allclose(short.margin(codes), BO.boost(p.blocks, p.binning, "squared", params, 14).margin(codes), atol=1e-9)


def test_columns_give_the_margins_of_blocks(spark):
    df = frame(spark)
    with prepared(spark, "squared", df.repartition(1)) as p:
        codes, y, *_ = arrays(p)
        model = BO.boost(p.blocks, p.binning, "squared", {"max_depth": 4, "learning_rate": 0.3}, 5)
        got = {r["y"]: r["m"] for r in df.select("y", model.column(df).alias("m")).collect()}
        want = dict(zip(y.tolist(), model.margin(codes).tolist()))
        assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in got) < 1e-12
        unseen = spark.createDataFrame([(None, float("inf"), "never seen"), (float("-inf"), None, None)], "a double, b double, c string")
        assert all(math.isfinite(r[0]) for r in unseen.select(model.column(unseen)).collect())
        gains = model.importance(spark).collect()
        assert {r["feature"] for r in gains} <= {"a", "b", "c"} and gains[0]["total_gain"] == max(r["total_gain"] for r in gains)


def test_saved_models_are_whole_and_equal(spark, tmp_path):
    df = frame(spark)
    with prepared(spark, "logistic", df) as p:
        names = p.binning.names
        model = T.StageModel(p.boost(names, {"max_depth": 3}, 6, patience=6), {"max_depth": 3}, {"lookup": spark.range(3).toDF("k")})
    model.save(f"{tmp_path}/m")
    again = T.StageModel.load(spark, f"{tmp_path}/m")
    assert again.ensemble.history == model.ensemble.history and again.params == model.params and again.lookups["lookup"].count() == 3
    assert df.select(F.max(F.abs(model.margin(df) - again.margin(df)))).first()[0] == 0.0
    spark.createDataFrame([('{"other": 1}',)], "meta string").write.text(f"{tmp_path}/other/meta")
    with pytest.raises(TypeError):
        T.StageModel.load(spark, f"{tmp_path}/other")


def test_no_rows_to_fit(spark):
    df = frame(spark).withColumn("is_valid", F.lit(True))
    with prepared(spark, "squared", df) as p, pytest.raises(ValueError):
        BO.boost(p.blocks, p.binning, "squared", {}, 2)


def test_of_two_sibling_nodes_only_the_smaller_one_is_added_up(spark, monkeypatch):
    added = []
    plain = BO._Growth.add_up

    def counted(self, nodes):
        added.append((len(self.g), sum(len(self.rows[n]) for n in nodes)))
        return plain(self, nodes)

    monkeypatch.setattr(BO._Growth, "add_up", counted)
    with prepared(spark, "squared") as p:
        whole = [b | {"margin": BO._margin(b, BO._Pass("squared", 0, 0.0, [], None, [], [], 1.0, 0, False, p.binning.slots))} for b in p.blocks.collect()]
        task = BO._Pass("squared", 0, 0.0, [], None, [0], [0, 1, 2], 1.0, 7, False, p.binning.slots)
        block = BO._merged(whole)
        growth, params = BO._Growth(block, task), BO.DEFAULTS | {"max_depth": 5}

        def run(growing, open_nodes, chosen, evaluate):
            sums = growth.level(growing, open_nodes)
            again = BO._Pass("squared", 0, 0.0, [], growing, open_nodes, chosen, 1.0, 7, False, p.binning.slots)
            assert np.array_equal(sums, BO._sums(iter([block]), again)[0])
            return BO.best_splits(sums, chosen, p.binning.is_category[chosen], params), 0, 0

        tree, *_ = BO._grow(run, [0, 1, 2], p.binning.slots, params)
        assert np.array_equal(growth.output(tree), tree.output(block["codes"]))
    assert len(added) == 5 and added[0][0] == added[0][1]
    assert all(n <= every // 2 for every, n in added[1:])
