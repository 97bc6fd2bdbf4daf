import json

import numpy as np

from tests.test_booster import frame
from yieldcast.models import search as SE
from yieldcast.models import train as T


def test_parameters_stay_in_their_ranges_and_runs_agree():
    done = []
    for _ in range(40):
        p = SE.propose(done, SE.CLASSIFIER_SPACE, 7)
        assert p == SE.propose(done, SE.CLASSIFIER_SPACE, 7)
        for k, (lo, hi, _, whole) in SE.CLASSIFIER_SPACE.items():
            assert lo <= p[k] <= hi and isinstance(p[k], int if whole else float)
        done.append((p, abs(np.log(p["learning_rate"] / 0.05)) + abs(p["gamma"] - 4.0)))


def test_the_sampler_finds_better_parameters_than_chance():
    def target(p):
        return (np.log(p["learning_rate"] / 0.02)) ** 2 + (p["subsample"] - 0.9) ** 2 * 10 + (p["max_depth"] - 7) ** 2 * 0.1

    guided, chance = [], []
    for seed in range(12):
        done = []
        for _ in range(50):
            p = SE.propose(done, SE.SPACE, seed)
            done.append((p, target(p)))
        guided.append(np.mean([v for _, v in done[-15:]]))
        chance.append(np.mean([v for _, v in done[:10]]))
    assert np.mean(guided) < 0.5 * np.mean(chance)


def test_density_is_high_where_points_are():
    d = SE.Density([0.2, 0.21, 0.22])
    x = np.linspace(0, 1, 101)
    assert 0.1 < x[np.argmax(d.log(x))] < 0.3
    assert ((0 <= d.draw(np.random.default_rng(0), 100)) & (d.draw(np.random.default_rng(0), 100) <= 1)).all()


def test_pruner_waits_and_compares_with_the_median():
    pruner = SE.Pruner([[1.0] * 30 for _ in range(SE.STARTUP_TRIALS)])
    assert not pruner.worse([2.0] * SE.WARMUP_ROUNDS)
    assert pruner.worse([2.0] * (SE.WARMUP_ROUNDS + 1)) and not pruner.worse([0.5] + [2.0] * SE.WARMUP_ROUNDS)
    assert not pruner.worse([2.0] * (SE.WARMUP_ROUNDS + 2))
    assert not SE.Pruner([[1.0] * 30]).worse([2.0] * (SE.WARMUP_ROUNDS + 1))


def test_a_study_ends_by_trials_or_time_and_keeps_its_first_trial(spark):
    with T.prepare(frame(spark), ["a", "b"], ["c"], ["z"], "logistic") as p:
        names = p.binning.names

        def fit(params, watch):
            return p.boost(names, params, 6, 3, watch=watch)

        rows = SE.study(fit, SE._average_precision(p, names), SE.CLASSIFIER_SPACE, 4, 600)
        assert [r[0] for r in rows] == [0, 1, 2, 3] and all(-1.0 <= r[1] <= 0.0 for r in rows) and min(r[1] for r in rows) < -0.7
        assert all(set(json.loads(r[4])) == set(SE.CLASSIFIER_SPACE) for r in rows)
        short = SE.study(fit, SE._least_loss, SE.SPACE, 50, 0.0)
        assert len(short) == 1 and short[0][3] == "complete"
