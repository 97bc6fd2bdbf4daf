"""Registered model queries fit the stages once, with their defaults, and share the published models."""

import pytest

from yieldcast.models import search as SE
from yieldcast.models import train as T
from yieldcast.plans import catalog_models as Q


class Called(Exception):
    pass


def stop(seen, name):
    def stand_in(*args, **named):
        seen.append((name, args, named))
        raise Called
    return stand_in


QUERIES = ["predict_two_stage", "predict_channels", "channel_metrics", "tree_importance", "attribution", "attribution_stage1",
           "attribution_decomposition", "top_drivers", "extreme_rows", "mean_abs_attribution"]


@pytest.mark.parametrize("query", QUERIES)
def test_stages_run_with_defaults(query, monkeypatch):
    seen = []
    monkeypatch.setattr(Q, "_split", lambda spark, sf: ("train", "test"))
    monkeypatch.setattr(Q, "application_path", lambda spark, sf, name: name)
    monkeypatch.setattr(Q, "exists", lambda spark, path: False)
    monkeypatch.setattr(T, "train_all", stop(seen, "all"))
    with pytest.raises(Called):
        Q.QUERIES[query](None, "")
    assert seen == [("all", ("train", Q.VALID_YEARS, query in ("predict_channels", "channel_metrics")), {})]


def test_train_all_uses_defaults_and_refit(monkeypatch):
    seen = []
    for k in (1, 2, 3):
        monkeypatch.setattr(T, f"train_stage{k}", lambda df, years, k=k, **named: seen.append((k, named)))
    T.train_all("train", [2000])
    assert sorted(seen) == [(k, {"max_iter": T.MAX_ROUNDS}) for k in (1, 2, 3)]
    assert (T.MAX_ROUNDS, T.PATIENCE) == (2000, 50)


@pytest.mark.parametrize("query, name, trials", [("param_search", "search_stage1", 50), ("param_search_regressor", "search_stage2", 50),
                                                 ("param_search_channels", "search_stage3", 20)])
def test_searches_have_the_source_budget(query, name, trials, monkeypatch):
    import inspect
    seen, real = [], inspect.signature(getattr(SE, name))
    monkeypatch.setattr(Q, "_split", lambda spark, sf: ("train", "test"))
    monkeypatch.setattr(SE, name, stop(seen, name))
    with pytest.raises(Called):
        Q.QUERIES[query](None, "")
    bound = real.bind(*seen[0][1], **seen[0][2])
    bound.apply_defaults()
    assert (bound.arguments["n_trials"], bound.arguments["max_rounds"]) == (trials, 500)
    assert bound.arguments["seconds"] == Q.SEARCH_SECONDS


@pytest.mark.parametrize("trials", [SE.TRIALS, SE.CHANNEL_TRIALS])
def test_registered_studies_run_all_trials_however_long_they_take(trials, monkeypatch):
    class Model:
        trees, history = [0], [1.0]

    clock = iter(range(0, 10**9, 10_000))
    monkeypatch.setattr(SE.time, "monotonic", lambda: next(clock))

    def fit(params, watch):
        watch(0, 1.0)
        return Model

    rows = SE.study(fit, SE._least_loss, SE.SPACE, trials, Q.SEARCH_SECONDS)
    assert [r[0] for r in rows] == list(range(trials)) and {r[3] for r in rows} == {"complete"}
