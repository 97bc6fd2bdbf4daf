"""Model invariants on small fits: channel rates sum to the combined rate, saved and fitted models score alike,
attributions add up, early stopping on real frames, sampled attributions in the output."""

import pytest
from pyspark.sql import functions as F

from yieldcast import schema as S
from yieldcast.models import attribution as AT
from yieldcast.models import score as SC
from yieldcast.models import search as SE
from yieldcast.models import train as T
from yieldcast.operators import clean as C
from yieldcast.plans import pipeline as PL
from yieldcast.plans.common import TEST_YEARS, TRAIN_YEARS, VALID_YEARS, raw
from yieldcast.plans.features import feature_table
from yieldcast.sources.fixture import with_carried_columns
from yieldcast.sources.stage import stage_table

KEYS = SC.ROW_KEYS
P = {"max_depth": 3, "learning_rate": 0.2}


@pytest.fixture(scope="module")
def split(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("features") / "table")
    ft = stage_table(spark, path, lambda: feature_table(with_carried_columns(raw(spark, "/root/testdata/sf0.001"))))
    return C.split_by_years(ft, TRAIN_YEARS, TEST_YEARS)


@pytest.fixture(scope="module")
def models(split):
    train, _ = split
    return T.train_stage1(train, VALID_YEARS, P, 8), T.train_stage2(train, VALID_YEARS, P, 8), T.train_stage3(train, VALID_YEARS, P, 4)


def test_channel_rates_sum_to_the_combined_rate(split, models):
    _, test = split
    m1, m2, m3 = models
    pred = SC.predict(m1, m2, test, m3, years=TEST_YEARS)
    total = sum((F.col(f"pred_{c}") for c in m3), F.lit(0.0))
    worst = pred.select(F.max(F.abs(total - F.col("combined_rate"))).alias("d"),
                        F.min("p_nonzero").alias("lo"), F.max("p_nonzero").alias("hi")).first()
    assert worst.d < 1e-5 and 0.0 <= worst.lo <= worst.hi <= 1.0
    assert pred.count() == test.count() and {S.MONTH, "units_total"} <= set(pred.columns)


def test_saved_models_score_alike(spark, split, models, tmp_path):
    _, test = split
    m1, m2, _ = models
    m2.save(f"{tmp_path}/stage2")
    again = T.StageModel.load(spark, f"{tmp_path}/stage2")
    a = SC.score_stage2(m2, test).select(*KEYS, F.col("e_rate").alias("a"))
    b = SC.score_stage2(again, test).select(*KEYS, F.col("e_rate").alias("b"))
    assert a.join(b, KEYS).filter(F.abs(F.col("a") - F.col("b")) > 1e-12).count() == 0


def test_attributions_add_up_in_both_stages(split, models):
    _, test = split
    m1, m2, _ = models
    ext = SC.score_stage2(m2, test)
    for m, df in ((m1, test), (m2, ext)):
        attr = AT.attribute(m, df, KEYS).join(AT.model_margin(m, df, KEYS), KEYS)
        assert attr.filter(F.abs(F.col("margin") - F.col("model_margin")) > 1e-9).count() == 0 and attr.count() == test.count()
    whole = AT.decompose(AT.attribute(m2, ext, KEYS, ["e_rate"]), AT.feature_names(m2))
    assert whole.filter(F.abs(F.col("full_rate") - F.col("e_rate")) > 1e-9).count() == 0
    drivers = AT.top_drivers(whole, AT.feature_names(m2), KEYS, 3)
    assert drivers.count() == 3 * test.count() and drivers.filter("detail is null or label is null").count() == 0


def test_sampled_attributions_stand_in_the_output(split, models):
    _, test = split
    m1, m2, _ = models
    every = SC.predict(m1, m2, test, years=TEST_YEARS, explain=True)
    some = SC.predict(m1, m2, test, years=TEST_YEARS, explain=True, explain_rows=7)
    assert every.filter("shap_baseline_rate is null").count() == 0
    assert some.count() == every.count() and some.filter("shap_baseline_rate is not null").count() == 7
    picked = some.where("shap_baseline_rate is not null").alias("s").join(every.alias("e"), KEYS)
    assert picked.where("abs(s.shap_deviation_contribution - e.shap_deviation_contribution) > 1e-9").count() == 0
    full = F.col("shap_baseline_rate") + F.col("shap_deviation_contribution")
    assert every.filter(F.abs(full - F.col("e_rate")) > 2e-6).count() == 0
    tables = PL.report_tables(every)
    assert {"attribution_by_site", "deviation_quantiles", "weekly_trend_gl"} <= set(tables) and "channel_trend_gl" not in tables
    assert "attribution_by_site" not in PL.report_tables(every.drop("shap_baseline_rate"))


def test_defaults_train_past_the_first_rounds(split):
    """Early stopping waits 50 rounds and the refit keeps the chosen number."""
    train, _ = split
    prepared, names = T.prepare_stage1(train, VALID_YEARS)
    with prepared:
        chosen = prepared.boost(names, T.DEFAULT_CLF_PARAMS, T.MAX_ROUNDS)
        assert len(chosen.history) - 1 == min(len(chosen.trees) + T.PATIENCE, T.MAX_ROUNDS)
        assert chosen.history[len(chosen.trees)] == min(chosen.history)


def test_channel_metrics(split, models):
    _, test = split
    _, _, m3 = models
    data = T.join_share_baselines(C.positive_rate(test), next(iter(m3.values())).lookups["share_baseline"])
    table = SE.channel_metrics(data.select(S.RATE, *m3, *[m.margin(data).alias(f"raw_{c}") for c, m in m3.items()]), m3).toPandas()
    pdf = data.select(S.RATE, *m3, *[m.margin(data).alias(f"raw_{c}") for c, m in m3.items()]).toPandas()
    assert list(table["channel"]) == list(table.sort_values(["test_mean_share", "channel"], ascending=[False, True])["channel"])
    for r in table.itertuples():
        y, p = pdf[r.channel] / pdf[S.RATE], 1 / (1 + 2.718281828459045 ** -pdf[f"raw_{r.channel}"])
        assert r.test_n == len(y) and abs(r.mae - (p - y).abs().mean()) < 1e-9 and abs(r.rmse - ((p - y) ** 2).mean() ** 0.5) < 1e-9
        assert abs(r.r2 - (1 - ((p - y) ** 2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-9 and r.best_round == m3[r.channel].rounds


def test_baselines_reach_wide_rows_by_one_join(split):
    """Fallbacks are resolved on pairs: wide rows go through one exchange, and null keys find their pair too."""
    from yieldcast.operators import baseline as B
    train, test = split
    nz = C.positive_rate(train)
    bl, pri = B.site_gl_baseline(nz), B.baseline_priors(nz)
    old = B.shrink_low_support(B.fill_baseline(B.join_baseline(test, bl), pri), pri).select(*KEYS, *B.BASELINE_COLS)
    new = B.with_baselines(test, bl, pri, S.MIN_SUPPORT)
    assert new.columns == [*test.columns, *B.BASELINE_COLS]
    got = sorted(map(tuple, new.select(*KEYS, *B.BASELINE_COLS).collect()), key=str)
    assert got == sorted(map(tuple, old.collect()), key=str)
    lost = test.limit(2).withColumn(S.SITE, F.lit(None).cast("string"))
    assert B.with_baselines(lost, bl, pri).where("site_gl_mean_rate is null").count() == 0


def test_pipeline_resumes_at_the_first_missing_stage(spark, tmp_path, monkeypatch):
    """A run that breaks off after training goes on from its saved models."""
    source = raw(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(PL, "load", lambda spark, paths: with_carried_columns(source))
    monkeypatch.setattr(T, "PATIENCE", 2)
    args = dict(train_years=TRAIN_YEARS, valid_years=VALID_YEARS, test_years=TEST_YEARS, max_rounds=2, explain_rows=20)

    class Broken(Exception):
        pass

    def fails(*a, **k):
        raise Broken

    monkeypatch.setattr(PL.SC, "predict", fails)
    with pytest.raises(Broken):
        PL.run(spark, ["x"], f"{tmp_path}/out", **args)
    monkeypatch.undo()
    for name in ("load", "feature_table"):
        monkeypatch.setattr(PL, name, fails)
    for name in ("train_stage1", "train_stage2", "train_stage3"):
        monkeypatch.setattr(T, name, fails)
    out = PL.run(spark, ["x"], f"{tmp_path}/out", **args)
    assert out["predictions"].where("shap_baseline_rate is not null").count() == 20
    assert {r[0] for r in out["channel_trend_sites"].select("channel").distinct().collect()} == set(T.MF.STAGE3_CHANNELS)
    monkeypatch.setattr(PL.SC, "predict", fails)
    again = PL.run(spark, ["x"], f"{tmp_path}/out", **args)
    assert again["overall_mae"].first() == out["overall_mae"].first()


def test_training_rows_of_one_class_are_fitted(spark):
    """Without negative rows all rows weigh 1, and stage 1 expects what it saw; its margin counts trees without a split."""
    from yieldcast.operators import baseline as B

    rows = [(f"s{i % 3}", "g", 1999 + i // 100, 1, i % 50 + 1, float(i % 7), 0.25 + 0.01 * (i % 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "hashed_fc string, gl_product_group string, year int, month int, week int, units_total double, prob_recovered double")
    weighted = B.with_class_weight(df.selectExpr("*", "1.0D as label"))
    assert {r["weight"] for r in weighted.select("weight").collect()} == {1.0}
    m = T.train_stage1(df, [2000], max_iter=5)
    assert m.rounds >= 1
    got = SC.score_stage1(m, df).selectExpr("min(p_nonzero)", "max(p_nonzero)").first()
    assert 0.999 < got[0] <= got[1] <= 1.0
    margin = df.select(m.margin(df).alias("m")).first()[0]
    assert margin == pytest.approx(m.ensemble.base + sum(float(t.value[0]) for t in m.ensemble.trees))
