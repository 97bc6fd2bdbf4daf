"""Hand-made frames for the cleaning, aggregation, share and baseline operators."""

import math

import pytest
from pyspark.sql import functions as F

from yieldcast import schema as S
from yieldcast.functions import scalar as FN
from yieldcast.operators import aggregate as A
from yieldcast.operators import baseline as B
from yieldcast.operators import clean as C
from yieldcast.operators import metrics as M
from yieldcast.operators import temporal as W


def test_safe_and_ieee_division(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (-2.0, 0.0), (3.0, 2.0), (None, 1.0)], "a double, b double")
    rows = df.select(FN.safe_div("a", "b").alias("s"), FN.ieee_div("a", "b").alias("i"),
                     FN.nan_to_zero(FN.ieee_div("a", "b")).alias("z")).collect()
    assert [r.s for r in rows] == [None, None, None, 1.5, None]
    assert rows[0].i == math.inf and math.isnan(rows[1].i) and rows[2].i == -math.inf
    assert rows[1].z == 0.0 and rows[4].i is None


def test_round_half_away_matches_scaled_rounding(spark):
    df = spark.createDataFrame([(1050.1021875,), (0.1234565,), (2.5e-7,), (float("nan"),)], "x double")
    got = [r[0] for r in df.select(FN.round_half_away("x", 6)).collect()]
    assert got[0] == round(1050.1021875 * 1e6) / 1e6 or got[0] == 1050.102187
    assert math.isnan(got[3])


def test_clean_filters_and_flag(spark):
    rows = [("s", 2022, 1, 1, 1, "Sales", 5), ("s", 2022, 1, 1, None, "Sales", 5),
            ("s", 2022, 1, 1, -1, "Sales", 5), ("s", 2022, 1, 1, 2, "C-Returns", 5),
            ("s", 2022, 1, 1, 2, None, 5), ("s", 2022, 1, 1, 3, "Donations", 7)]
    df = spark.createDataFrame(rows, "hashed_fc string, year int, month int, week int, gl_product_group int, "
                                     "recovery_type string, units long").withColumn("marketplace_id", F.lit("x"))
    out = C.clean_records(df).collect()
    assert sorted((r.gl_product_group, r.recovery) for r in out) == [(1, 0), (3, 1)]
    assert [c for c in C.clean_records(df).columns] == S.CLEAN_COLUMNS


def test_aggregate_zero_units_and_consolidation(spark):
    rows = [("s", 2022, 1, 1, 1, "Remove Return", 0, "RETAIL", "Food", "N"),
            ("s", 2022, 1, 1, 1, "Bintool Donations", 0, "FBA", "Food", "Y"),
            ("s", 2022, 1, 1, 1, "Bintool Theft", 0, "FBA", "Food", "Y")]
    df = spark.createDataFrame(rows, "hashed_fc string, year int, month int, week int, gl_product_group int, "
                                     "recovery_type string, units long, macro_category string, product_type string, "
                                     "is_hazmat string")
    for c in S.SITE_ATTRIBUTES:
        df = df.withColumn(c, F.lit("a"))
    df = df.withColumn("cogs", F.lit(1.0)).withColumn("weight", F.lit(0.0))
    agg = A.unit_averages(A.unit_shares(A.consolidate_channels(A.aggregate_site_gl_week(df)))).first()
    assert agg.num_records == 3 and agg.units_total == 0
    assert agg.prob_recovered is None and agg.avg_weight_per_unit is None
    assert "units_bintool_donations" not in agg.asDict() and agg.units_disposal == 0


def test_site_week_ratios_nan_and_inf(spark):
    rows = [("s", 1, 0, 0, 0.0), ("s", 2, 0, 0, 0.0)]
    df = spark.createDataFrame(rows, "hashed_fc string, gl_product_group int, units_total long, "
                                     "units_recovered long, weight_total double")
    df = df.withColumn("week_date", F.to_date(F.lit("2022-01-03")))
    for c in ["units_donations", "units_disposal", "units_warehouse_deals_and_gr", "units_liquidations",
              "units_sales", "units_return_to_vendor"]:
        df = df.withColumn(c, F.lit(0).cast("long"))
    r = W.gl_share_of_site(W.site_week_totals(df)).first()
    assert math.isnan(r.site_units_share_week) and r.site_recovered_share_week == 0.0


def test_baseline_one_row_std_null_and_fill(spark):
    rows = [("a", 1, 0.5), ("a", 1, 0.7), ("b", 2, 0.2)]
    df = spark.createDataFrame(rows, "hashed_fc string, gl_product_group int, prob_recovered double")
    bl = {(r.hashed_fc, r.gl_product_group): r for r in B.site_gl_baseline(df).collect()}
    assert bl[("b", 2)].site_gl_std_rate is None
    pri = B.baseline_priors(df)
    test = spark.createDataFrame([("a", 2, 0.1), ("c", 9, 0.1)], "hashed_fc string, gl_product_group int, prob_recovered double")
    out = {r.hashed_fc: r for r in B.fill_baseline(B.join_baseline(test, B.site_gl_baseline(df)), pri).collect()}
    assert out["a"].site_gl_mean_rate == pytest.approx(0.2)      # GL 2 prior
    assert out["c"].site_gl_mean_rate == pytest.approx(1.4 / 3)  # global prior
    assert out["c"].site_gl_n_nonzero_weeks == 0


def test_holdout_exact_and_repeatable(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("hashed_fc"), (F.col("id") % 7).cast("int").alias("gl_product_group"))
    h1 = B.holdout_pairs(df, 0.05, 42).collect()
    h2 = B.holdout_pairs(df, 0.05, 42).collect()
    assert len(h1) == 50 and sorted(h1) == sorted(h2)
    rest = B.remove_pairs(df, B.holdout_pairs(df, 0.05, 42))
    kept = B.semi_join_keys(df, B.holdout_pairs(df, 0.05, 42), B.PAIR)
    assert rest.count() + kept.count() == 1000


def test_stratified_sample_equal_counts(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 2000, "big").when(F.col("id") < 2990, "mid")
                                   .otherwise("tiny").alias("bucket"))
    out = B.stratified_sample(df, 300, "bucket", ["id"]).groupBy("bucket").count().collect()
    got = {r.bucket: r["count"] for r in out}
    assert got == {"big": 100, "mid": 100, "tiny": 10}


def test_auc_ap_with_ties_against_bruteforce(spark):
    data = [(0.9, 1), (0.8, 1), (0.8, 0), (0.5, 1), (0.5, 0), (0.5, 0), (0.1, 0), (0.1, 1)]
    df = spark.createDataFrame(data, "p double, y int")
    auc = M.roc_auc(df, "p", "y").first()[0]
    pos = [p for p, y in data if y == 1]
    neg = [p for p, y in data if y == 0]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert auc == pytest.approx(want)
    ap = M.average_precision(df, "p", "y").first()[0]
    thresholds = sorted({p for p, _ in data}, reverse=True)
    prev_r, want_ap = 0.0, 0.0
    for t in thresholds:
        tp = sum(1 for p, y in data if p >= t and y == 1)
        fp = sum(1 for p, y in data if p >= t and y == 0)
        r = tp / len(pos)
        want_ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    assert ap == pytest.approx(want_ap)


def test_threshold_sweep_single_class(spark):
    df = spark.createDataFrame([(0.2, 0), (0.7, 0)], "p double, y int")
    rows = M.threshold_sweep(df, "p", "y").collect()
    assert len(rows) == 19 and all(r.f1 == 0.0 and r.recall == 0.0 for r in rows)


def test_buckets_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.3,), (0.6,), (None,), (float("nan"),)], "r double")
    ex = [r[0] for r in df.select(FN.rate_bucket("r")).collect()]
    inc = [r[0] for r in df.select(FN.rate_bucket("r", inclusive=True)).collect()]
    assert ex == ["zero", "10-30%", "30-60%", ">60%", ">60%", ">60%"]
    assert inc == ["zero", "0-10%", "10-30%", "30-60%", ">60%", ">60%"]
    v = spark.createDataFrame([(9,), (10,), (99,), (100,), (999,), (1000,)], "u long")
    assert [r[0] for r in v.select(FN.volume_bucket("u")).collect()] == ["<10", "10-100", "10-100", "100-1k", "100-1k", ">1k"]
