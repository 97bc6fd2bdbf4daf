"""Registered queries: baselines, priors, sampling, scalar functions and metrics.

Means of the (6-decimal) rate are taken in fixed point on both sides, see
``fixed_point_mean``. Metric queries score the test year with the model-free baseline of the
training years (the pair's mean positive rate, and the pair's share of
non-zero weeks as P(rate > 0)), so the SQL oracle needs no model.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from yieldcast import schema as S
from yieldcast.functions import scalar as FN
from yieldcast.models import train as T
from yieldcast.operators import baseline as B
from yieldcast.operators import clean as C
from yieldcast.operators import metrics as M
from yieldcast.operators import temporal as W
from yieldcast.plans import oracles as O
from yieldcast.plans.common import TEST_YEARS, TRAIN_YEARS, finalize, raw, weekly

PK = [S.SITE, S.GL, S.YEAR, S.MONTH, S.WEEK]


def _train_test(spark, sf):
    return C.split_by_years(weekly(spark, sf), TRAIN_YEARS, TEST_YEARS)


def _baseline_inputs(spark, sf):
    train, test = _train_test(spark, sf)
    train_nz = C.positive_rate(train)
    return train_nz, C.positive_rate(test), B.site_gl_baseline(train_nz), B.baseline_priors(train_nz)


def _filled_test(spark, sf):
    train_nz, test_nz, bl, pri = _baseline_inputs(spark, sf)
    return B.with_baselines(test_nz, bl, pri)


def _scored_test(spark, sf):
    """Test rows with p = pair's training share of non-zero weeks (global share if unseen)."""
    train, test = _train_test(spark, sf)
    nz = (F.col(S.RATE) > 0).cast("double")
    pair = train.groupBy(S.SITE, S.GL).agg(F.avg(nz).alias("_pair_p"))
    gprior = train.agg(F.avg(nz).alias("_glob_p"))
    return (test.join(pair, on=[S.SITE, S.GL], how="left").crossJoin(F.broadcast(gprior))
                .select(*PK, S.RATE, F.coalesce("_pair_p", "_glob_p").alias("p_nonzero"),
                        C.binary_label().cast("int").alias("label")))


def q_site_gl_baseline(spark, sf):
    return finalize(_baseline_inputs(spark, sf)[2])


def q_baseline_priors(spark, sf):
    return finalize(B.prior_levels(_baseline_inputs(spark, sf)[0]))


def q_baseline_fill(spark, sf):
    return finalize(_filled_test(spark, sf).select(*PK, *B.BASELINE_COLS))


def q_min_support_shrinkage(spark, sf):
    train_nz, test_nz, bl, pri = _baseline_inputs(spark, sf)
    df = B.with_baselines(test_nz, bl, pri, S.MIN_SUPPORT)
    return finalize(df.select(*PK, *B.BASELINE_COLS))


def q_unseen_pair_share(spark, sf):
    train_nz, test_nz, bl, pri = _baseline_inputs(spark, sf)
    return finalize(B.unseen_share(B.join_baseline(test_nz, bl)))


def q_holdout_share(spark, sf):
    train_nz, _, bl, _ = _baseline_inputs(spark, sf)
    return finalize(B.holdout_share(train_nz, B.holdout_pairs(bl)))


def q_holdout_pairs(spark, sf):
    return B.holdout_pairs(_baseline_inputs(spark, sf)[2])


def q_stratified_sample(spark, sf):
    df = weekly(spark, sf).withColumn("rate_bucket", FN.rate_bucket(S.RATE))
    return B.stratified_sample(df, 500, "rate_bucket", PK).select(*PK, S.RATE, "rate_bucket")


def q_uniform_sample(spark, sf):
    return B.sample_rows(weekly(spark, sf), 1000, PK).select(*PK, S.RATE)


def q_band_sample(spark, sf):
    return B.band_sample(weekly(spark, sf), 200, PK).select(*PK, S.RATE)


def q_exclude_constant_sites(spark, sf):
    df = B.exclude_constant_sites(weekly(spark, sf), values=(1.0, 0.0))
    return finalize(df.select(*PK, S.RATE))


def q_class_weight(spark, sf):
    train, _ = _train_test(spark, sf)
    return finalize(B.class_balance(train.withColumn("label", C.binary_label())))


def q_sample_weight(spark, sf):
    df = C.positive_rate(weekly(spark, sf))
    return finalize(df.select(*PK, S.RATE, FN.sample_weight(S.RATE).alias("sample_weight")))


def q_logit_target(spark, sf):
    df = C.positive_rate(weekly(spark, sf))
    return finalize(df.select(*PK, FN.clipped_logit(S.RATE, S.LOGIT_EPS_STAGE2).alias("logit_rate")))


def q_rate_bucket(spark, sf):
    df = weekly(spark, sf)
    return df.select(*PK, FN.rate_bucket(S.RATE).alias("rate_bucket"),
                     FN.rate_bucket(S.RATE, inclusive=True).alias("rate_bucket_incl"),
                     FN.rate_bucket_order(FN.rate_bucket(S.RATE)).alias("rate_bucket_ord"))


def q_volume_bucket(spark, sf):
    df = weekly(spark, sf)
    b = FN.volume_bucket("units_total")
    return df.select(*PK, b.alias("volume_bucket"), FN.volume_bucket_order(b).alias("volume_bucket_ord"))


def q_prediction_scope(spark, sf):
    return C.prediction_scope(weekly(spark, sf)).select(*PK)


def q_channel_share_target(spark, sf):
    df = C.positive_rate(weekly(spark, sf))
    shares = [(F.col(ch) / F.col(S.RATE)).alias(f"share_of_{ch}") for ch in S.RECOVERY_CHANNELS]
    logits = [FN.clipped_logit(F.col(ch) / F.col(S.RATE), S.LOGIT_EPS_STAGE3).alias(f"logit_share_of_{ch}")
              for ch in S.RECOVERY_CHANNELS]
    return finalize(df.select(*PK, *shares, *logits))


def q_share_baseline(spark, sf):
    train, _ = _train_test(spark, sf)
    return finalize(T.share_baselines_long(C.positive_rate(train), S.RECOVERY_CHANNELS))


def q_data_checks(spark, sf):
    return C.data_checks(weekly(spark, sf))


def q_row_counts(spark, sf):
    """The weekly table and its gridded form without gap rows hold equally many rows, with the columns that scoring needs."""
    df = C.require_columns(weekly(spark, sf), [*PK, S.RATE, "units_total", *S.RECOVERY_CHANNELS])
    return C.row_counts(weekly=df, gridded=C.drop_gap_rows(W.fill_week_grid(df)))


def q_marketplace_check(spark, sf):
    """Records whose marketplace differs from their country."""
    return C.marketplace_mismatches(raw(spark, sf)).groupBy("country", "marketplace_id").agg(F.count(F.lit(1)).alias("n"))


def q_regression_metrics(spark, sf):
    return finalize(M.regression_metrics(_filled_test(spark, sf), "site_gl_mean_rate", S.RATE))


def q_prob_mae(spark, sf):
    df = _filled_test(spark, sf).select(
        FN.clipped_logit("site_gl_mean_rate", S.LOGIT_EPS_STAGE2).alias("pred_logit"),
        FN.clipped_logit(S.RATE, S.LOGIT_EPS_STAGE2).alias("true_logit"))
    return finalize(M.prob_mae(df, "pred_logit", "true_logit"))


def q_roc_auc(spark, sf):
    return finalize(M.roc_auc(_scored_test(spark, sf), "p_nonzero", "label"))


def q_average_precision(spark, sf):
    return finalize(M.average_precision(_scored_test(spark, sf), "p_nonzero", "label"))


def q_brier(spark, sf):
    return finalize(M.brier(_scored_test(spark, sf), "p_nonzero", "label"))


def q_classification_metrics(spark, sf):
    return finalize(M.classification_metrics(_scored_test(spark, sf), "p_nonzero", "label"))


def q_threshold_sweep(spark, sf):
    return finalize(M.threshold_sweep(_scored_test(spark, sf), "p_nonzero", "label"))


def q_best_threshold(spark, sf):
    return finalize(M.best_threshold(M.threshold_sweep(_scored_test(spark, sf), "p_nonzero", "label")))


QUERIES = {
    "site_gl_baseline": q_site_gl_baseline,
    "baseline_priors": q_baseline_priors,
    "baseline_fill": q_baseline_fill,
    "min_support_shrinkage": q_min_support_shrinkage,
    "unseen_pair_share": q_unseen_pair_share,
    "holdout_pairs": q_holdout_pairs,
    "holdout_share": q_holdout_share,
    "stratified_sample": q_stratified_sample,
    "uniform_sample": q_uniform_sample,
    "band_sample": q_band_sample,
    "exclude_constant_sites": q_exclude_constant_sites,
    "class_weight": q_class_weight,
    "sample_weight": q_sample_weight,
    "logit_target": q_logit_target,
    "rate_bucket": q_rate_bucket,
    "volume_bucket": q_volume_bucket,
    "prediction_scope": q_prediction_scope,
    "channel_share_target": q_channel_share_target,
    "share_baseline": q_share_baseline,
    "data_checks": q_data_checks,
    "row_counts": q_row_counts,
    "marketplace_check": q_marketplace_check,
    "regression_metrics": q_regression_metrics,
    "prob_mae": q_prob_mae,
    "roc_auc": q_roc_auc,
    "average_precision": q_average_precision,
    "brier": q_brier,
    "classification_metrics": q_classification_metrics,
    "threshold_sweep": q_threshold_sweep,
    "best_threshold": q_best_threshold,
}

# ---------------------------------------------------------------------------
# Oracles
# ---------------------------------------------------------------------------

_PK = "hashed_fc, gl_product_group, year, month, week"
_TRAIN = ", ".join(map(str, TRAIN_YEARS))
_TEST = ", ".join(map(str, TEST_YEARS))

BASE_CTES = f""",
train AS (SELECT * FROM weekly WHERE year IN ({_TRAIN})),
test AS (SELECT * FROM weekly WHERE year IN ({_TEST})),
train_nz AS (SELECT * FROM train WHERE prob_recovered > 0),
test_nz AS (SELECT * FROM test WHERE prob_recovered > 0),
bl AS (SELECT hashed_fc, gl_product_group, (CAST(sum(CAST(round(prob_recovered * 1000000.0) AS BIGINT)) AS DOUBLE) / count(prob_recovered) / 1000000.0) AS site_gl_mean_rate,
              stddev_samp(prob_recovered) AS site_gl_std_rate, count(prob_recovered) AS site_gl_n_nonzero_weeks
       FROM train_nz GROUP BY hashed_fc, gl_product_group),
glp AS (SELECT gl_product_group, (CAST(sum(CAST(round(prob_recovered * 1000000.0) AS BIGINT)) AS DOUBLE) / count(prob_recovered) / 1000000.0) AS gl_mean_rate, stddev_samp(prob_recovered) AS gl_std_rate
        FROM train_nz GROUP BY gl_product_group),
sitep AS (SELECT hashed_fc, (CAST(sum(CAST(round(prob_recovered * 1000000.0) AS BIGINT)) AS DOUBLE) / count(prob_recovered) / 1000000.0) AS site_mean_rate, stddev_samp(prob_recovered) AS site_std_rate
          FROM train_nz GROUP BY hashed_fc),
gprior AS (SELECT (CAST(sum(CAST(round(prob_recovered * 1000000.0) AS BIGINT)) AS DOUBLE) / count(prob_recovered) / 1000000.0) AS global_mean_rate, stddev_samp(prob_recovered) AS global_std_rate FROM train_nz),
joined AS (SELECT t.*, b.site_gl_mean_rate AS m0, b.site_gl_std_rate AS s0, b.site_gl_n_nonzero_weeks AS n0
           FROM test_nz t LEFT JOIN bl b USING (hashed_fc, gl_product_group)),
filled AS (SELECT j.*, coalesce(m0, g.gl_mean_rate, s.site_mean_rate, gprior.global_mean_rate) AS site_gl_mean_rate,
                  coalesce(s0, g.gl_std_rate, s.site_std_rate, gprior.global_std_rate) AS site_gl_std_rate,
                  coalesce(n0, 0) AS site_gl_n_nonzero_weeks
           FROM joined j LEFT JOIN glp g USING (gl_product_group) LEFT JOIN sitep s USING (hashed_fc) CROSS JOIN gprior),
shrunk AS (SELECT f.* EXCLUDE (site_gl_mean_rate, site_gl_std_rate),
                  coalesce(CASE WHEN site_gl_n_nonzero_weeks >= {S.MIN_SUPPORT} THEN site_gl_mean_rate END,
                           g.gl_mean_rate, s.site_mean_rate, gprior.global_mean_rate) AS site_gl_mean_rate,
                  coalesce(CASE WHEN site_gl_n_nonzero_weeks >= {S.MIN_SUPPORT} THEN site_gl_std_rate END,
                           g.gl_std_rate, s.site_std_rate, gprior.global_std_rate) AS site_gl_std_rate
           FROM filled f LEFT JOIN glp g USING (gl_product_group) LEFT JOIN sitep s USING (hashed_fc) CROSS JOIN gprior),
pair_p AS (SELECT hashed_fc, gl_product_group, avg(CASE WHEN prob_recovered > 0 THEN 1.0 ELSE 0.0 END) AS pp
           FROM train GROUP BY hashed_fc, gl_product_group),
glob_p AS (SELECT avg(CASE WHEN prob_recovered > 0 THEN 1.0 ELSE 0.0 END) AS gp FROM train),
scored AS (SELECT {_PK}, prob_recovered, coalesce(pp, gp) AS p_nonzero,
                  CASE WHEN prob_recovered > 0 THEN 1 ELSE 0 END AS label
           FROM test LEFT JOIN pair_p USING (hashed_fc, gl_product_group) CROSS JOIN glob_p),
st AS (SELECT p_nonzero AS score, sum(label) AS n_pos, sum(1 - label) AS n_neg FROM scored GROUP BY p_nonzero),
stc AS (SELECT *, coalesce(sum(n_pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_below,
               coalesce(sum(n_neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
               sum(n_pos) OVER () AS P, sum(n_neg) OVER () AS N FROM st)
"""


def base(body: str) -> str:
    return O.with_ctes(BASE_CTES + body)


def _logit(x: str, eps: float) -> str:
    q = f"greatest({eps!r}, least({1 - eps!r}, {x}))"
    return f"ln({q} / (1 - {q}))"


def _bucket(x: str, op: str) -> str:
    return (f"CASE WHEN {x} = 0 THEN 'zero' WHEN {x} {op} 0.1 THEN '0-10%' WHEN {x} {op} 0.3 THEN '10-30%' "
            f"WHEN {x} {op} 0.6 THEN '30-60%' ELSE '>60%' END")


def _conf(t: float) -> str:
    return (f"SELECT CAST({round(t, 2)!r} AS DOUBLE) AS threshold, count_if(p_nonzero >= {t!r} AND label = 1) AS tp, "
            f"count_if(p_nonzero >= {t!r} AND label = 0) AS fp, count_if(p_nonzero < {t!r} AND label = 1) AS fn, "
            f"count_if(p_nonzero < {t!r} AND label = 0) AS tn FROM scored")


_RATES = """CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall"""
SWEEP_SQL = ("sweep0 AS (" + " UNION ALL ".join(_conf(t) for t in M.SWEEP_THRESHOLDS) + "), "
             f"sweep1 AS (SELECT threshold, tp, fp, fn, tn, {_RATES} FROM sweep0), "
             "sweep AS (SELECT threshold, precision, recall, CASE WHEN precision + recall > 0 "
             "THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM sweep1)")
_CH_SHARES = ", ".join(f"round({ch} / prob_recovered, 6) + 0.0 AS share_of_{ch}" for ch in S.RECOVERY_CHANNELS)
_CH_LOGITS = ", ".join(f"round({_logit(f'{ch} / prob_recovered', S.LOGIT_EPS_STAGE3)}, 6) + 0.0 AS logit_share_of_{ch}"
                       for ch in S.RECOVERY_CHANNELS)
_SHARE_LONG = " UNION ALL ".join(
    f"SELECT '{ch}' AS channel, hashed_fc, gl_product_group, {ch} / prob_recovered AS _share FROM train_nz"
    for ch in S.RECOVERY_CHANNELS)


def r6(*cols: str) -> str:
    return ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in cols)


def _h(*keys: str) -> str:
    """The sampling hash: 15 hex digits of the MD5 of seed and keys."""
    return f"CAST('0x' || substr(md5(concat_ws('|', '{S.SEED}', {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)})), 1, 15) AS BIGINT)"


_ROW_H = _h("hashed_fc", "gl_product_group", "year", "month", "week")

ORACLES = {
    "holdout_share": base(f", r AS (SELECT hashed_fc, gl_product_group, row_number() OVER (ORDER BY {_h('hashed_fc', 'gl_product_group')}, "
                          "hashed_fc, gl_product_group) AS rk, count(*) OVER () AS n FROM bl), "
                          f"o AS (SELECT hashed_fc, gl_product_group, 1 AS held FROM r WHERE rk <= floor(n * {S.HOLDOUT_FRACTION!r})) "
                          "SELECT count(*) AS n_rows, count(held) AS n_held_out, round(CAST(count(held) AS DOUBLE) / count(*), 6) + 0.0 AS held_out_share "
                          "FROM train_nz LEFT JOIN o USING (hashed_fc, gl_product_group)"),
    "holdout_pairs": base(f", r AS (SELECT hashed_fc, gl_product_group, row_number() OVER (ORDER BY {_h('hashed_fc', 'gl_product_group')}, "
                          "hashed_fc, gl_product_group) AS rk, count(*) OVER () AS n FROM bl) "
                          f"SELECT hashed_fc, gl_product_group FROM r WHERE rk <= floor(n * {S.HOLDOUT_FRACTION!r})"),
    "uniform_sample": base(f"SELECT {_PK}, prob_recovered FROM weekly ORDER BY {_ROW_H}, {_PK} LIMIT 1000"),
    "band_sample": base(f"SELECT {_PK}, prob_recovered FROM weekly WHERE prob_recovered >= 0.1 AND prob_recovered < 0.6 ORDER BY {_ROW_H}, {_PK} LIMIT 200"),
    "stratified_sample": base(
        f", b AS (SELECT {_PK}, prob_recovered, {_bucket('prob_recovered', '<')} AS rate_bucket FROM weekly), "
        f"r AS (SELECT *, row_number() OVER (PARTITION BY rate_bucket ORDER BY {_ROW_H}, {_PK}) AS rk FROM b) "
        f"SELECT {_PK}, prob_recovered, rate_bucket FROM r WHERE rk <= greatest(1, 500 // (SELECT count(DISTINCT rate_bucket) FROM b))"),
    "site_gl_baseline": base(f"SELECT hashed_fc, gl_product_group, {r6('site_gl_mean_rate', 'site_gl_std_rate')}, "
                             "site_gl_n_nonzero_weeks FROM bl"),
    "baseline_priors": base(
        "SELECT 'gl' AS level, CAST(gl_product_group AS VARCHAR) AS key, round(gl_mean_rate, 6) + 0.0 AS mean_rate, "
        "round(gl_std_rate, 6) + 0.0 AS std_rate FROM glp UNION ALL "
        "SELECT 'site', hashed_fc, round(site_mean_rate, 6) + 0.0, round(site_std_rate, 6) + 0.0 FROM sitep UNION ALL "
        "SELECT 'global', NULL, round(global_mean_rate, 6) + 0.0, round(global_std_rate, 6) + 0.0 FROM gprior"),
    "baseline_fill": base(f"SELECT {_PK}, {r6('site_gl_mean_rate', 'site_gl_std_rate')}, site_gl_n_nonzero_weeks FROM filled"),
    "min_support_shrinkage": base(
        f"SELECT {_PK}, {r6('site_gl_mean_rate', 'site_gl_std_rate')}, site_gl_n_nonzero_weeks FROM shrunk"),
    "unseen_pair_share": base("SELECT count(*) AS n_rows, count_if(m0 IS NULL) AS n_unseen, "
                              "round(count_if(m0 IS NULL) / count(*), 6) + 0.0 AS unseen_share FROM joined"),
    "exclude_constant_sites": base(
        "SELECT hashed_fc, gl_product_group, year, month, week, prob_recovered FROM weekly WHERE hashed_fc NOT IN ("
        "SELECT hashed_fc FROM weekly GROUP BY hashed_fc HAVING (avg(prob_recovered) = 1 AND stddev_samp(prob_recovered) = 0) "
        "OR (avg(prob_recovered) = 0 AND stddev_samp(prob_recovered) = 0))"),
    "class_weight": base("SELECT count_if(prob_recovered <= 0 OR prob_recovered IS NULL) AS n_neg, "
                         "count_if(prob_recovered > 0) AS n_pos, "
                         "round(CASE WHEN count_if(prob_recovered > 0) > 0 THEN count_if(prob_recovered <= 0 OR prob_recovered IS NULL) "
                         "/ count_if(prob_recovered > 0) END, 6) + 0.0 AS scale_pos_weight FROM train"),
    "sample_weight": base(f"SELECT {_PK}, prob_recovered, CASE WHEN prob_recovered >= 0.1 AND prob_recovered < 0.3 THEN 3.0 "
                          "WHEN prob_recovered >= 0.3 AND prob_recovered < 0.6 THEN 8.0 WHEN prob_recovered >= 0.6 THEN 2.0 "
                          "ELSE 1.0 END AS sample_weight FROM weekly WHERE prob_recovered > 0"),
    "logit_target": base(f"SELECT {_PK}, round({_logit('prob_recovered', S.LOGIT_EPS_STAGE2)}, 6) + 0.0 AS logit_rate "
                         "FROM weekly WHERE prob_recovered > 0"),
    "rate_bucket": base(f"SELECT {_PK}, {_bucket('prob_recovered', '<')} AS rate_bucket, "
                        f"{_bucket('prob_recovered', '<=')} AS rate_bucket_incl, "
                        f"CASE {_bucket('prob_recovered', '<')} WHEN 'zero' THEN 0 WHEN '0-10%' THEN 1 WHEN '10-30%' THEN 2 "
                        "WHEN '30-60%' THEN 3 ELSE 4 END AS rate_bucket_ord FROM weekly"),
    "volume_bucket": base(
        f"SELECT {_PK}, CASE WHEN units_total < 10 THEN '<10' WHEN units_total < 100 THEN '10-100' "
        "WHEN units_total < 1000 THEN '100-1k' ELSE '>1k' END AS volume_bucket, "
        "CASE WHEN units_total < 10 THEN 0 WHEN units_total < 100 THEN 1 WHEN units_total < 1000 THEN 2 ELSE 3 END "
        "AS volume_bucket_ord FROM weekly"),
    "prediction_scope": base(f"SELECT {_PK} FROM weekly WHERE year = (SELECT max(year) FROM weekly)"),
    "channel_share_target": base(f"SELECT {_PK}, {_CH_SHARES}, {_CH_LOGITS} FROM weekly WHERE prob_recovered > 0"),
    "share_baseline": base(
        f", long AS ({_SHARE_LONG}) SELECT channel, hashed_fc, gl_product_group, round(avg(_share), 6) + 0.0 AS baseline_share_mean, "
        "round(stddev_samp(_share), 6) + 0.0 AS baseline_share_std, count(_share) AS baseline_share_count "
        "FROM long GROUP BY channel, hashed_fc, gl_product_group"),
    "row_counts": O.with_ctes(O.GRID_CTES + ", a AS (SELECT 'weekly' AS frame, count(*) AS n_rows FROM weekly UNION ALL "
                              "SELECT 'gridded', count(*) FROM g WHERE week IS NOT NULL) "
                              "SELECT frame, n_rows, (SELECT min(n_rows) = max(n_rows) FROM a) AS equal FROM a"),
    "marketplace_check": O.with_ctes("SELECT country, marketplace_id, count(*) AS n FROM raw WHERE country <> marketplace_id GROUP BY ALL", "raw"),
    "data_checks": base("SELECT count(*) AS n_rows, count_if(units_total <= 0) AS n_units_not_positive, "
                        "count_if(prob_recovered < 0 OR prob_recovered > 1) AS n_rate_out_of_range, "
                        "count_if(prob_recovered IS NULL) AS n_rate_null FROM weekly"),
    "regression_metrics": base(
        "SELECT count(*) AS n, round(avg(abs(site_gl_mean_rate - prob_recovered)), 6) + 0.0 AS mae, "
        "round(sqrt(avg((site_gl_mean_rate - prob_recovered) ^ 2)), 6) + 0.0 AS rmse, "
        "round(1 - sum((site_gl_mean_rate - prob_recovered) ^ 2) / sum((prob_recovered - (SELECT avg(prob_recovered) FROM filled)) ^ 2), 6) + 0.0 AS r2 "
        "FROM filled"),
    "prob_mae": base(
        f"SELECT round(avg(abs(1 / (1 + exp(-({_logit('site_gl_mean_rate', S.LOGIT_EPS_STAGE2)}))) "
        f"- 1 / (1 + exp(-({_logit('prob_recovered', S.LOGIT_EPS_STAGE2)}))))), 6) + 0.0 AS prob_mae FROM filled"),
    "roc_auc": base("SELECT round(sum(n_pos * (neg_below + 0.5 * n_neg)) / (max(P) * max(N)), 6) + 0.0 AS roc_auc FROM stc"),
    "average_precision": base(
        "SELECT round(sum(n_pos / P * (P - pos_below) / ((P - pos_below) + (N - neg_below))), 6) + 0.0 AS average_precision FROM stc"),
    "brier": base("SELECT round(avg((p_nonzero - label) ^ 2), 6) + 0.0 AS brier FROM scored"),
    "classification_metrics": base(
        f", c AS ({_conf(0.5)}), r AS (SELECT *, {_RATES} FROM c) "
        "SELECT CAST(0.5 AS DOUBLE) AS threshold, round((tp + tn) / (tp + fp + fn + tn), 6) + 0.0 AS accuracy, "
        "round(precision, 6) + 0.0 AS precision, round(recall, 6) + 0.0 AS recall, "
        "round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, 6) + 0.0 AS f1 FROM r"),
    "threshold_sweep": base(f", {SWEEP_SQL} SELECT threshold, {r6('precision', 'recall', 'f1')} FROM sweep"),
    "best_threshold": base(
        f", {SWEEP_SQL} SELECT arg_max(threshold, (f1, -threshold)) AS best_threshold, round(max(f1), 6) + 0.0 AS best_f1 FROM sweep"),
}
