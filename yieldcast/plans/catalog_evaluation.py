"""Registered queries: what is worked out from scores and attributions, on arrays that SQL can repeat.

The test year's weekly rows get margins and attribution values by whole-number arithmetic of their own columns; every rule behind
them (C4, C8-C11, A30-A32) is the library's own and has its twin in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from yieldcast import schema as S
from yieldcast.functions.scalar import rate_bucket
from yieldcast.models import attribution as AT
from yieldcast.models import score as SC
from yieldcast.operators import clean as C
from yieldcast.operators import report as R
from yieldcast.plans import oracles as O
from yieldcast.plans.common import TEST_YEARS, finalize, weekly

KEYS = SC.ROW_KEYS
BASE_VALUE = -0.5
# feature name -> its value in a row
FEATURES = {
    "units_total": "units_total", "cogs_total": "cogs_total", "share_food": "share_food", "prob_recovered_lag_1w": "prob_recovered",
    "prob_recovered_rolling_4w": "CASE WHEN week % 5 = 0 THEN NULL ELSE prob_recovered END", "avg_cogs_per_unit": "avg_cogs_per_unit",
    "site_units_share_week": "site_units_share_week", "week": "week",
}
NAMES = list(FEATURES)


def _shap(i: int) -> str:
    return f"CAST((units_total * {i + 3} + week * {7 + i} + gl_product_group * 5) % 41 - 20 AS DOUBLE) / CAST(50 AS DOUBLE)"


def _raw(i: int) -> str:
    return f"CAST((units_total * {i + 2} + week * 3) % 61 - 30 AS DOUBLE) / CAST(10 AS DOUBLE)"


P_NONZERO = "CAST((units_total * 11 + week) % 100 AS DOUBLE) / CAST(100 AS DOUBLE)"


def _test(spark, sf):
    return C.split_by_years(weekly(spark, sf), [], TEST_YEARS)[1]


def _explained(spark, sf):
    df = _test(spark, sf)
    attr = df.select(*KEYS, "units_total", S.RATE, F.expr(P_NONZERO).alias("p_nonzero"), F.array(*[F.expr(_shap(i)) for i in range(len(NAMES))]).alias("shap"),
                     F.array(*[F.expr(v).cast("double") for v in FEATURES.values()]).alias("feature_values"), F.lit(BASE_VALUE).alias("base_value"))
    out = AT.decompose(attr.where("p_nonzero > 0.5"), NAMES).withColumn("combined_rate", F.col("p_nonzero") * F.col("full_rate"))
    return out.withColumn("abs_err", F.abs(F.col("combined_rate") - F.col(S.RATE)))


def q_normalise_channels(spark, sf):
    raw = _test(spark, sf).select(*KEYS, S.RATE, *[F.expr(_raw(i)).alias(f"raw_{ch}") for i, ch in enumerate(S.RECOVERY_CHANNELS)])
    return finalize(SC.normalise_channels(raw, S.RECOVERY_CHANNELS, S.RATE))


def q_decomposition_rule(spark, sf):
    return finalize(_explained(spark, sf).select(*KEYS, "shap_dev", "shap_base", "baseline_rate", "full_rate", "deviation_contribution"))


def q_drivers_rule(spark, sf):
    return finalize(AT.top_drivers(_explained(spark, sf), NAMES, KEYS, 3))


def q_extremes_rule(spark, sf):
    return finalize(AT.extreme_rows(_explained(spark, sf), KEYS, 10))


def q_mean_abs_rule(spark, sf):
    return finalize(AT.mean_abs_attribution(_explained(spark, sf), NAMES, 5))


def _bucketed(spark, sf):
    return _explained(spark, sf).withColumn("rate_bucket", rate_bucket(S.RATE))


def q_attribution_by_bucket(spark, sf):
    return finalize(R.bucket_means(_bucketed(spark, sf), "baseline_rate", "deviation_contribution"))


def q_attribution_quantiles(spark, sf):
    return finalize(R.deviation_quantiles(_explained(spark, sf), "deviation_contribution"))


def q_attribution_by_site(spark, sf):
    return finalize(R.site_deviation(_explained(spark, sf), 5, "baseline_rate", "deviation_contribution"))


def q_largest_attribution_site(spark, sf):
    return finalize(R.largest_deviation_site(_explained(spark, sf), "deviation_contribution"))


def q_unrounded_error(spark, sf):
    """A16 on errors that are not rounded: medians by distributed selection."""
    return finalize(R.stratified_error(_explained(spark, sf).withColumn("month_type", F.col("month") % 3), "month_type", rounded=False))


QUERIES = {
    "normalise_channels": q_normalise_channels,
    "decomposition_rule": q_decomposition_rule,
    "drivers_rule": q_drivers_rule,
    "extremes_rule": q_extremes_rule,
    "mean_abs_rule": q_mean_abs_rule,
    "attribution_by_bucket": q_attribution_by_bucket,
    "attribution_quantiles": q_attribution_quantiles,
    "attribution_by_site": q_attribution_by_site,
    "largest_attribution_site": q_largest_attribution_site,
    "unrounded_error": q_unrounded_error,
}

# ---------------------------------------------------------------------------
# Oracles
# ---------------------------------------------------------------------------

_K = ", ".join(KEYS)
_DEV = set(AT.deviation_features(NAMES))
_YEARS = ", ".join(map(str, TEST_YEARS))


def _sum(dev: bool) -> str:
    return " + ".join(["0.0::DOUBLE", *[f"s{i}" for i, n in enumerate(NAMES) if (n in _DEV) == dev]])


def _sig(x: str) -> str:
    return f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-({x}))))"


EXPLAINED = f""",
x0 AS (SELECT {_K}, units_total, prob_recovered, {P_NONZERO} AS p_nonzero,
              {', '.join(f'{_shap(i)} AS s{i}' for i in range(len(NAMES)))}, {', '.join(f'CAST({v} AS DOUBLE) AS v{i}' for i, v in enumerate(FEATURES.values()))}
       FROM weekly WHERE year IN ({_YEARS})),
x1 AS (SELECT *, {_sum(True)} AS shap_dev, {_sum(False)} AS shap_base FROM x0 WHERE p_nonzero > 0.5),
x2 AS (SELECT *, {_sig(f'{BASE_VALUE}::DOUBLE + shap_base')} AS baseline_rate, {_sig(f'{BASE_VALUE}::DOUBLE + shap_base + shap_dev')} AS full_rate FROM x1),
x3 AS (SELECT *, full_rate - baseline_rate AS deviation_contribution, p_nonzero * full_rate AS combined_rate FROM x2),
x AS (SELECT *, abs(combined_rate - prob_recovered) AS abs_err FROM x3)
"""


def _x(body: str) -> str:
    return O.with_ctes(EXPLAINED + body)


def _r(*cols: str) -> str:
    return ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in cols)


def _text(name: str, v: str) -> str:
    if name.startswith("share_") or "prob_recovered" in name:
        shown = f"format('{{:.1f}}%', {v} * 100)"
    elif any(k in name for k in ("units_total", "cogs_total", "weight_total")):
        shown = f"format('{{:,}}', CAST(round_even({v}, 0) AS BIGINT))"
    else:
        shown = f"format('{{:.3f}}', {v})"
    return f"CASE WHEN {v} IS NULL THEN 'n/a' ELSE {shown} END"


def _drivers() -> str:
    rows = []
    for i, n in enumerate(NAMES):
        if n not in _DEV:
            continue
        label, ref, words = AT.driver_text(n, set(NAMES))
        then = f"v{NAMES.index(ref)}" if ref else "CAST(NULL AS DOUBLE)"
        detail = (f"'current = ' || {_text(n, f'v{i}')}" if ref is None else f"{_text(n, f'v{i}')} || ' vs ' || {_text(ref, then)} || ' ({words})'")
        quoted = [f"'{t}'" if t else "CAST(NULL AS VARCHAR)" for t in (n, label, ref, words)]
        rows.append(f"SELECT {_K}, {i} AS i, {quoted[0]} AS feature, {quoted[1]} AS label, v{i} AS value, {quoted[2]} AS reference, {quoted[3]} AS reference_label, "
                    f"{then} AS reference_value, {detail} AS detail, s{i} * CASE WHEN abs(shap_dev) > 1e-9 THEN deviation_contribution / shap_dev ELSE 0.0 END AS contribution FROM x")
    return (f", d AS ({' UNION ALL '.join(rows)}), r AS (SELECT *, row_number() OVER (PARTITION BY {_K} ORDER BY -abs(contribution), i) AS rank FROM d) "
            f"SELECT {_K}, CAST(rank AS INTEGER) AS rank, feature, label, {_r('value')}, reference, reference_label, {_r('reference_value')}, detail, {_r('contribution')}, "
            "CASE WHEN contribution >= 0 THEN 'up' ELSE 'down' END AS direction FROM r WHERE rank <= 3")


_EXTREME = f"{_K}, units_total, {_r('prob_recovered', 'p_nonzero', 'baseline_rate', 'full_rate', 'deviation_contribution', 'combined_rate', 'abs_err')}"
_CH = S.RECOVERY_CHANNELS
_TOTAL = " + ".join(["0.0::DOUBLE", *[_sig(_raw(i)) for i in range(len(_CH))]])

ORACLES = {
    "normalise_channels": O.with_ctes(
        f"SELECT {_K}, round(prob_recovered, 6) + 0.0 AS prob_recovered, " + ", ".join(
            f"round({_sig(_raw(i))} / ({_TOTAL}) * prob_recovered, 6) + 0.0 AS pred_{ch}" for i, ch in enumerate(_CH)) + f" FROM weekly WHERE year IN ({_YEARS})"),
    "decomposition_rule": _x(f"SELECT {_K}, {_r('shap_dev', 'shap_base', 'baseline_rate', 'full_rate', 'deviation_contribution')} FROM x"),
    "drivers_rule": _x(_drivers()),
    "extremes_rule": _x(f"SELECT {_EXTREME}, 'top' AS side FROM (SELECT * FROM x ORDER BY x.deviation_contribution DESC, {_K} LIMIT 10) UNION ALL "
                        f"SELECT {_EXTREME}, 'bottom' FROM (SELECT * FROM x ORDER BY x.deviation_contribution, {_K} LIMIT 10)"),
    "mean_abs_rule": _x(f", m AS ({' UNION ALL '.join(f'''SELECT '{n}' AS feature, avg(abs(s{i})) AS m FROM x''' for i, n in enumerate(NAMES))}) "
                        "SELECT feature, round(m, 6) + 0.0 AS mean_abs_shap FROM m ORDER BY m DESC, feature LIMIT 5"),
    "attribution_by_bucket": _x(
        "SELECT CASE WHEN prob_recovered = 0 THEN 'zero' WHEN prob_recovered < 0.1 THEN '0-10%' WHEN prob_recovered < 0.3 THEN '10-30%' "
        "WHEN prob_recovered < 0.6 THEN '30-60%' ELSE '>60%' END AS rate_bucket, count(*) AS n, round(avg(baseline_rate), 6) + 0.0 AS mean_baseline, "
        "round(avg(deviation_contribution), 6) + 0.0 AS mean_deviation, round(avg(combined_rate), 6) + 0.0 AS mean_full, "
        "round(avg(prob_recovered), 6) + 0.0 AS mean_actual FROM x GROUP BY 1"),
    "attribution_quantiles": _x(
        "SELECT round(quantile_cont(deviation_contribution, 0.05), 6) + 0.0 AS q05, round(quantile_cont(deviation_contribution, 0.95), 6) + 0.0 AS q95, "
        "round(avg(abs(deviation_contribution)), 6) + 0.0 AS mean_abs, round(avg(deviation_contribution), 6) + 0.0 AS mean_signed FROM x"),
    "attribution_by_site": _x(
        "SELECT hashed_fc, round(avg(combined_rate), 6) + 0.0 AS mean_rate, round(avg(baseline_rate), 6) + 0.0 AS mean_baseline, "
        "round(avg(deviation_contribution), 6) + 0.0 AS mean_deviation FROM x GROUP BY hashed_fc ORDER BY avg(combined_rate) DESC, hashed_fc LIMIT 5"),
    "largest_attribution_site": _x("SELECT hashed_fc, round(avg(deviation_contribution), 6) + 0.0 AS mean_deviation FROM x GROUP BY hashed_fc "
                                   "ORDER BY avg(deviation_contribution) DESC, hashed_fc LIMIT 1"),
    "unrounded_error": _x("SELECT CAST(month % 3 AS INTEGER) AS month_type, round(round(avg(abs_err), 4), 6) + 0.0 AS mae, round(round(median(abs_err), 4), 6) + 0.0 AS median_ae, "
                          "CAST(sum(units_total) AS BIGINT) AS units, count(*) AS n FROM x GROUP BY 1"),
}
