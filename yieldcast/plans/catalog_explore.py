"""Registered queries: exploration and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from yieldcast import schema as S
from yieldcast.functions.scalar import fmt_value, round_half_away, short_label
from yieldcast.operators import explore as X
from yieldcast.operators import report as R
from yieldcast.operators.aggregate import conditional_sum, conditional_sums
from yieldcast.plans import oracles as O
from yieldcast.plans.baseline_predictor import baseline_predictions
from yieldcast.plans.catalog_baselines import BASE_CTES, PK
from yieldcast.plans.common import TEST_YEARS, TRAIN_YEARS, cleaned, finalize, weekly

CORR_COLS = ["prob_recovered", "share_hazmat", "share_FBA", "share_food", "share_non_food", "share_pet_food", "share_RETAIL",
             "avg_cogs_per_unit", "avg_weight_per_unit", "cogs_per_unit_weight", "site_units_share_week"]
CATEGORIES = ["site_type", "site_category", "country"]
_OUTCOME_TYPES = {k: v for k, v in S.RECOVERY_TYPES.items() if k != S.SALES} | {S.THEFT: "bintool_theft"}


def _outcomes(spark, sf):
    """Rows per aggregation key with units per outcome, Bintool Theft included."""
    return cleaned(spark, sf).groupBy(*S.AGG_KEYS).agg(
        F.sum("units").alias("units_total"), conditional_sum("recovery_type", S.SALES, "units", "units_recovered", op="ne"),
        *conditional_sums("recovery_type", _OUTCOME_TYPES, "units", "units"))


def _quartiles(spark, sf):
    tables = [X.category_quartiles(weekly(spark, sf), c) for c in CATEGORIES]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


def _display(spark, sf):
    """the shortlist's pairs as shown in tables: short site, GL as text, rate and units formatted."""
    df = X.shortlist(weekly(spark, sf))
    return df.select(S.SITE, S.GL, short_label(S.SITE, 6).alias("site"), F.concat(F.lit("GL "), F.col(S.GL).cast("string")).alias("gl"),
                     fmt_value(F.lit("prob_recovered"), F.round("vw_rate", 6)).alias("rate"), fmt_value(F.lit("units_total"), "units").alias("units_text"))


def _channel_trends(spark, sf, key):
    """A19 per channel, on stand-in predictions: the baseline's rate split by each row's own units."""
    df = weekly(spark, sf)
    split = [round_half_away(F.col("combined_rate") * F.least(F.lit(1.0), F.coalesce(F.col(ch), F.lit(0.0)))).alias(f"pred_{ch}") for ch in S.RECOVERY_CHANNELS]
    pred = _pred(spark, sf).join(df.select(*PK, *S.RECOVERY_CHANNELS), PK)
    return R.channel_trends(pred.select("*", *split), key, S.RECOVERY_CHANNELS, 3)


def _pred(spark, sf):
    return baseline_predictions(weekly(spark, sf), TRAIN_YEARS, TEST_YEARS)


QUERIES = {
    "vw_rate_by_site": lambda sp, sf: finalize(X.weighted_rate(weekly(sp, sf), [S.SITE])),
    "vw_rate_by_gl": lambda sp, sf: finalize(X.weighted_rate(weekly(sp, sf), [S.GL], min_units=1000)),
    "vw_rate_site_gl": lambda sp, sf: finalize(X.weighted_rate(weekly(sp, sf), [S.SITE, S.GL], min_units=1000)),
    "vw_rate_by_year": lambda sp, sf: finalize(X.yearly_totals(weekly(sp, sf))),
    "monthly_pivot": lambda sp, sf: finalize(X.monthly_pivot(weekly(sp, sf))),
    "quarterly_pivot": lambda sp, sf: finalize(X.quarterly_pivot(weekly(sp, sf))),
    "monthly_pivot_type": lambda sp, sf: finalize(X.monthly_pivot(weekly(sp, sf), "site_type")),
    "monthly_pivot_country": lambda sp, sf: finalize(X.monthly_pivot(weekly(sp, sf), "country")),
    "quarterly_pivot_type": lambda sp, sf: finalize(X.quarterly_pivot(weekly(sp, sf), "site_type")),
    "quarterly_pivot_top_gl": lambda sp, sf: finalize(X.quarterly_pivot(X.restrict_to_top(weekly(sp, sf), S.GL, 20), S.GL)),
    "overall_rates": lambda sp, sf: finalize(X.overall_rates(weekly(sp, sf))),
    "display_keys": lambda sp, sf: _display(sp, sf),
    "week_profile": lambda sp, sf: finalize(X.week_profile(weekly(sp, sf))),
    "year_week_profile": lambda sp, sf: finalize(X.year_week_profile(weekly(sp, sf))),
    "monthly_profile": lambda sp, sf: finalize(X.monthly_profile(weekly(sp, sf))),
    "top_monthly_profile": lambda sp, sf: finalize(X.monthly_profile(weekly(sp, sf), S.SITE, 5)),
    "top_monthly_profile_gl": lambda sp, sf: finalize(X.monthly_profile(weekly(sp, sf), S.GL, 5)),
    "outcome_mix": lambda sp, sf: finalize(X.outcome_mix(_outcomes(sp, sf), S.SITE)),
    "outcome_mix_gl": lambda sp, sf: finalize(X.outcome_mix(_outcomes(sp, sf), S.GL)),
    "site_summary": lambda sp, sf: finalize(X.site_summary(weekly(sp, sf))),
    "gl_summary": lambda sp, sf: finalize(X.gl_summary(weekly(sp, sf))),
    "pair_summary": lambda sp, sf: finalize(X.pair_summary(weekly(sp, sf))),
    "category_quartiles": lambda sp, sf: finalize(_quartiles(sp, sf)),
    "histogram": lambda sp, sf: finalize(X.histogram(weekly(sp, sf), S.RATE, 0.0, 1.0, 20)),
    "correlation": lambda sp, sf: finalize(X.correlation(weekly(sp, sf), CORR_COLS)),
    "priority_quadrants": lambda sp, sf: finalize(X.priority_quadrants(weekly(sp, sf))),
    "shortlist": lambda sp, sf: finalize(X.shortlist(weekly(sp, sf), 15)),
    "value_counts": lambda sp, sf: X.value_counts(cleaned(sp, sf), "recovery_type"),
    "column_summary": lambda sp, sf: X.column_summary(cleaned(sp, sf), ["hashed_fc", "gl_product_group", "year", "week"]),
    "bucket_counts": lambda sp, sf: X.bucket_counts(weekly(sp, sf)),
    "baseline_predictions": lambda sp, sf: finalize(_pred(sp, sf)),
    "overall_mae": lambda sp, sf: finalize(R.overall_mae(_pred(sp, sf))),
    "mae_by_bucket": lambda sp, sf: finalize(R.mae_by_bucket(_pred(sp, sf), "rate_bucket")),
    "mae_by_volume": lambda sp, sf: finalize(R.mae_by_bucket(_pred(sp, sf), "volume_bucket")),
    "stratified_error": lambda sp, sf: finalize(R.stratified_error(_pred(sp, sf), "site_type")),
    "top_groups": lambda sp, sf: finalize(R.top_groups(_pred(sp, sf), S.SITE, 10)),
    "always_full_groups": lambda sp, sf: R.always_full_groups(_pred(sp, sf), S.SITE),
    "weekly_trend": lambda sp, sf: finalize(R.weekly_trend(_pred(sp, sf), S.SITE, 5)),
    "channel_trend": lambda sp, sf: finalize(_channel_trends(sp, sf, S.SITE)),
    "channel_trend_gl": lambda sp, sf: finalize(_channel_trends(sp, sf, S.GL)),
    "weekly_trend_gl": lambda sp, sf: finalize(R.weekly_trend(_pred(sp, sf), S.GL, 5)),
    "monthly_actual_vs_pred": lambda sp, sf: finalize(R.monthly_actual_vs_pred(_pred(sp, sf), S.SITE)),
    "weighted_pred_rate": lambda sp, sf: finalize(R.weighted_pred_rate(_pred(sp, sf), [S.GL], min_units=100, n=3)),
    "bucket_means": lambda sp, sf: finalize(R.bucket_means(_pred(sp, sf))),
    "deviation_quantiles": lambda sp, sf: finalize(R.deviation_quantiles(_pred(sp, sf))),
    "site_deviation": lambda sp, sf: finalize(R.site_deviation(_pred(sp, sf))),
    "largest_deviation_site": lambda sp, sf: finalize(R.largest_deviation_site(_pred(sp, sf))),
}

# ---------------------------------------------------------------------------
# Oracles
# ---------------------------------------------------------------------------

PRED_CTES = BASE_CTES + """,
pred0 AS (SELECT t.hashed_fc, t.gl_product_group, t.year, t.month, t.week, t.units_total, t.site_type,
                 t.prob_recovered, coalesce(pp, gp) AS p,
                 coalesce(b.site_gl_mean_rate, g.gl_mean_rate, s.site_mean_rate, gprior.global_mean_rate) AS e
          FROM test t LEFT JOIN pair_p USING (hashed_fc, gl_product_group) CROSS JOIN glob_p
          LEFT JOIN bl b USING (hashed_fc, gl_product_group) LEFT JOIN glp g USING (gl_product_group)
          LEFT JOIN sitep s USING (hashed_fc) CROSS JOIN gprior),
pred AS (SELECT hashed_fc, gl_product_group, year, month, week, units_total, site_type, prob_recovered,
                round(p, 6) AS p_nonzero, round(e, 6) AS e_rate, round(p * e, 6) AS combined_rate,
                round(abs(p * e - prob_recovered), 6) AS abs_err, round(e, 6) AS baseline_rate,
                round(p * e - e, 6) AS deviation,
                CASE WHEN prob_recovered = 0 THEN 'zero' WHEN prob_recovered < 0.1 THEN '0-10%'
                     WHEN prob_recovered < 0.3 THEN '10-30%' WHEN prob_recovered < 0.6 THEN '30-60%' ELSE '>60%' END AS rate_bucket,
                CASE WHEN units_total < 10 THEN '<10' WHEN units_total < 100 THEN '10-100'
                     WHEN units_total < 1000 THEN '100-1k' ELSE '>1k' END AS volume_bucket
         FROM pred0)
"""


def P(body: str) -> str:
    return O.with_ctes(PRED_CTES + body)


def W(body: str) -> str:
    return O.with_ctes(body)


def r6(*cols: str) -> str:
    return ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in cols)


def _wr(keys: str, having: str = "") -> str:
    return (f"SELECT {keys}, CAST(sum(units_total) AS BIGINT) AS units_total, CAST(sum(units_recovered) AS BIGINT) AS units_recovered, "
            f"round(CASE WHEN sum(units_total) <> 0 THEN sum(units_recovered) / sum(units_total) END, 6) + 0.0 AS recovery_rate "
            f"FROM weekly GROUP BY {keys} {having}")


_RATE = "CASE WHEN sum(units_total) <> 0 THEN sum(units_recovered) / sum(units_total) END"
_MONTHS = ", ".join(f"round(coalesce(max(CASE WHEN month = {m} THEN r END), 0.0), 6) + 0.0 AS m{m:02d}" for m in range(1, 13))
_QS = ", ".join(f"round(coalesce(max(CASE WHEN q = 'Q{i}' THEN r END), 0.0), 6) + 0.0 AS Q{i}" for i in range(1, 5))
def _top(key: str, n: int, src: str = "weekly") -> str:
    return (f"(SELECT {key} FROM {src} GROUP BY {key} HAVING sum(units_total) >= 1000 "
            f"ORDER BY CAST(sum(units_recovered) AS DOUBLE) / sum(units_total) DESC, {key} LIMIT {n})")


_OUT_CTE = ", outc AS (SELECT hashed_fc, year, month, week, gl_product_group, sum(units) AS units_total, " \
    "sum(CASE WHEN recovery_type <> 'Sales' THEN units ELSE 0 END) AS units_recovered, " + ", ".join(
        f"sum(CASE WHEN recovery_type = '{v}' THEN units ELSE 0 END) AS u_{c}" for v, c in _OUTCOME_TYPES.items()) \
    + " FROM clean GROUP BY ALL) "
_OUT_MEANS = ", ".join(
    f"round(avg(CASE WHEN units_recovered > 0 THEN u_{o} / units_recovered ELSE 0.0 END), 6) + 0.0 AS recov_share_{o}" for o in X.OUTCOMES)


def _mix(key: str) -> str:
    return O.with_ctes(f"{_OUT_CTE} SELECT {key}, CAST(sum(units_recovered) AS BIGINT) AS units_recovered, {_OUT_MEANS} FROM outc "
                       f"WHERE {key} IN {_top(key, 20, 'outc')} GROUP BY {key}", "clean")


def _summary(keys: str, floor: int, means: dict[str, str], more: str = "") -> str:
    cols = ", ".join(f"round(avg({c}), 6) + 0.0 AS {name}" for c, name in means.items())
    return (f"SELECT {keys}, CAST(sum(units_total) AS BIGINT) AS units, CAST(sum(units_recovered) AS BIGINT) AS units_recovered, {cols}, "
            f"round({_RATE}, 6) + 0.0 AS vw_rate{more} FROM weekly GROUP BY {keys} HAVING sum(units_total) >= {floor}")


_PAIRS = _summary("hashed_fc, gl_product_group, site_type, country", 500, X.SUMMARY_MEANS)


def _quartile_sql(c: str) -> str:
    return (f"SELECT '{c}' AS category, {c} AS value, count(hashed_fc) AS n, round(quantile_cont(r, 0.25), 6) + 0.0 AS q25, "
            f"round(quantile_cont(r, 0.5), 6) + 0.0 AS median, round(quantile_cont(r, 0.75), 6) + 0.0 AS q75 FROM sites GROUP BY {c}")


def _corr_sql() -> str:
    parts = []
    cols = CORR_COLS
    for i, a in enumerate(cols):
        for b in cols[i:]:
            expr = f"round(corr(CASE WHEN NOT isnan({a}) THEN {a} END, CASE WHEN NOT isnan({b}) THEN {b} END), 6) + 0.0"
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {expr} AS corr FROM weekly")
            if a != b:
                parts.append(f"SELECT '{b}', '{a}', {expr} FROM weekly")
    return " UNION ALL ".join(parts)


_ALWAYS_FULL = "SELECT hashed_fc FROM pred GROUP BY hashed_fc HAVING bool_and(coalesce(prob_recovered = 1.0, false))"


def _mean(c: str) -> str:
    """Mean of 6-decimal values in fixed point (the same in any order of summation)."""
    return f"(CAST(sum(CAST(round({c} * 1000000.0) AS BIGINT)) AS DOUBLE) / count({c}) / 1000000.0)"


def _trend(key: str) -> str:
    return P(f", base AS (SELECT * FROM pred WHERE hashed_fc NOT IN ({_ALWAYS_FULL}) "
             f"AND gl_product_group NOT IN ({_ALWAYS_FULL.replace('hashed_fc', 'gl_product_group')})), "
             f"top AS (SELECT {key} FROM base GROUP BY {key} ORDER BY avg(combined_rate) DESC, {key} LIMIT 5) "
             f"SELECT {key}, week, round({_mean('combined_rate')}, 6) + 0.0 AS mean_pred_rate, round({_mean('prob_recovered')}, 6) + 0.0 AS mean_actual_rate "
             f"FROM base WHERE {key} IN (SELECT {key} FROM top) GROUP BY {key}, week")



def _quarters(key: str, src: str) -> str:
    return (f", c AS (SELECT {key}, 'Q' || CAST(CAST(ceil(month / 3.0) AS INTEGER) AS VARCHAR) AS q, {_RATE} AS r FROM {src} GROUP BY {key}, q) "
            f"SELECT {key}, {_QS} FROM c GROUP BY {key}")


def _channel_trend_sql(key: str) -> str:
    each = " UNION ALL ".join(f"SELECT '{ch}' AS channel, {key}, week, round(combined_rate * least(1.0, coalesce({ch}, 0.0)), 6) AS pred, {ch} AS actual FROM base"
                              for ch in S.RECOVERY_CHANNELS)
    full = _ALWAYS_FULL.replace("hashed_fc", "gl_product_group")
    return P(f", base AS (SELECT pred.*, {', '.join('w.' + ch for ch in S.RECOVERY_CHANNELS)} FROM pred JOIN weekly w USING (hashed_fc, gl_product_group, year, month, week) "
             f"WHERE hashed_fc NOT IN ({_ALWAYS_FULL}) AND gl_product_group NOT IN ({full})), long AS ({each}), "
             f"rk AS (SELECT channel, {key}, row_number() OVER (PARTITION BY channel ORDER BY {_mean('pred')} DESC, {key}) AS r FROM long GROUP BY channel, {key}) "
             f"SELECT channel, {key}, week, round({_mean('pred')}, 6) + 0.0 AS mean_pred_rate, round({_mean('actual')}, 6) + 0.0 AS mean_actual_rate "
             f"FROM long WHERE (channel, {key}) IN (SELECT channel, {key} FROM rk WHERE r <= 3) GROUP BY channel, {key}, week")


ORACLES = {
    "vw_rate_by_site": W(_wr("hashed_fc")),
    "vw_rate_by_gl": W(_wr("gl_product_group", "HAVING sum(units_total) >= 1000")),
    "vw_rate_site_gl": W(_wr("hashed_fc, gl_product_group", "HAVING sum(units_total) >= 1000")),
    "vw_rate_by_year": W(_wr("year")),
    "monthly_pivot": W(f", c AS (SELECT hashed_fc, month, {_RATE} AS r FROM weekly GROUP BY hashed_fc, month) "
                       f"SELECT hashed_fc, {_MONTHS} FROM c GROUP BY hashed_fc"),
    "quarterly_pivot": W(f", c AS (SELECT gl_product_group, 'Q' || CAST(CAST(ceil(month / 3.0) AS INTEGER) AS VARCHAR) AS q, "
                         f"{_RATE} AS r FROM weekly GROUP BY gl_product_group, q) SELECT gl_product_group, {_QS} FROM c GROUP BY gl_product_group"),
    "monthly_pivot_type": W(f", c AS (SELECT site_type, month, {_RATE} AS r FROM weekly GROUP BY site_type, month) SELECT site_type, {_MONTHS} FROM c GROUP BY site_type"),
    "monthly_pivot_country": W(f", c AS (SELECT country, month, {_RATE} AS r FROM weekly GROUP BY country, month) SELECT country, {_MONTHS} FROM c GROUP BY country"),
    "quarterly_pivot_type": W(_quarters("site_type", "weekly")),
    "quarterly_pivot_top_gl": W(_quarters("gl_product_group", f"(SELECT * FROM weekly WHERE gl_product_group IN {_top('gl_product_group', 20)})")),
    "overall_rates": W(f"SELECT CAST(sum(units_total) AS BIGINT) AS units_total, CAST(sum(units_recovered) AS BIGINT) AS units_recovered, round({_RATE}, 6) + 0.0 AS recovery_rate, "
                       + ", ".join(f"round({_mean(c)}, 6) + 0.0 AS mean_{c}" for c in ["prob_recovered", *S.RECOVERY_CHANNELS]) + " FROM weekly"),
    "display_keys": W(f", p AS (SELECT * FROM ({_PAIRS}) ORDER BY units_recovered DESC, hashed_fc, gl_product_group LIMIT 15) "
                      "SELECT hashed_fc, gl_product_group, CASE WHEN length(hashed_fc) > 6 THEN hashed_fc[1:6] || chr(8230) ELSE hashed_fc END AS site, "
                      "'GL ' || CAST(gl_product_group AS VARCHAR) AS gl, format('{:.1f}%', round(vw_rate, 6) * 100) AS rate, format('{:,}', units) AS units_text FROM p"),
    "week_profile": W(f", p AS ({_wr('week')}) SELECT *, recovery_rate > (SELECT median(recovery_rate) FROM p) AS above_median FROM p"),
    "year_week_profile": W(f", p AS ({_wr('year, week')}) SELECT *, row_number() OVER (ORDER BY year, week) AS week_index FROM p"),
    "monthly_profile": W(_wr("month")),
    "top_monthly_profile": W(_wr("hashed_fc, month").replace("FROM weekly", f"FROM weekly WHERE hashed_fc IN {_top('hashed_fc', 5)}")),
    "top_monthly_profile_gl": W(_wr("gl_product_group, month").replace(
        "FROM weekly", f"FROM weekly WHERE gl_product_group IN {_top('gl_product_group', 5)}")),
    "outcome_mix": _mix("hashed_fc"),
    "outcome_mix_gl": _mix("gl_product_group"),
    "site_summary": W(_summary("hashed_fc, site_type, site_category, country, country_state", 1000,
                               {"prob_recovered": "unweighted_mean", **X.SUMMARY_MEANS})),
    "gl_summary": W(_summary("gl_product_group", 1000, {**X.SUMMARY_MEANS, "share_food": "mean_food"}, ", avg(share_FBA) > 0.5 AS fba_majority")),
    "pair_summary": W(_PAIRS),
    "category_quartiles": W(f", sites AS (SELECT hashed_fc, site_type, site_category, country, {_RATE} AS r FROM weekly "
                            "GROUP BY ALL HAVING sum(units_total) >= 1000) " + " UNION ALL ".join(map(_quartile_sql, CATEGORIES))),
    "histogram": W("SELECT CAST(least(floor(prob_recovered * 20) + 1, 20) AS BIGINT) AS bin, "
                   "round(0.0 + (least(floor(prob_recovered * 20) + 1, 20) - 1) * 0.05, 6) + 0.0 AS bin_start, count(*) AS n "
                   "FROM weekly WHERE prob_recovered IS NOT NULL GROUP BY 1, 2"),
    "correlation": W(f", x AS ({_corr_sql()}) SELECT * FROM x"),
    "priority_quadrants": W(
        f", p AS (SELECT *, CAST(units_recovered AS DOUBLE) / units AS exact FROM ({_PAIRS})), "
        "m AS (SELECT median(exact) AS mr, median(units_recovered) AS mv FROM p) "
        "SELECT hashed_fc, gl_product_group, units, units_recovered, vw_rate, "
        "CASE WHEN exact > mr AND units_recovered > mv THEN 'high rate, high volume' WHEN exact > mr THEN 'high rate, low volume' "
        "WHEN units_recovered > mv THEN 'low rate, high volume' ELSE 'low rate, low volume' END AS quadrant FROM p CROSS JOIN m"),
    "shortlist": W(f", p AS ({_PAIRS}) SELECT * FROM p ORDER BY units_recovered DESC, hashed_fc, gl_product_group LIMIT 15"),
    "value_counts": O.with_ctes("SELECT recovery_type, count(*) AS n FROM clean GROUP BY recovery_type", "clean"),
    "column_summary": O.with_ctes(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT CAST({c} AS VARCHAR)) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_distinct, "
        f"min(CAST({c} AS VARCHAR)) AS min_value, max(CAST({c} AS VARCHAR)) AS max_value FROM clean"
        for c in ["hashed_fc", "gl_product_group", "year", "week"]), "clean"),
    "bucket_counts": W("SELECT CASE WHEN prob_recovered = 0 THEN 'zero' WHEN prob_recovered <= 0.1 THEN '0-10%' "
                       "WHEN prob_recovered <= 0.3 THEN '10-30%' WHEN prob_recovered <= 0.6 THEN '30-60%' ELSE '>60%' END AS rate_bucket, "
                       "count(*) AS n FROM weekly GROUP BY 1"),
    "baseline_predictions": P("SELECT * REPLACE (round(prob_recovered, 6) + 0.0 AS prob_recovered, p_nonzero + 0.0 AS p_nonzero, "
                              "e_rate + 0.0 AS e_rate, combined_rate + 0.0 AS combined_rate, abs_err + 0.0 AS abs_err, "
                              "baseline_rate + 0.0 AS baseline_rate, deviation + 0.0 AS deviation) FROM pred"),
    "overall_mae": P("SELECT count(abs_err) AS n_rows, round(avg(abs_err), 6) + 0.0 AS mean_abs_err FROM pred"),
    "mae_by_bucket": P("SELECT rate_bucket, count(abs_err) AS n_rows, round(avg(abs_err), 6) + 0.0 AS mean_abs_err, "
                       "round(median(abs_err), 6) + 0.0 AS median_abs_err, CASE rate_bucket WHEN 'zero' THEN 0 WHEN '0-10%' THEN 1 "
                       "WHEN '10-30%' THEN 2 WHEN '30-60%' THEN 3 ELSE 4 END AS bucket_order FROM pred GROUP BY rate_bucket"),
    "mae_by_volume": P("SELECT volume_bucket, count(abs_err) AS n_rows, round(avg(abs_err), 6) + 0.0 AS mean_abs_err, "
                       "round(median(abs_err), 6) + 0.0 AS median_abs_err, CASE volume_bucket WHEN '<10' THEN 0 WHEN '10-100' THEN 1 "
                       "WHEN '100-1k' THEN 2 ELSE 3 END AS bucket_order FROM pred GROUP BY volume_bucket"),
    "stratified_error": P("SELECT site_type, round(round(avg(abs_err), 4), 6) + 0.0 AS mae, round(round(median(abs_err), 4), 6) + 0.0 AS median_ae, "
                          "CAST(sum(units_total) AS BIGINT) AS units, count(*) AS n FROM pred GROUP BY site_type"),
    "top_groups": P("SELECT hashed_fc, round(avg(combined_rate), 6) + 0.0 AS mean_pred_rate, round(avg(prob_recovered), 6) + 0.0 AS mean_actual_rate "
                    "FROM pred GROUP BY hashed_fc ORDER BY avg(combined_rate) DESC, hashed_fc LIMIT 10"),
    "always_full_groups": P(_ALWAYS_FULL),
    "weekly_trend": _trend("hashed_fc"),
    "weekly_trend_gl": _trend("gl_product_group"),
    "channel_trend": _channel_trend_sql("hashed_fc"),
    "channel_trend_gl": _channel_trend_sql("gl_product_group"),
    "monthly_actual_vs_pred": P(
        ", top AS (SELECT hashed_fc FROM pred GROUP BY hashed_fc HAVING sum(units_total) >= 5000 "
        "ORDER BY sum(combined_rate * units_total) / sum(units_total) DESC, hashed_fc LIMIT 20) "
        f"SELECT hashed_fc, month, round({_mean('prob_recovered')}, 6) + 0.0 AS mean_actual, round({_mean('combined_rate')}, 6) + 0.0 AS mean_pred, "
        "count(*) AS n FROM pred WHERE hashed_fc IN (SELECT hashed_fc FROM top) GROUP BY hashed_fc, month"),
    "weighted_pred_rate": P(
        "SELECT gl_product_group, CAST(sum(units_total) AS BIGINT) AS units, "
        "round(CASE WHEN sum(units_total) <> 0 THEN sum(combined_rate * units_total) / sum(units_total) END, 6) + 0.0 AS weighted_pred "
        "FROM pred GROUP BY gl_product_group HAVING sum(units_total) >= 100 ORDER BY weighted_pred DESC, gl_product_group LIMIT 3"),
    "bucket_means": P("SELECT rate_bucket, count(*) AS n, " + r6("mean_baseline", "mean_deviation", "mean_full", "mean_actual").replace(
        "round(mean_baseline", "round(avg(baseline_rate)").replace("round(mean_deviation", "round(avg(deviation)").replace(
        "round(mean_full", "round(avg(combined_rate)").replace("round(mean_actual", "round(avg(prob_recovered)") + " FROM pred GROUP BY rate_bucket"),
    "deviation_quantiles": P("SELECT round(quantile_cont(deviation, 0.05), 6) + 0.0 AS q05, round(quantile_cont(deviation, 0.95), 6) + 0.0 AS q95, "
                             "round(avg(abs(deviation)), 6) + 0.0 AS mean_abs, round(avg(deviation), 6) + 0.0 AS mean_signed "
                             "FROM pred WHERE p_nonzero > 0.5"),
    "site_deviation": P("SELECT hashed_fc, round(avg(combined_rate), 6) + 0.0 AS mean_rate, round(avg(baseline_rate), 6) + 0.0 AS mean_baseline, "
                        "round(avg(deviation), 6) + 0.0 AS mean_deviation FROM pred GROUP BY hashed_fc ORDER BY avg(combined_rate) DESC, hashed_fc LIMIT 5"),
    "largest_deviation_site": P("SELECT hashed_fc, round(avg(deviation), 6) + 0.0 AS mean_deviation FROM pred GROUP BY hashed_fc "
                                "ORDER BY avg(deviation) DESC, hashed_fc LIMIT 1"),
}
