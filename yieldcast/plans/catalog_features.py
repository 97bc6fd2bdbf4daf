"""Registered queries: cleaning, aggregation and feature operators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from yieldcast import schema as S
from yieldcast.functions.scalar import iso_week_monday, round_half_away
from yieldcast.models.features import ALL_SUFFIXES
from yieldcast.operators import aggregate as A
from yieldcast.operators import clean as C
from yieldcast.operators import temporal as W
from yieldcast.plans import oracles as O
from yieldcast.plans.common import aggregated, cleaned, finalize, raw, weekly
from yieldcast.plans.features import feature_table
from yieldcast.session import checkpoint_dir
from yieldcast.sources.files import read_raw_csv, write_csv
from yieldcast.sources.fixture import with_carried_columns

KEYS = [S.SITE, S.YEAR, S.MONTH, S.WEEK, S.GL]
# Columns the temporal checks run on. Rolling means of 6-decimal values land
# exactly on a rounding tie about a quarter of the time, where the last bit
# depends on each engine's summation order; the rolling check therefore uses
# integer-valued columns (tie-free), the EWMA check moderate magnitudes.
LAG_CHECK_COLS = ["units_total", "prob_recovered", "site_units_share_week", "cogs_total"]
ROLL_CHECK_COLS = ["units_total", "units_recovered", "weight_total", "units_sales"]
EWMA_CHECK_COLS = ["units_total", "prob_recovered", "site_units_share_week"]


def q_clean_rows(spark, sf):
    return finalize(cleaned(spark, sf))


def q_all_null_columns(spark, sf):
    return C.null_profile(raw(spark, sf))


def q_source_roundtrip_csv(spark, sf):
    """Write the raw records as tab-separated text, read back with the declared schema."""
    path = f"{checkpoint_dir(spark)}/roundtrip-{uuid.uuid4().hex}"
    write_csv(raw(spark, sf).drop("vendor_name"), path)
    back = read_raw_csv(spark, path)
    return finalize(back.select(*[c for c in raw(spark, sf).columns if c != "vendor_name"]))


def q_aggregate_site_gl_week(spark, sf):
    return finalize(A.aggregate_site_gl_week(cleaned(spark, sf)))


def q_conditional_sums(spark, sf):
    """A2/A3 on another key: units by channel per (site, year), plus units not sold."""
    df = cleaned(spark, sf)
    return df.groupBy(S.SITE, S.YEAR).agg(
        *A.conditional_sums("recovery_type", S.RECOVERY_TYPES, "units", "units"),
        A.conditional_sum("recovery_type", S.SALES, "units", "units_recovered", op="ne"))


def q_consolidate_channels(spark, sf):
    return finalize(aggregated(spark, sf))


def q_unit_shares(spark, sf):
    return finalize(A.unit_shares(aggregated(spark, sf)).select(*KEYS, *A.UNIT_SHARES))


def q_recovery_mix(spark, sf):
    return finalize(A.recovery_mix(aggregated(spark, sf)).select(*KEYS, *A.RECOVERY_MIX))


def q_unit_averages(spark, sf):
    return finalize(A.unit_averages(aggregated(spark, sf)).select(*KEYS, *A.UNIT_AVERAGES))


def q_iso_week_date(spark, sf):
    df = cleaned(spark, sf).select(S.YEAR, S.WEEK).distinct()
    return df.select(S.YEAR, S.WEEK, iso_week_monday(S.YEAR, S.WEEK).alias(S.WEEK_DATE))


def q_site_week_totals(spark, sf):
    df = W.site_week_totals(aggregated(spark, sf))
    return finalize(df.select(*KEYS, S.WEEK_DATE, *W.SITE_WEEK_SUMS))


def q_gl_share_of_site(spark, sf):
    df = W.gl_share_of_site(W.site_week_totals(aggregated(spark, sf)))
    return finalize(df.select(*KEYS, S.WEEK_DATE, *W.SITE_WEEK_RATIOS))


def q_weekly_features(spark, sf):
    return finalize(weekly(spark, sf))


def q_week_grid(spark, sf):
    df = W.fill_week_grid(weekly(spark, sf))
    return df.select(*S.SERIES_KEYS, S.WEEK_DATE, "start", "end", S.YEAR, S.MONTH, S.WEEK, "units_total")


def _temporal(spark, sf, cols, **kw):
    base = dict(lags=(), rolling=(), rolling_long=(), alphas=(), period=None)
    base.update(kw)
    df = W.temporal_features(weekly(spark, sf), cols=cols, **base)
    feats = [c for c in df.columns if any(c.startswith(f"{t}_") for t in cols)
             and ("_lag_" in c or "_rolling_" in c or "_ewma_" in c)]
    return finalize(df.select(*KEYS, S.WEEK_DATE, *feats))


def q_lag_features(spark, sf):
    return _temporal(spark, sf, LAG_CHECK_COLS, lags=S.LAG_WEEKS)


def q_rolling_short(spark, sf):
    return _temporal(spark, sf, ROLL_CHECK_COLS, rolling=S.ROLLING_WEEKS)


def q_rolling_long(spark, sf):
    return _temporal(spark, sf, ROLL_CHECK_COLS, rolling_long=S.ROLLING_WEEKS_LONG)


def q_ewma_features(spark, sf):
    return _temporal(spark, sf, EWMA_CHECK_COLS, alphas=S.EWMA_ALPHAS)


TEMPORAL_COLS = sorted([
    "units_total", "cogs_total", "weight_total", *[f"units_{s}" for s in (
        *S.MACRO_CATEGORIES.values(), *S.PRODUCT_TYPES.values(), "recovered", "hazmat", "sales", "donations", "disposal",
        "warehouse_deals_and_gr", "liquidations", "return_to_vendor")],
    *A.UNIT_SHARES, *A.RECOVERY_MIX, *A.UNIT_AVERAGES, *W.SITE_WEEK_SUMS, *W.SITE_WEEK_RATIOS])
DIGITS = 6      # significant digits to which EWMA columns are compared: their weights are no decimals


def q_temporal_all(spark, sf):
    """All 627 temporal columns of the weekly table; rolling means to 6 places, EWMA to ``DIGITS`` significant digits."""
    df = feature_table(with_carried_columns(raw(spark, sf)))
    found = [c[:-len("_lag_1w")] for c in df.columns if c.endswith("_lag_1w")]
    feats = [f"{c}_{t}" for c in found for t in ALL_SUFFIXES]

    def shown(c):
        x = F.col(c)
        if "_ewma_" in c:
            # 10^(digits before the point of the value - DIGITS), as an exact power of ten where it is above 1
            place = F.floor(F.log10(F.abs(x))) + 1 - DIGITS
            size = F.pow(F.lit(10.0), F.abs(place))
            fine = F.when(place < 0, F.round(x * size) / size).otherwise(F.round(x / size) * size)
            return F.when((x == 0) | F.isnan(x) | (F.abs(x) == float("inf")), x).otherwise(fine).alias(c)
        return (round_half_away(x) + F.lit(0.0)).alias(c) if "_rolling_" in c or dict(df.dtypes)[c] == "double" else x.alias(c)

    return df.select(*KEYS, S.WEEK_DATE, *[shown(c) for c in feats])


def q_cyclic_week(spark, sf):
    df = W.cyclic_week_features(cleaned(spark, sf).select(S.WEEK).distinct())
    return finalize(df)


QUERIES = {
    "clean_rows": q_clean_rows,
    "all_null_columns": q_all_null_columns,
    "source_roundtrip_csv": q_source_roundtrip_csv,
    "aggregate_site_gl_week": q_aggregate_site_gl_week,
    "conditional_sums": q_conditional_sums,
    "consolidate_channels": q_consolidate_channels,
    "unit_shares": q_unit_shares,
    "recovery_mix": q_recovery_mix,
    "unit_averages": q_unit_averages,
    "iso_week_date": q_iso_week_date,
    "site_week_totals": q_site_week_totals,
    "gl_share_of_site": q_gl_share_of_site,
    "weekly_features": q_weekly_features,
    "week_grid": q_week_grid,
    "lag_features": q_lag_features,
    "rolling_short": q_rolling_short,
    "rolling_long": q_rolling_long,
    "ewma_features": q_ewma_features,
    "temporal_all": q_temporal_all,
    "cyclic_week": q_cyclic_week,
}

# ---------------------------------------------------------------------------
# Oracles
# ---------------------------------------------------------------------------

_KEYS = "hashed_fc, year, month, week, gl_product_group"
_RAW_COLS = ["hashed_fc", "year", "month", "week", "gl_product_group", "product_type",
             "macro_category", "is_hazmat", "units", "cogs", "weight", "country", "country_state",
             "zip_code", "site_type", "site_category", "recovery_type", "marketplace_id"]  # fixture columns


def _rounded_star(cols_double: list[str]) -> str:
    return "* REPLACE (" + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in cols_double) + ")"


def _null_profile_sql() -> str:
    cols = _RAW_COLS[:-1] + ["vendor_name", "marketplace_id"]
    parts = [f"SELECT '{c}' AS column_name, count({c}) AS non_null, count({c}) = 0 AS all_null FROM raw"
             for c in cols]
    return O.with_ctes(" UNION ALL ".join(parts), "raw")


def _temporal_oracle(cols, **kw) -> str:
    return O.temporal_sql(cols, **kw)


ORACLES = {
    "clean_rows": O.with_ctes(f"SELECT {_rounded_star(['cogs', 'weight'])} FROM clean", "clean"),
    "all_null_columns": _null_profile_sql(),
    "source_roundtrip_csv": O.with_ctes(
        "SELECT * EXCLUDE (vendor_name) REPLACE (round(cogs, 6) + 0.0 AS cogs, round(weight, 6) + 0.0 AS weight) "
        "FROM raw", "raw"),
    "aggregate_site_gl_week": O.with_ctes(
        f"SELECT {_rounded_star(['cogs_total', 'weight_total'])} FROM agg", "agg"),
    "conditional_sums": O.with_ctes(
        "SELECT hashed_fc, year, " + ", ".join(
            f"CAST(coalesce(sum(CASE WHEN recovery_type = '{v}' THEN units ELSE 0 END), 0) AS BIGINT) AS units_{s}"
            for v, s in S.RECOVERY_TYPES.items())
        + ", CAST(coalesce(sum(CASE WHEN recovery_type <> 'Sales' THEN units ELSE 0 END), 0) AS BIGINT) AS units_recovered"
        " FROM clean GROUP BY hashed_fc, year", "clean"),
    "consolidate_channels": O.with_ctes(
        f"SELECT {_rounded_star(['cogs_total', 'weight_total'])} FROM cons", "cons"),
    "unit_shares": O.with_ctes(
        f"SELECT {_KEYS}, " + ", ".join(O.r6(c, c) for c in A.UNIT_SHARES) + " FROM shares", "shares"),
    "recovery_mix": O.with_ctes(
        f"SELECT {_KEYS}, " + ", ".join(O.r6(c, c) for c in A.RECOVERY_MIX) + " FROM mix", "mix"),
    "unit_averages": O.with_ctes(
        f"SELECT {_KEYS}, " + ", ".join(O.r6(c, c) for c in A.UNIT_AVERAGES) + " FROM avgs", "avgs"),
    "iso_week_date": O.with_ctes(
        f"SELECT DISTINCT year, week, {O.WEEK_DATE_SQL} AS week_date FROM clean", "clean"),
    "site_week_totals": O.with_ctes(
        f"SELECT {_KEYS}, week_date, " + ", ".join(
            O.r6(c, c) if c == "site_weight_total_week" else c for c in W.SITE_WEEK_SUMS)
        + " FROM site_sums", "site_sums"),
    "gl_share_of_site": O.with_ctes(
        f"SELECT {_KEYS}, week_date, " + ", ".join(O.r6(c, c) for c in W.SITE_WEEK_RATIOS)
        + " FROM site_ratios", "site_ratios"),
    "weekly_features": O.with_ctes("SELECT * REPLACE (" + ", ".join(
        f"{c} + 0.0 AS {c}" for c in O._DOUBLE_COLS) + ") FROM weekly"),
    "week_grid": O.with_ctes(O.GRID_CTES + "SELECT hashed_fc, gl_product_group, week_date, start, \"end\", "
                             "year, month, week, units_total FROM g"),
    "lag_features": _temporal_oracle(LAG_CHECK_COLS, lags=S.LAG_WEEKS),
    "rolling_short": _temporal_oracle(ROLL_CHECK_COLS, rolling=S.ROLLING_WEEKS),
    "rolling_long": _temporal_oracle(ROLL_CHECK_COLS, rolling_long=S.ROLLING_WEEKS_LONG),
    "ewma_features": _temporal_oracle(EWMA_CHECK_COLS, alphas=S.EWMA_ALPHAS),
    "temporal_all": O.temporal_all_sql(TEMPORAL_COLS, DIGITS),
    "cyclic_week": O.with_ctes(
        f"SELECT DISTINCT week, round(sin(2 * pi() * week / {S.WEEK_PERIOD}), 6) + 0.0 AS week_sin, "
        f"round(cos(2 * pi() * week / {S.WEEK_PERIOD}), 6) + 0.0 AS week_cos FROM clean", "clean"),
}
