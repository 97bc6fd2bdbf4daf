"""Core aggregation and per-row share features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldcast import schema as S
from yieldcast.functions.scalar import horizontal_sum, safe_div


def conditional_sum(filter_col: str, value, sum_col: str, alias: str, op: str = "eq") -> Column:
    """A2: sum of ``sum_col`` over rows where ``filter_col`` (==|!=) ``value``.

    Rows failing (or with a null comparison) add 0; an empty sum is 0.
    """
    cond = F.col(filter_col) == value if op == "eq" else F.col(filter_col) != value
    return F.coalesce(F.sum(F.when(cond, F.col(sum_col)).otherwise(F.lit(0))), F.lit(0)).alias(alias)


def conditional_sums(filter_col: str, mapping: Mapping[str, str], sum_col: str,
                     prefix: str) -> list[Column]:
    """A3: one conditional sum per value -> ``{prefix}_{suffix}`` (a pivot in one pass)."""
    return [conditional_sum(filter_col, v, sum_col, f"{prefix}_{suffix}")
            for v, suffix in mapping.items()]


def exact_sum(c: str, alias: str) -> Column:
    """Sum of a double column in units of 10^-9, the same in any order; empty sums are 0.

    Values of 10^18 and more, infinities and NaN are added as doubles beside it.
    """
    x = F.col(c).cast("double")
    usual = F.abs(x) < 1e18
    whole = F.sum(F.when(usual, F.round(x * 1e9).cast("decimal(28,0)"))).cast("double") / 1e9
    rest = F.sum(F.when(~usual, x))
    return (F.coalesce(whole, F.lit(0.0)) + F.coalesce(rest, F.lit(0.0))).alias(alias)


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("num_records"),
        F.coalesce(F.sum("units"), F.lit(0)).cast("bigint").alias("units_total"),
        exact_sum("cogs", "cogs_total"),
        exact_sum("weight", "weight_total"),
        *conditional_sums("macro_category", S.MACRO_CATEGORIES, "units", "units"),
        *conditional_sums("product_type", S.PRODUCT_TYPES, "units", "units"),
        conditional_sum("recovery_type", S.SALES, "units", "units_recovered", op="ne"),
        *conditional_sums("recovery_type", S.RECOVERY_TYPES, "units", "units"),
        conditional_sum("is_hazmat", "Y", "units", "units_hazmat"),
    ]


def aggregate_site_gl_week(df: DataFrame, keys: Sequence[str] = S.AGG_KEYS,
                           cluster_site_week: bool = True) -> DataFrame:
    """A1: records -> one row per (site, year, month, week, GL), plus ``week_date``.

    Two levels. Level 1 groups raw rows by the key plus the five site
    attributes: every measure is a fixed-width sum, so Spark runs a map-side
    partial hash aggregate and a hot key moves as one row per task. Level 2
    folds the (normally single) attribute combination per key with ``min``
    -- the string minimum that would force a sort-based aggregate over raw
    rows only sees level-1 rows here. With ``cluster_site_week`` level 1 is
    hash-partitioned on (site, week_date), which also serves level 2 and the
    site-week window that follows: one shuffle instead of two.
    """
    from yieldcast.operators.temporal import iso_week_monday_col
    keyed = df.select("*", iso_week_monday_col().alias(S.WEEK_DATE))
    level1 = keyed.groupBy(*keys, S.WEEK_DATE, *S.SITE_ATTRIBUTES).agg(*_measures())
    if cluster_site_week:
        level1 = level1.repartition(S.SITE, S.WEEK_DATE)
    sums = [c for c in level1.columns if c not in (*keys, S.WEEK_DATE, *S.SITE_ATTRIBUTES)]
    return level1.groupBy(*keys, S.WEEK_DATE).agg(
        *[F.sum(c).alias(c) for c in sums], *[F.min(c).alias(c) for c in S.SITE_ATTRIBUTES])


def consolidate_channels(df: DataFrame, channels: Mapping[str, Sequence[str]] = S.CHANNEL_CONSOLIDATION,
                         skip_nulls: bool = True) -> DataFrame:
    """sum sub-channel columns into ``units_{channel}`` and drop the sources."""
    new = {f"units_{name}": horizontal_sum(srcs, skip_nulls).alias(f"units_{name}")
           for name, srcs in channels.items()}
    drop = {c for name, srcs in channels.items() for c in srcs if c != f"units_{name}"}
    kept = [F.col(c) for c in df.columns if c not in drop and c not in new]
    return df.select(*kept, *new.values())


# Fixed feature definitions: output -> (numerator, denominator).
UNIT_SHARES = {
    "share_RETAIL": ("units_RETAIL", "units_total"),
    "share_FBA": ("units_FBA", "units_total"),
    "share_hazmat": ("units_hazmat", "units_total"),
    "share_food": ("units_food", "units_total"),
    "share_non_food": ("units_non_food", "units_total"),
    "share_pet_food": ("units_pet_food", "units_total"),
    "prob_sales": ("units_sales", "units_total"),
    "prob_recovered": ("units_recovered", "units_total"),
    "prob_return_to_vendor": ("units_return_to_vendor", "units_total"),
    "prob_warehouse_deals_and_gr": ("units_warehouse_deals_and_gr", "units_total"),
    "prob_donations": ("units_donations", "units_total"),
    "prob_liquidations": ("units_liquidations", "units_total"),
    "prob_disposal": ("units_disposal", "units_total"),
}
RECOVERY_MIX = {
    "share_sales": ("units_sales", "units_recovered"),
    "share_return_to_vendor": ("units_return_to_vendor", "units_recovered"),
    "share_warehouse_deals_and_gr": ("units_warehouse_deals_and_gr", "units_recovered"),
    "share_donations": ("units_donations", "units_recovered"),
    "share_liquidations": ("units_liquidations", "units_recovered"),
    "share_disposal": ("units_disposal", "units_recovered"),
}
UNIT_AVERAGES = {
    "avg_cogs_per_unit": ("cogs_total", "units_total"),
    "avg_weight_per_unit": ("weight_total", "units_total"),
    "cogs_per_unit_weight": ("cogs_total", "weight_total"),
}


def _ratios(df: DataFrame, spec: Mapping[str, tuple[str, str]], zero_default: bool = False) -> DataFrame:
    cols = []
    for name, (num, den) in spec.items():
        expr = safe_div(num, den)
        if zero_default:
            expr = F.coalesce(expr, F.lit(0.0))
        cols.append(expr.alias(name))
    return df.select("*", *cols)


def unit_shares(df: DataFrame) -> DataFrame:
    """A4: 13 shares of units_total (zero total -> null)."""
    return _ratios(df, UNIT_SHARES)


def recovery_mix(df: DataFrame, zero_default: bool = False) -> DataFrame:
    """A5: 6 channel shares of recovered units (null, or 0 when ``zero_default``)."""
    return _ratios(df, RECOVERY_MIX, zero_default)


def unit_averages(df: DataFrame) -> DataFrame:
    """Cogs per unit, weight per unit, cogs per weight."""
    return _ratios(df, UNIT_AVERAGES)
