"""Exploration tables over the weekly aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yieldcast import schema as S
from yieldcast.functions.scalar import fixed_point_mean, majority_flag, quarter, rate_bucket

REC, UNITS = "units_recovered", "units_total"


def weighted_rate(df: DataFrame, keys: Sequence[str], min_units: float = 0, rec: str = REC,
                  units: str = UNITS) -> DataFrame:
    """sum(recovered) / sum(units) per key set, HAVING sum(units) >= min_units."""
    out = df.groupBy(*keys).agg(F.sum(units).alias("units_total"), F.sum(rec).alias("units_recovered"))
    out = out.withColumn("recovery_rate", F.try_divide(F.col("units_recovered").cast("double"), F.col("units_total")))
    return out.filter(F.col("units_total") >= min_units) if min_units else out


MIN_KEY_UNITS = 1_000     # floor of the site and GL rankings
MIN_PAIR_UNITS = 500      # floor of the pair ranking
SUMMARY_MEANS = {"share_hazmat": "mean_hazmat", "share_FBA": "mean_fba", "avg_cogs_per_unit": "mean_cogs_per_unit"}


def summary(df: DataFrame, keys: Sequence[str], min_units: float, means=SUMMARY_MEANS) -> DataFrame:
    """Weighted rate, units and column means per key set, HAVING sum(units) >= min_units."""
    out = df.groupBy(*keys).agg(F.sum(UNITS).alias("units"), F.sum(REC).alias("units_recovered"),
                                *[F.avg(c).alias(name) for c, name in means.items()])
    return out.filter(F.col("units") >= min_units).withColumn(
        "vw_rate", F.try_divide(F.col("units_recovered").cast("double"), F.col("units")))


def site_summary(df: DataFrame) -> DataFrame:
    """Per site (with its attributes): weighted and unweighted rate, units, means."""
    keys = [S.SITE, "site_type", "site_category", "country", "country_state"]
    return summary(df, keys, MIN_KEY_UNITS, {S.RATE: "unweighted_mean", **SUMMARY_MEANS})


def gl_summary(df: DataFrame) -> DataFrame:
    """Per GL: weighted rate, units, means, and whether FBA units are the majority."""
    out = summary(df, [S.GL], MIN_KEY_UNITS, {**SUMMARY_MEANS, "share_food": "mean_food"})
    return out.withColumn("fba_majority", majority_flag("mean_fba"))


def pair_summary(df: DataFrame) -> DataFrame:
    """Per (site, GL): weighted rate, units, means, pairs of at least MIN_PAIR_UNITS units."""
    return summary(df, [S.SITE, S.GL, "site_type", "country"], MIN_PAIR_UNITS)


def top_keys(df: DataFrame, key: str, n: int, min_units: float = MIN_KEY_UNITS) -> DataFrame:
    """J6 helper: the n keys of the highest weighted rate with at least ``min_units`` units (ties by key)."""
    return weighted_rate(df, [key], min_units).orderBy(F.desc("recovery_rate"), key).limit(n).select(key)


def pivot_rate(df: DataFrame, key: str, by_col, values: Sequence, names: Sequence[str]) -> DataFrame:
    """Key x period weighted rate, missing cells 0.

    Pivot values are given, so Spark needs no extra pass to find them; the
    pivot runs as one aggregate.
    """
    p = (df.withColumn("_by", by_col).groupBy(key).pivot("_by", list(values))
           .agg(F.try_divide(F.sum(REC).cast("double"), F.sum(UNITS))))
    return p.select(key, *[F.coalesce(F.col(f"`{v}`"), F.lit(0.0)).alias(nm) for v, nm in zip(values, names)])


def overall_rates(df: DataFrame, channels: Sequence[str] = S.RECOVERY_CHANNELS) -> DataFrame:
    """One row: units, weighted rate, and the plain means of the rate and of each channel's rate."""
    return df.agg(F.sum(UNITS).alias("units_total"), F.sum(REC).alias("units_recovered"),
                  F.try_divide(F.sum(REC).cast("double"), F.sum(UNITS)).alias("recovery_rate"),
                  *[fixed_point_mean(c).alias(f"mean_{c}") for c in [S.RATE, *channels]])


def restrict_to_top(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows of the n keys with the highest weighted rate."""
    return df.join(top_keys(df, key, n), on=key, how="left_semi")


def monthly_pivot(df: DataFrame, key: str = S.SITE) -> DataFrame:
    return pivot_rate(df, key, F.col(S.MONTH), list(range(1, 13)), [f"m{m:02d}" for m in range(1, 13)])


def quarterly_pivot(df: DataFrame, key: str = S.GL) -> DataFrame:
    qs = ["Q1", "Q2", "Q3", "Q4"]
    return pivot_rate(df, key, quarter(S.MONTH), qs, qs)


def week_profile(df: DataFrame) -> DataFrame:
    """Rate per ISO week over all years, flagged above the median week."""
    prof = weighted_rate(df, [S.WEEK])
    med = prof.agg(F.median("recovery_rate").alias("_med"))
    return (prof.crossJoin(F.broadcast(med))
                .select("*", (F.col("recovery_rate") > F.col("_med")).alias("above_median")).drop("_med"))


def year_week_profile(df: DataFrame) -> DataFrame:
    """Rate per (year, week) with a running week index (calendar-bounded table)."""
    prof = weighted_rate(df, [S.YEAR, S.WEEK])
    return prof.withColumn("week_index", F.row_number().over(Window.orderBy(S.YEAR, S.WEEK)))


def monthly_profile(df: DataFrame, key: str | None = None, top_n: int | None = None) -> DataFrame:
    """Rate by month overall, or per key for the n keys of the highest weighted rate."""
    if key is None:
        return weighted_rate(df, [S.MONTH])
    top = top_keys(df, key, top_n) if top_n else df.select(key).distinct()
    return weighted_rate(df.join(top, on=key, how="left_semi"), [key, S.MONTH])


OUTCOMES = ["remove_return", "donations", "bintool_donations", "warehouse_deals_and_gr", "liquidations",
            "return_to_vendor", "bintool_theft", "remove_liquidate", "bintool_remove_liquidate"]


def with_outcome_mix(df: DataFrame) -> DataFrame:
    """A5: nine shares of recovered units, recov_share_*, 0 where nothing was recovered."""
    return df.select("*", *[
        F.when(F.col(REC) > 0, F.col(f"units_{o}") / F.col(REC)).otherwise(F.lit(0.0)).alias(f"recov_share_{o}") for o in OUTCOMES])


def outcome_mix(df: DataFrame, key: str, top_n: int = 20) -> DataFrame:
    """Recovered units and mean outcome shares for the top-n keys by weighted rate.

    ``df``: rows per (site, year, month, week, GL) with the nine units_* outcome columns.
    """
    top = top_keys(df, key, top_n)
    return (with_outcome_mix(df).join(top, on=key, how="left_semi").groupBy(key)
            .agg(F.sum(REC).alias("units_recovered"), *[F.avg(f"recov_share_{o}").alias(f"recov_share_{o}") for o in OUTCOMES]))


def category_quartiles(df: DataFrame, cat: str) -> DataFrame:
    """Sites, quartiles and median of the sites' weighted rates per category (sites above the unit floor)."""
    sites = weighted_rate(df, [S.SITE, "site_type", "site_category", "country"], MIN_KEY_UNITS)
    q = F.percentile(F.col("recovery_rate"), [0.25, 0.5, 0.75])
    return (sites.groupBy(cat).agg(F.count(S.SITE).alias("n"), q.alias("_q"))
            .select(F.lit(cat).alias("category"), F.col(cat).alias("value"), "n", F.col("_q")[0].alias("q25"),
                    F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q75")))


def histogram(df: DataFrame, x: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Equal-width bins; a value equal to ``hi`` goes to the last bin."""
    b = F.least(F.width_bucket(F.col(x), F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins))
    return (df.filter(F.col(x).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
              .select("bin", (F.lit(lo) + (F.col("bin") - 1) * F.lit((hi - lo) / bins)).alias("bin_start"), "n"))


def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair in one aggregate, long form.

    NaN is made null first; each pair skips rows where either side is null.
    """
    clean = df.select([F.when(~F.isnan(F.col(c)), F.col(c)).alias(c) for c in cols])
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = clean.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    items = []
    for i, (a, b) in enumerate(pairs):
        items.append(f"'{a}', '{b}', c{i}")
        if a != b:
            items.append(f"'{b}', '{a}', c{i}")
    return wide.selectExpr(f"stack({len(items)}, {', '.join(items)}) AS (col_a, col_b, corr)")


def _middle(df: DataFrame, col: str) -> DataFrame:
    """Exact median as one row: count per value, then the one or two middle ranks (no task holds the rows)."""
    ranked = (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n")))
    return ranked.agg(F.percentile("v", F.lit(0.5), F.col("n")).alias("m"))


def priority_quadrants(df: DataFrame) -> DataFrame:
    """Each pair's rate and recovered units against the medians over pairs of at least MIN_PAIR_UNITS units."""
    pairs = pair_summary(df)
    med = _middle(pairs, "vw_rate").withColumnRenamed("m", "_mr").crossJoin(
        _middle(pairs, "units_recovered").withColumnRenamed("m", "_mv"))
    hi_r = F.col("vw_rate") > F.col("_mr")
    hi_v = F.col("units_recovered") > F.col("_mv")
    quad = (F.when(hi_r & hi_v, "high rate, high volume").when(hi_r, "high rate, low volume")
            .when(hi_v, "low rate, high volume").otherwise("low rate, low volume"))
    return pairs.crossJoin(F.broadcast(med)).select(S.SITE, S.GL, "units", "units_recovered", "vw_rate", quad.alias("quadrant"))


def shortlist(df: DataFrame, n: int = 15) -> DataFrame:
    """Top-n pairs by recovered units (key order breaks ties)."""
    return pair_summary(df).orderBy(F.desc("units_recovered"), S.SITE, S.GL).limit(n)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value (null counted as its own value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def column_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct count (null counted, as the source does), min and max per column."""
    items = []
    aggs = []
    for i, c in enumerate(cols):
        col = F.col(c).cast("string")
        aggs += [(F.count_distinct(col) + F.max(F.when(col.isNull(), 1).otherwise(0))).alias(f"d{i}"),
                 F.min(col).alias(f"lo{i}"), F.max(col).alias(f"hi{i}")]
        items.append(f"'{c}', d{i}, lo{i}, hi{i}")
    return df.agg(*aggs).selectExpr(f"stack({len(cols)}, {', '.join(items)}) AS (column_name, n_distinct, min_value, max_value)")


def yearly_totals(df: DataFrame) -> DataFrame:
    """Units, recovered units and rate per year."""
    return weighted_rate(df, [S.YEAR])


def bucket_counts(df: DataFrame, rate: str = S.RATE, inclusive: bool = True) -> DataFrame:
    """Rows per rate bucket (exploration edges)."""
    return df.groupBy(rate_bucket(rate, inclusive).alias("rate_bucket")).agg(F.count(F.lit(1)).alias("n"))
