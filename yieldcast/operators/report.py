"""Report tables over a predictions table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yieldcast import schema as S
from yieldcast.functions.scalar import fixed_point_mean, nan_to_null, rate_bucket_order, volume_bucket_order
from yieldcast.operators.quantiles import quantiles

ACTUAL, PRED, ERR = "prob_recovered", "combined_rate", "abs_err"


def overall_mae(pred: DataFrame) -> DataFrame:
    """Rows and mean absolute error over everything (NaN skipped)."""
    e = nan_to_null(ERR)
    return pred.agg(F.count(e).alias("n_rows"), F.avg(e).alias("mean_abs_err"))


def mae_by_bucket(pred: DataFrame, bucket: str) -> DataFrame:
    """N, mean and median absolute error per bucket, in bucket order (NaN skipped)."""
    e = nan_to_null(ERR)
    order = rate_bucket_order(bucket) if bucket == "rate_bucket" else volume_bucket_order(bucket)
    return (pred.groupBy(bucket).agg(F.count(e).alias("n_rows"), F.avg(e).alias("mean_abs_err"),
                                     F.median(e).alias("median_abs_err"))
                .withColumn("bucket_order", order))


def stratified_error(pred: DataFrame, by: str, units: str = "units_total", rounded: bool = True) -> DataFrame:
    """MAE, median AE, units and rows per stratum, rounded to 4 places.

    Errors of the predictions table are rounded, so a median's map of values is bounded; of errors that are not (``rounded=False``) the
    median is found by distributed selection.
    """
    e = nan_to_null(ERR)
    if not rounded:
        sums = pred.groupBy(by).agg(F.round(F.avg(e), 4).alias("mae"), F.sum(units).alias("units"), F.count(F.lit(1)).alias("n"))
        middle = quantiles(pred, [by], ERR, [0.5]).select(F.col(by).alias("_by"), F.round("q0", 4).alias("median_ae"))
        return sums.join(middle, F.col(by).eqNullSafe(F.col("_by")), "left").select(by, "mae", "median_ae", "units", "n")
    return pred.groupBy(by).agg(F.round(F.avg(e), 4).alias("mae"), F.round(F.median(e), 4).alias("median_ae"),
                                F.sum(units).alias("units"), F.count(F.lit(1)).alias("n"))


def top_groups(pred: DataFrame, key: str, n: int = 10, value: str = PRED, actual: str = ACTUAL) -> DataFrame:
    """Mean predicted and actual rate per group, top-n by prediction (key breaks ties)."""
    return (pred.groupBy(key).agg(F.avg(value).alias("mean_pred_rate"), F.avg(actual).alias("mean_actual_rate"))
                .orderBy(F.desc("mean_pred_rate"), key).limit(n))


def always_full_groups(pred: DataFrame, key: str) -> DataFrame:
    """Groups whose actual rate is 1.0 in every row (a null row disqualifies)."""
    return (pred.groupBy(key).agg(F.every(F.coalesce(F.col(ACTUAL) == 1.0, F.lit(False))).alias("_all"))
                .filter("_all").select(key))


def without_full_groups(pred: DataFrame) -> DataFrame:
    """Rows whose site and GL both have some row below a full rate."""
    out = pred
    for key in (S.GL, S.SITE):
        out = out.join(always_full_groups(pred, key), on=key, how="left_anti")
    return out


def weekly_trend(pred: DataFrame, key: str, n: int = 5, value: str = PRED, actual: str = ACTUAL) -> DataFrame:
    """Weekly mean predicted and actual rate for the top-n groups, full sites and full GLs left out.

    ``value`` and ``actual`` name a channel's columns for the per-channel series.
    """
    base = without_full_groups(pred)
    top = top_groups(base, key, n, value, actual).select(key)
    return (base.join(top, on=key, how="left_semi").groupBy(key, S.WEEK)
                .agg(fixed_point_mean(value).alias("mean_pred_rate"), fixed_point_mean(actual).alias("mean_actual_rate")))


def channel_trends(pred: DataFrame, key: str, channels: Sequence[str], n: int = 5) -> DataFrame:
    """The weekly series of every channel, each with its own top-n groups, as one table.

    Rows are unpivoted once, so that all channels are ranked and averaged in the same two shuffles.
    """
    base = without_full_groups(pred)
    per = F.array(*[F.struct(F.lit(ch).alias("channel"), F.col(f"pred_{ch}").cast("double").alias("pred"),
                             (F.col(ch) if ch in pred.columns else F.lit(None)).cast("double").alias("actual")) for ch in channels])
    long = base.select(key, S.WEEK, F.explode(per).alias("c")).select(key, S.WEEK, "c.*")
    ranked = long.groupBy("channel", key).agg(fixed_point_mean("pred").alias("_m"))
    place = F.row_number().over(Window.partitionBy("channel").orderBy(F.desc("_m"), key))
    top = ranked.withColumn("_r", place).where(F.col("_r") <= n).select("channel", key)
    return (long.join(top, ["channel", key], "left_semi").groupBy("channel", key, S.WEEK)
                .agg(fixed_point_mean("pred").alias("mean_pred_rate"), fixed_point_mean("actual").alias("mean_actual_rate")))


def monthly_actual_vs_pred(pred: DataFrame, key: str, n: int = 20, min_units: float = 5_000) -> DataFrame:
    """Plain mean actual and predicted rate and rows per month for the top-n groups by weighted prediction."""
    top = weighted_pred_rate(pred, [key], min_units, n).select(key)
    return (pred.join(top, on=key, how="left_semi").groupBy(key, S.MONTH)
                .agg(fixed_point_mean(ACTUAL).alias("mean_actual"), fixed_point_mean(PRED).alias("mean_pred"), F.count(F.lit(1)).alias("n")))


def weighted_pred_rate(pred: DataFrame, keys: Sequence[str], min_units: float = 0, n: int | None = None,
                       units: str = "units_total") -> DataFrame:
    """sum(pred x units) / sum(units) per key with HAVING and optional top-n."""
    out = (pred.groupBy(*keys).agg(F.sum(units).alias("units"),
                                   F.try_divide(F.sum(F.col(PRED) * F.col(units)), F.sum(units)).alias("weighted_pred"))
               .filter(F.col("units") >= min_units))
    return out.orderBy(F.desc("weighted_pred"), *keys).limit(n) if n else out


def bucket_means(pred: DataFrame, baseline: str = "baseline_rate", deviation: str = "deviation") -> DataFrame:
    """Rows and mean baseline, deviation, full prediction and actual per rate bucket."""
    return pred.groupBy("rate_bucket").agg(
        F.count(F.lit(1)).alias("n"), F.avg(baseline).alias("mean_baseline"), F.avg(deviation).alias("mean_deviation"),
        F.avg(PRED).alias("mean_full"), F.avg(ACTUAL).alias("mean_actual"))


def deviation_quantiles(pred: DataFrame, deviation: str = "deviation", prob: str = "p_nonzero", above: float = 0.5) -> DataFrame:
    """5% / 95% quantiles, mean absolute and mean signed deviation contribution where ``prob`` exceeds ``above``."""
    d, likely = F.col(deviation), pred.filter(F.col(prob) > above)
    q = quantiles(likely, [], deviation, [0.05, 0.95]).select(F.col("q0").alias("q05"), F.col("q1").alias("q95"))
    return q.crossJoin(F.broadcast(likely.agg(F.avg(F.abs(d)).alias("mean_abs"), F.avg(d).alias("mean_signed"))))


def site_deviation(pred: DataFrame, n: int = 5, baseline: str = "baseline_rate", deviation: str = "deviation") -> DataFrame:
    """Mean combined rate, baseline and deviation per site, top-n by mean combined rate."""
    return (pred.groupBy(S.SITE).agg(F.avg(PRED).alias("mean_rate"), F.avg(baseline).alias("mean_baseline"),
                                     F.avg(deviation).alias("mean_deviation"))
                .orderBy(F.desc("mean_rate"), S.SITE).limit(n))


def largest_deviation_site(pred: DataFrame, deviation: str = "deviation") -> DataFrame:
    """The site with the largest mean deviation (smaller key on ties)."""
    per = pred.groupBy(S.SITE).agg(F.avg(deviation).alias("mean_deviation"))
    return per.orderBy(F.desc("mean_deviation"), S.SITE).limit(1)
