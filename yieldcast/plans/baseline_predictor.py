"""Model-free two-stage predictor from training history, assembled like the model output.

stage 1: P(rate > 0) = the pair's share of non-zero weeks in the training
years (overall share for unseen pairs); stage 2: E(rate | rate > 0) = the
pair's mean positive rate with the GL -> site -> global fallback. It is the
reference point the boosted models must beat, and it makes the report
tables checkable without a model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldcast import schema as S
from yieldcast.functions.scalar import rate_bucket, round_half_away, volume_bucket
from yieldcast.operators import baseline as B
from yieldcast.operators import clean as C

OUT_KEYS = [S.SITE, S.GL, S.YEAR, S.MONTH, S.WEEK]


def baseline_predictions(weekly: DataFrame, train_years: Sequence[int], test_years: Sequence[int],
                         carry: Sequence[str] = ("units_total", "site_type")) -> DataFrame:
    train, test = C.split_by_years(weekly, train_years, test_years)
    nz = (F.col(S.RATE) > 0).cast("double")
    pair_p = train.groupBy(S.SITE, S.GL).agg(F.avg(nz).alias("_pp"))
    glob_p = train.agg(F.avg(nz).alias("_gp"))
    train_nz = C.positive_rate(train)
    filled = B.fill_baseline(B.join_baseline(test, B.site_gl_baseline(train_nz)), B.baseline_priors(train_nz))
    scored = (filled.join(pair_p, on=[S.SITE, S.GL], how="left").crossJoin(F.broadcast(glob_p))
                    .select(*OUT_KEYS, *carry, S.RATE, F.coalesce("_pp", "_gp").alias("_p"),
                            F.col("site_gl_mean_rate").alias("_e")))
    combined = F.col("_p") * F.col("_e")
    return scored.select(
        *OUT_KEYS, *carry, S.RATE,
        round_half_away("_p").alias("p_nonzero"), round_half_away("_e").alias("e_rate"),
        round_half_away(combined).alias("combined_rate"),
        round_half_away(F.abs(combined - F.col(S.RATE))).alias("abs_err"),
        round_half_away("_e").alias("baseline_rate"),
        round_half_away(combined - F.col("_e")).alias("deviation"),
        rate_bucket(S.RATE).alias("rate_bucket"), volume_bucket("units_total").alias("volume_bucket"))
