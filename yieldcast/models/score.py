"""Scoring and output assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldcast import schema as S
from yieldcast.functions.scalar import rate_bucket, round_half_away, sigmoid, volume_bucket
from yieldcast.models.train import StageModel, channel_baseline_cols, join_share_baselines
from yieldcast.operators import baseline as B
from yieldcast.operators import clean as C

ROW_KEYS = [S.SITE, S.GL, S.YEAR, S.MONTH, S.WEEK]


def score_stage1(m: StageModel, df: DataFrame) -> DataFrame:
    """p_nonzero = P(class 1)."""
    return df.withColumn("p_nonzero", sigmoid(m.margin(df)))


def with_stage2_baselines(m: StageModel, df: DataFrame, min_support: int | None = None) -> DataFrame:
    """The baseline columns of stage 2 (J2, J3, optionally C5), by one join of the wide rows."""
    pri = {k: m.lookups[f"prior_{k}"] for k in ("gl", "site", "global")}
    return B.with_baselines(df, m.lookups["site_gl_baseline"], pri, min_support)


def score_stage2(m: StageModel, df: DataFrame, min_support: int | None = None) -> DataFrame:
    """Baseline join + GL/site/global fill (optionally C5 shrinkage), e_rate = clip(sigmoid)."""
    ext = with_stage2_baselines(m, df, min_support)
    return ext.withColumn("e_rate", sigmoid(m.margin(ext), clip=True))


def normalise_channels(df: DataFrame, channels: Sequence[str], combined: str = "combined_rate") -> DataFrame:
    """C4: sigmoid of each ``raw_`` margin, divided by their row sum (0 counts as 1), times the combined rate, as ``pred_`` columns."""
    raw = {ch: sigmoid(f"raw_{ch}") for ch in channels}
    total = sum(raw.values(), F.lit(0.0))
    denom = F.when(total == 0, F.lit(1.0)).otherwise(total)
    out = df.select("*", *[(raw[ch] / denom * F.col(combined)).alias(f"pred_{ch}") for ch in channels])
    return out.drop(*[f"raw_{ch}" for ch in channels])


def score_stage3(models: dict[str, StageModel], df: DataFrame, combined: str = "combined_rate") -> DataFrame:
    """C4: all channel models in one pass over one join of the share baselines."""
    channels = list(models)
    long = next(m.lookups["share_baseline"] for m in models.values() if "share_baseline" in m.lookups)
    data = join_share_baselines(df, long, channels)
    data = data.select("*", *[models[ch].margin(data).alias(f"raw_{ch}") for ch in channels])
    return normalise_channels(data, channels, combined).drop(*[c for ch in channels for c in channel_baseline_cols(ch)])


def predict(stage1: StageModel, stage2: StageModel, df: DataFrame,
            stage3: dict[str, StageModel] | None = None, years: Sequence[int] | None = None,
            sites=None, gl_groups=None, weeks=None, min_support: int | None = None,
            explain: bool = False, explain_rows: int | None = None, seed: int = S.SEED) -> DataFrame:
    """Entry 3: scope -> stage 1 -> stage 2 -> combined -> stage 3 -> attributions -> assembly.

    With ``explain`` every row (or a seeded sample of ``explain_rows``) gets its baseline rate and deviation (C7, C8); other rows have
    nulls there. Attributions are worked out in the row, so nothing is joined back.
    """
    scoped = C.prediction_scope(df, years, sites, gl_groups, weeks)
    s = score_stage2(stage2, score_stage1(stage1, scoped), min_support)
    s = s.withColumn("combined_rate", F.col("p_nonzero") * F.col("e_rate"))
    if stage3:
        s = score_stage3(stage3, s)
    if explain:
        from yieldcast.models import attribution as AT
        picked = F.lit(True)
        if explain_rows is not None:
            s = B.mark_sample(s, explain_rows, ROW_KEYS, seed)
            picked = F.col("_picked")
        parts = AT.decomposition(stage2, s, picked)
        s = s.withColumn("_parts", parts).select("*", F.col("_parts.baseline_rate").alias("shap_baseline_rate"),
                                                  F.col("_parts.deviation_contribution").alias("shap_deviation_contribution"))
    return assemble(s, list(stage3) if stage3 else [])


def assemble(s: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Ids, month and units, actual -> predicted -> abs error per group, attributions, buckets; works without ground truth."""
    has_gt = S.RATE in s.columns
    cols = [F.col(c) for c in ROW_KEYS] + [F.col("units_total")]
    if has_gt:
        cols.append(F.col(S.RATE))
    cols += [round_half_away(c).alias(c) for c in ("p_nonzero", "e_rate", "combined_rate")]
    if has_gt:
        cols.append(round_half_away(F.abs(F.col("combined_rate") - F.col(S.RATE))).alias("abs_err"))
    for ch in channels:
        if has_gt and ch in s.columns:
            cols += [F.col(ch), round_half_away(f"pred_{ch}").alias(f"pred_{ch}"),
                     round_half_away(F.abs(F.col(f"pred_{ch}") - F.col(ch))).alias(f"abs_err_{ch}")]
        else:
            cols.append(round_half_away(f"pred_{ch}").alias(f"pred_{ch}"))
    cols += [round_half_away(c).alias(c) for c in ("shap_baseline_rate", "shap_deviation_contribution") if c in s.columns]
    rate = F.col(S.RATE) if has_gt else F.col("combined_rate")
    cols += [rate_bucket(rate).alias("rate_bucket"), volume_bucket("units_total").alias("volume_bucket")]
    return s.select(*cols)
