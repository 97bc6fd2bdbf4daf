"""Entry 1: the full pipeline as stage tables under one output folder.

load raw files -> feature table (stage) -> train three stages (saved models)
-> predictions for the scoring scope (stage) -> report tables (parquet).
Each stage is read back when it already exists, so a rerun after a failure
resumes at the first missing stage, and every later stage starts from a
stored table rather than a long lineage.

    spark-submit --py-files yieldcast.zip -m yieldcast.plans.pipeline \\
        --raw s3a://bucket/raw/*.csv --out s3a://bucket/recovery
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldcast import schema as S
from yieldcast.models import score as SC
from yieldcast.models import train as T
from yieldcast.operators import clean as C
from yieldcast.operators import report as R
from yieldcast.plans.features import feature_table
from yieldcast.sources.files import load
from yieldcast.sources.stage import exists, stage_table


def report_tables(predictions: DataFrame, top_n: int = 5) -> dict[str, DataFrame]:
    """The report's tables; those of a channel or of attributions only where the predictions hold them."""
    out = {
        "overall_mae": R.overall_mae(predictions),
        "mae_by_rate_bucket": R.mae_by_bucket(predictions, "rate_bucket"),
        "mae_by_volume_bucket": R.mae_by_bucket(predictions, "volume_bucket"),
        "top_gl": R.top_groups(predictions, S.GL),
        "top_sites": R.top_groups(predictions, S.SITE),
        "always_full_gls": R.always_full_groups(predictions, S.GL),
        "always_full_sites": R.always_full_groups(predictions, S.SITE),
        "monthly_gl": R.monthly_actual_vs_pred(predictions, S.GL),
        "monthly_sites": R.monthly_actual_vs_pred(predictions, S.SITE),
        "weekly_trend_gl": R.weekly_trend(predictions, S.GL, top_n),
        "weekly_trend_sites": R.weekly_trend(predictions, S.SITE, top_n),
    }
    channels = [ch for ch in T.MF.STAGE3_CHANNELS if f"pred_{ch}" in predictions.columns]
    if channels:
        out["channel_trend_gl"] = R.channel_trends(predictions, S.GL, channels, top_n)
        out["channel_trend_sites"] = R.channel_trends(predictions, S.SITE, channels, top_n)
    if "shap_baseline_rate" in predictions.columns:
        base, dev = "shap_baseline_rate", "shap_deviation_contribution"
        explained = predictions.where(F.col(base).isNotNull())
        out["attribution_by_bucket"] = R.bucket_means(explained, base, dev)
        out["deviation_quantiles"] = R.deviation_quantiles(explained, dev)
        out["attribution_by_site"] = R.site_deviation(explained, top_n, base, dev)
        out["largest_deviation_site"] = R.largest_deviation_site(explained, dev)
    return out


def run(spark: SparkSession, raw_paths: Sequence[str], out: str, train_years: Sequence[int],
        valid_years: Sequence[int], test_years: Sequence[int], max_rounds: int = T.MAX_ROUNDS,
        channels: bool = True, explain: bool = True, explain_rows: int | None = None) -> dict[str, DataFrame]:
    features = stage_table(spark, f"{out}/features", lambda: feature_table(load(spark, list(raw_paths))))
    train, _ = C.split_by_years(features, train_years, test_years)

    def model(name: str, fit) -> T.StageModel:
        path = f"{out}/models/{name}"
        if not exists(spark, path):
            fit().save(path)
        return T.StageModel.load(spark, path)

    m1 = model("stage1", lambda: T.train_stage1(train, valid_years, max_iter=max_rounds))
    m2 = model("stage2", lambda: T.train_stage2(train, valid_years, max_iter=max_rounds))
    m3 = None
    if channels:
        missing = [ch for ch in T.MF.STAGE3_CHANNELS if not exists(spark, f"{out}/models/stage3_{ch}")]
        fitted = T.train_stage3(train, valid_years, max_iter=max_rounds, channels=missing) if missing else {}
        m3 = {ch: model(f"stage3_{ch}", lambda ch=ch: fitted[ch]) for ch in T.MF.STAGE3_CHANNELS}
    predictions = stage_table(spark, f"{out}/predictions", lambda: SC.predict(
        m1, m2, features, m3, years=list(test_years), explain=explain, explain_rows=explain_rows))
    tables = {}
    for name, df in report_tables(predictions).items():
        tables[name] = stage_table(spark, f"{out}/report/{name}", lambda df=df: df, partition_by=None)
    return {"features": features, "predictions": predictions, **tables}


def main(argv: Sequence[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--raw", nargs="+", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--train-years", nargs="+", type=int, required=True)
    ap.add_argument("--valid-years", nargs="+", type=int, required=True)
    ap.add_argument("--test-years", nargs="+", type=int, required=True)
    ap.add_argument("--max-rounds", type=int, default=T.MAX_ROUNDS)
    args = ap.parse_args(argv)
    from yieldcast.session import build_session
    spark = build_session()
    run(spark, args.raw, args.out, args.train_years, args.valid_years, args.test_years, args.max_rounds)


if __name__ == "__main__":
    main()
