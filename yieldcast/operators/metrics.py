"""Evaluation metrics as aggregates (E1-E7); each returns a small DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yieldcast.functions.scalar import sigmoid

SCORE_BUCKETS = 256

# Fixed thresholds of the sweep: 19 evenly spaced points from 0.05 to 0.95
# (start + k * step, with the last point equal to the stop).
_STEP = (0.95 - 0.05) / 18
SWEEP_THRESHOLDS = [0.05 + k * _STEP for k in range(18)] + [0.95]


def regression_metrics(df: DataFrame, pred: str, actual: str) -> DataFrame:
    """N, MAE, RMSE, R^2 = 1 - SSE/SST in one pass; R^2 is null when the target is constant."""
    d = F.col(pred) - F.col(actual)
    sst = F.var_pop(F.when(d.isNotNull(), F.col(actual))) * F.count(d)
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(d)).alias("mae"), F.sqrt(F.avg(d * d)).alias("rmse"),
                  (F.lit(1.0) - F.try_divide(F.sum(d * d), sst)).alias("r2"))


def prob_mae(df: DataFrame, pred_logit: str, actual_logit: str) -> DataFrame:
    """Mean absolute error in probability space of two logit columns."""
    return df.agg(F.avg(F.abs(sigmoid(pred_logit) - sigmoid(actual_logit))).alias("prob_mae"))


def score_table(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score: positives, negatives and the counts strictly below it.

    Distinct scores are cut into value ranges that hold about as many of them
    each (approximate percentiles), so scores that pile up near one value do
    not share a range. A range's window sees its own scores only; the offsets
    are a window over at most SCORE_BUCKETS rows.
    """
    s = F.col(score).cast("double")
    per = (df.select(s.alias("score"), F.col(label).cast("double").alias("_y")).groupBy("score")
             .agg(F.sum("_y").alias("n_pos"), F.sum(1 - F.col("_y")).alias("n_neg")))
    cuts = per.agg(F.percentile_approx("score", [i / SCORE_BUCKETS for i in range(1, SCORE_BUCKETS)], 20_000).alias("_cuts"))
    per_score = (per.crossJoin(F.broadcast(cuts.select(F.array_sort(F.array_distinct("_cuts")).alias("_cuts"))))
                 .select("score", "n_pos", "n_neg", _place(F.col("_cuts"), F.col("score")).alias("_b")))
    per_bucket = per_score.groupBy("_b").agg(F.sum("n_pos").alias("_bp"), F.sum("n_neg").alias("_bn"))
    run = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select("_b", F.coalesce(F.sum("_bp").over(run), F.lit(0.0)).alias("_op"),
                                F.coalesce(F.sum("_bn").over(run), F.lit(0.0)).alias("_on"))
    inner = Window.partitionBy("_b").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    return (per_score.join(offsets, on="_b")
            .select("score", "n_pos", "n_neg",
                    (F.col("_op") + F.coalesce(F.sum("n_pos").over(inner), F.lit(0.0))).alias("pos_below"),
                    (F.col("_on") + F.coalesce(F.sum("n_neg").over(inner), F.lit(0.0))).alias("neg_below")))


def _place(cuts, value):
    """Number of cuts below a value (null: -1)."""
    return F.when(value.isNull(), F.lit(-1)).otherwise(F.size(F.filter(cuts, lambda c: c < value)))


def _totals(t: DataFrame) -> DataFrame:
    return t.agg(F.sum("n_pos").alias("P"), F.sum("n_neg").alias("N"))


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Exact ROC-AUC with ties counted half (average-rank definition); null with one class only."""
    t = score_table(df, score, label)
    return (t.crossJoin(F.broadcast(_totals(t)))
             .agg(F.try_divide(F.sum(F.col("n_pos") * (F.col("neg_below") + 0.5 * F.col("n_neg"))),
                               F.first("P") * F.first("N")).alias("roc_auc")))


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    """Sum over distinct thresholds of (recall step) x precision, highest score first; null without positives."""
    t = score_table(df, score, label)
    tp = F.col("P") - F.col("pos_below")
    fp = F.col("N") - F.col("neg_below")
    return (t.crossJoin(F.broadcast(_totals(t)))
             .agg(F.sum(F.try_divide(F.col("n_pos"), F.col("P")) * tp / (tp + fp)).alias("average_precision")))


def brier(df: DataFrame, prob: str, label: str) -> DataFrame:
    """E5: mean squared error of probabilities."""
    return df.agg(F.avg((F.col(prob) - F.col(label).cast("double")) ** 2).alias("brier"))


def _confusion_aggs(prob: str, label: str, t: float, sfx: str):
    p = F.col(prob) >= F.lit(t)
    y = F.col(label) == 1
    return [F.count_if(p & y).alias(f"tp{sfx}"), F.count_if(p & ~y).alias(f"fp{sfx}"),
            F.count_if(~p & y).alias(f"fn{sfx}"), F.count_if(~p & ~y).alias(f"tn{sfx}")]


def _rates(tp, fp, fn, tn):
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    acc = F.try_divide(tp + tn, tp + fp + fn + tn)
    return prec, rec, f1, acc


def classification_metrics(df: DataFrame, prob: str, label: str, threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall, F1 at one threshold."""
    c = df.agg(*_confusion_aggs(prob, label, threshold, ""))
    prec, rec, f1, acc = _rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return c.select(F.lit(threshold).alias("threshold"), acc.alias("accuracy"), prec.alias("precision"),
                    rec.alias("recall"), f1.alias("f1"))


def threshold_sweep(df: DataFrame, prob: str, label: str, thresholds=SWEEP_THRESHOLDS) -> DataFrame:
    """precision/recall/F1 at 19 thresholds in one pass (no row replication)."""
    aggs = [a for i, t in enumerate(thresholds) for a in _confusion_aggs(prob, label, t, f"_{i}")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"{round(t, 2)!r}D, tp_{i}, fp_{i}, fn_{i}, tn_{i}" for i, t in enumerate(thresholds))
    long = wide.selectExpr(f"stack({len(thresholds)}, {stack}) AS (threshold, tp, fp, fn, tn)")
    prec, rec, f1, acc = _rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return long.select("threshold", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Threshold with the highest F1 (lowest threshold on ties)."""
    return sweep.agg(F.max_by("threshold", F.struct(F.col("f1"), -F.col("threshold"))).alias("best_threshold"),
                     F.max("f1").alias("best_f1"))
