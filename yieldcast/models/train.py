"""Three-stage training.

stage 1  P(rate > 0)                log loss, positives weighted n_neg/n_pos
stage 2  E(rate | rate > 0)         squared error of logit(rate), band weights,
                                    site x GL baseline features (5% of pairs held out)
stage 3  split over five channels   one model per channel, squared error of logit(channel / rate)

The last training year chooses the number of rounds: training ends when the validation loss (log loss, or the mean absolute error of the rate)
has not fallen for 50 rounds, and the best round counts. With ``refit`` the model is then fitted on all training years for that many rounds.
Test years are never seen. A stage's rows are binned and written once (``prepare``); all rounds, the refit, all channels and all trials of a search
read the same blocks. Baseline columns stand in them twice, under ``__early`` as known before the validation years.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldcast import schema as S
from yieldcast.functions.scalar import clipped_logit, sample_weight
from yieldcast.models import booster as BO
from yieldcast.models import features as MF
from yieldcast.models.binning import MAX_BINS, Binning, binned_blocks, fit_binning
from yieldcast.operators import baseline as B
from yieldcast.operators import clean as C
from yieldcast.session import checkpoint_dir, ship_package
from yieldcast.sources.stage import commit, delete, publish

# ---------------------------------------------------------------------------
# Default parameters per stage and per channel
# ---------------------------------------------------------------------------

DEFAULT_CLF_PARAMS = {"max_depth": 6, "learning_rate": 0.05, "subsample": 0.8, "colsample_bytree": 0.8,
                      "min_child_weight": 5, "gamma": 0.1, "reg_alpha": 0.01, "reg_lambda": 1.0,
                      "max_delta_step": 0}
DEFAULT_REG_PARAMS = {"max_depth": 6, "learning_rate": 0.05, "subsample": 0.8, "colsample_bytree": 0.8,
                      "min_child_weight": 5, "gamma": 0.1, "reg_alpha": 0.01, "reg_lambda": 1.0}
DEFAULT_CHANNEL_PARAMS = {
    "prob_donations": {"max_depth": 8, "learning_rate": 0.010233524192808544, "subsample": 0.6618100158148682,
                       "colsample_bytree": 0.4103116901613753, "min_child_weight": 29, "gamma": 2.1717813587820562,
                       "reg_alpha": 7.587120682342036, "reg_lambda": 1.2536269325652274e-08},
    "prob_liquidations": {"max_depth": 8, "learning_rate": 0.10154216570970824, "subsample": 0.8222127978469346,
                          "colsample_bytree": 0.49571853898410817, "min_child_weight": 22,
                          "gamma": 0.033121217751713956, "reg_alpha": 0.00014422243561458065,
                          "reg_lambda": 0.03187847480686257},
    "prob_return_to_vendor": {"max_depth": 8, "learning_rate": 0.1943881912272435, "subsample": 0.9182630131548245,
                              "colsample_bytree": 0.40022527720500706, "min_child_weight": 17,
                              "gamma": 2.5072850771118342, "reg_alpha": 9.113338418294182e-07,
                              "reg_lambda": 0.05392398582308144},
    "prob_warehouse_deals_and_gr": {"max_depth": 6, "learning_rate": 0.10597071455010725,
                                    "subsample": 0.7774552662295606, "colsample_bytree": 0.40043799848796335,
                                    "min_child_weight": 41, "gamma": 2.9575883549786286,
                                    "reg_alpha": 0.0008500602063823264, "reg_lambda": 0.105063075386338},
    "prob_disposal": {"max_depth": 8, "learning_rate": 0.10303364894496688, "subsample": 0.7949352732615969,
                      "colsample_bytree": 0.4266733762096135, "min_child_weight": 27, "gamma": 1.9174437521560582,
                      "reg_alpha": 1.8970289690794687, "reg_lambda": 0.047716386888},
}
MAX_ROUNDS = 2000
PATIENCE = 50            # rounds without a better validation loss that end training
EARLY = "__early"        # baseline columns as known before the validation years


@dataclass
class StageModel:
    """A fitted stage: trees over binned features, and lookup tables."""
    ensemble: BO.Ensemble
    params: dict
    lookups: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def nums(self) -> list[str]:
        return self.ensemble.binning.nums

    @property
    def cats(self) -> list[str]:
        return self.ensemble.binning.cats

    @property
    def rounds(self) -> int:
        return len(self.ensemble.trees)

    def margin(self, df: DataFrame):
        """The raw margin as a column over a frame with the model's features."""
        return self.ensemble.column(df)

    def save(self, path: str) -> None:
        """Tree nodes and lookups as parquet, the rest as JSON; the folder appears whole, by a rename."""
        spark = SparkSession.getActiveSession()
        e = self.ensemble
        nodes = [(t, i, int(tree.feature[i]), int(tree.left[i]), int(tree.right[i]), bytearray(tree.side[i].tobytes()), float(tree.value[i]),
                  float(tree.cover[i]), float(tree.gain[i])) for t, tree in enumerate(e.trees) for i in range(len(tree.feature))]
        meta = json.dumps({"binning": vars(e.binning), "base": e.base, "objective": e.objective, "history": e.history, "params": self.params,
                           "lookups": sorted(self.lookups), "rounds": len(e.trees)})

        def write(to: str) -> None:
            spark.createDataFrame(nodes, NODE).coalesce(1).write.parquet(f"{to}/trees")
            for name, df in self.lookups.items():
                df.write.parquet(f"{to}/lookup_{name}")
            spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.text(f"{to}/meta")
            commit(spark, to)

        publish(spark, path, write)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "StageModel":
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        if not {"binning", "objective", "rounds"} <= set(meta):
            raise TypeError(f"expected a stage model at {path}")
        binning = Binning(**meta["binning"])
        table = spark.read.schema(NODE).parquet(f"{path}/trees").toPandas().sort_values(["tree", "node"])
        trees = [BO.Tree(*(part[c].to_numpy(np.int32) for c in ("feature", "left", "right")),
                         np.stack([np.frombuffer(b, dtype=bool) for b in part["side"]]), *(part[c].to_numpy(np.float64) for c in ("value", "cover", "gain")))
                 for _, part in table.groupby("tree", sort=True)]
        if len(trees) != meta["rounds"]:
            raise ValueError(f"{path} holds {len(trees)} of {meta['rounds']} trees")
        lookups = {n: spark.read.parquet(f"{path}/lookup_{n}") for n in meta["lookups"]}
        return StageModel(BO.Ensemble(binning, trees, meta["base"], meta["objective"], meta["history"]), meta["params"], lookups)


NODE = "tree int, node int, feature int, left int, right int, side binary, value double, cover double, gain double"


# ---------------------------------------------------------------------------
# Prepared rows of a stage
# ---------------------------------------------------------------------------

@dataclass
class Prepared:
    """Binned blocks of a stage's rows, ready for any number of fits."""
    spark: SparkSession
    binning: Binning
    blocks: RDD
    path: str
    objective: str
    early: list[str] = field(default_factory=list)      # baseline columns that stand twice

    def __enter__(self) -> "Prepared":
        return self

    def __exit__(self, *_) -> None:
        self.blocks.unpersist()
        delete(self.spark, self.path)

    def features(self, names: Sequence[str], final: bool) -> list[int]:
        """Places of the named features; baseline columns as known early, or for the ``final`` fit."""
        at = {n: i for i, n in enumerate(self.binning.names)}
        return [at[n + EARLY if n in self.early and not final else n] for n in names]

    def boost(self, names: Sequence[str], params: dict, rounds: int, patience: int | None = PATIENCE, target: int = 0, final: bool = False,
              watch=None) -> BO.Ensemble:
        features = self.features(names, final)
        fitted = BO.boost(self.blocks, self.binning, self.objective, params, rounds, None if final else patience, target, features, S.SEED, final, watch)
        return fitted.narrowed(features, names)

    def fit(self, names: Sequence[str], params: dict, rounds: int, target: int = 0, refit: bool = True) -> BO.Ensemble:
        """Rounds chosen on the validation rows; with ``refit`` fitted again on all rows for that many (one at least)."""
        chosen = self.boost(names, params, rounds, target=target)
        if not refit:
            return chosen
        final = self.boost(names, params, max(1, len(chosen.trees)), target=target, final=True)
        final.history = chosen.history
        return final


def prepare(df: DataFrame, nums: Sequence[str], cats: Sequence[str], labels: Sequence[str], objective: str, weights: Sequence[str] = (),
            valid: str = "is_valid", early: Sequence[str] = (), max_bins: int = MAX_BINS, cells: int = BO.CELLS) -> Prepared:
    """Bin a stage's rows and write them as blocks, read in partitions of about ``cells`` codes. Cut points come from the fitted rows, categories from all."""
    spark = df.sparkSession
    ship_package(spark)
    columns = list(dict.fromkeys([*nums, *cats, *labels, *weights, valid]))
    narrow = df.select(*columns).persist()
    try:
        binning = fit_binning(narrow.where(~F.col(valid)), nums, [], max_bins)
        known = fit_binning(narrow, [], cats)
        binning = Binning(binning.nums, binning.cuts, known.cats, known.levels)
        path = f"{checkpoint_dir(spark)}/blocks-{uuid.uuid4().hex}"
        binned_blocks(narrow.repartition(spark.sparkContext.defaultParallelism), binning, labels, weights, valid).write.parquet(path)
    finally:
        narrow.unpersist()
    blocks = BO.as_blocks(spark.read.parquet(path), binning, len(labels), cells)
    return Prepared(spark, binning, blocks, path, objective, list(early))


def with_validation_flag(df: DataFrame, valid_years: Sequence[int]) -> DataFrame:
    return df.withColumn("is_valid", F.col(S.YEAR).isin(list(valid_years)))


# ---------------------------------------------------------------------------
# Stage 1
# ---------------------------------------------------------------------------

def prepare_stage1(df_train: DataFrame, valid_years: Sequence[int]) -> tuple[Prepared, list[str]]:
    data = df_train.withColumn("label", C.binary_label())
    B.require_positives(data)
    data = with_validation_flag(B.with_class_weight(data, "label", "weight"), valid_years)
    nums, cats = MF.numeric_and_categorical(MF.STAGE1_FEATURES, data.columns)
    return prepare(data, nums, cats, ["label"], "logistic", ["weight"]), [*nums, *cats]


def train_stage1(df_train: DataFrame, valid_years: Sequence[int], params: dict | None = None,
                 max_iter: int = MAX_ROUNDS, refit: bool = True) -> StageModel:
    """Class-weighted boosted classifier of P(rate > 0).

    The validation years choose the number of rounds; with ``refit`` the model is then fitted on all years.
    """
    params = dict(DEFAULT_CLF_PARAMS if params is None else params)
    prepared, names = prepare_stage1(df_train, valid_years)
    with prepared:
        return StageModel(prepared.fit(names, params, max_iter, refit=refit), params)


# ---------------------------------------------------------------------------
# Stage 2
# ---------------------------------------------------------------------------

def stage2_baselines(df_train_nz: DataFrame, holdout_fraction: float = S.HOLDOUT_FRACTION,
                     seed: int = S.SEED):
    bl = B.site_gl_baseline(df_train_nz)
    pri = B.baseline_priors(df_train_nz)
    seen = B.remove_pairs(bl, B.holdout_pairs(bl, holdout_fraction, seed))
    return bl, seen, pri


def stage2_data(nz: DataFrame, valid_years: Sequence[int], holdout_fraction: float = S.HOLDOUT_FRACTION) -> tuple[DataFrame, DataFrame, dict]:
    """Stage 2 rows with label, weight, is_valid and both sets of baseline columns; the full baseline and the priors.

    Early columns come from the years before validation: fitted rows see them without the held-out pairs, validation rows see all.
    Final ones come from all years without the held-out pairs. All are worked out per pair; the wide rows are joined once.
    """
    nz = with_validation_flag(nz, valid_years)
    bl0, seen0, pri0 = stage2_baselines(nz.filter(~F.col("is_valid")), holdout_fraction)
    bl, seen, pri = stage2_baselines(nz, holdout_fraction)
    pairs = nz.select(*B.PAIR).distinct()

    def filled(table, priors, tag):
        out = B.fill_baseline(B.join_baseline(pairs, table), priors)
        return out.select(*B.PAIR, *[F.col(c).alias(f"{c}__{tag}") for c in MF.STAGE2_BASELINE])

    looked = B.join_pairs(B.join_pairs(filled(seen, pri, "final"), filled(seen0, pri0, "fit")), filled(bl0, pri0, "held"))
    wide = B.join_pairs(nz, looked)
    columns = [F.col(f"{c}__final").alias(c) for c in MF.STAGE2_BASELINE]
    columns += [F.when(F.col("is_valid"), F.col(f"{c}__held")).otherwise(F.col(f"{c}__fit")).alias(c + EARLY) for c in MF.STAGE2_BASELINE]
    data = wide.select(*nz.columns, *columns, clipped_logit(S.RATE, S.LOGIT_EPS_STAGE2).alias("label"), sample_weight(S.RATE).alias("weight"))
    return data, bl, pri


def prepare_stage2(df_train: DataFrame, valid_years: Sequence[int], holdout_fraction: float = S.HOLDOUT_FRACTION):
    data, bl, pri = stage2_data(C.positive_rate(df_train), valid_years, holdout_fraction)
    nums, cats = MF.numeric_and_categorical(MF.STAGE2_FEATURES, data.columns)
    extra = [c + EARLY for c in MF.STAGE2_BASELINE]
    return prepare(data, [*nums, *extra], cats, ["label"], "squared", ["weight"], early=MF.STAGE2_BASELINE), [*nums, *cats], bl, pri


def train_stage2(df_train: DataFrame, valid_years: Sequence[int], params: dict | None = None,
                 max_iter: int = MAX_ROUNDS, holdout_fraction: float = S.HOLDOUT_FRACTION, refit: bool = True) -> StageModel:
    """Boosted regressor on logit(rate) over positive rows, band weights, baseline features.

    The validation years choose the number of rounds; with ``refit`` the model is then fitted on all
    years, with baselines of all years (which scoring looks up).
    """
    params = dict(DEFAULT_REG_PARAMS if params is None else params)
    prepared, names, bl, pri = prepare_stage2(df_train, valid_years, holdout_fraction)
    with prepared:
        fitted = prepared.fit(names, params, max_iter, refit=refit)
    return StageModel(fitted, params, {"site_gl_baseline": bl, **{f"prior_{k}": v for k, v in pri.items()}})


# ---------------------------------------------------------------------------
# Stage 3
# ---------------------------------------------------------------------------

def channel_baseline_cols(channel: str) -> list[str]:
    return [f"{c}__{channel}" for c in MF.STAGE3_BASELINE]


def share_baselines_long(df_train_nz: DataFrame, channels: Sequence[str] = MF.STAGE3_CHANNELS) -> DataFrame:
    """A11 for all channels in one pass: (channel, site, GL, mean, std, count)."""
    pairs = ", ".join(f"'{ch}', {ch} / {S.RATE}" for ch in channels)
    long = df_train_nz.selectExpr(S.SITE, S.GL, f"stack({len(channels)}, {pairs}) AS (channel, _share)")
    s = F.col("_share")
    return long.groupBy("channel", S.SITE, S.GL).agg(
        F.avg(s).alias("baseline_share_mean"), F.stddev_samp(s).alias("baseline_share_std"),
        F.count(s).alias("baseline_share_count"))


def share_baselines_wide(long: DataFrame, channels: Sequence[str] = MF.STAGE3_CHANNELS) -> DataFrame:
    """One row per (site, GL) with the baselines of all channels."""
    wide = long.groupBy(S.SITE, S.GL).pivot("channel", list(channels)).agg(
        *[F.first(c).alias(c) for c in MF.STAGE3_BASELINE])
    return wide.select(S.SITE, S.GL, *[F.col(f"`{ch}_{c}`").alias(f"{c}__{ch}")
                                            for ch in channels for c in MF.STAGE3_BASELINE])


def join_share_baselines(df: DataFrame, long: DataFrame, channels: Sequence[str] = MF.STAGE3_CHANNELS) -> DataFrame:
    """One join of the channel baselines; missing -> 0."""
    out = B.join_pairs(df, share_baselines_wide(long, channels))
    return out.fillna(0.0, subset=[c for ch in channels for c in channel_baseline_cols(ch)])


def prepare_stage3(df_train: DataFrame, valid_years: Sequence[int], channels: Sequence[str] = MF.STAGE3_CHANNELS):
    """One set of blocks for all channels: a label per channel, early and final share baselines of each."""
    nz = with_validation_flag(C.positive_rate(df_train), valid_years)
    long = share_baselines_long(nz, channels)
    early = share_baselines_long(nz.filter(~F.col("is_valid")), channels)
    every = [c for ch in channels for c in channel_baseline_cols(ch)]
    before = share_baselines_wide(early, channels).select(*B.PAIR, *[F.col(c).alias(c + EARLY) for c in every])
    looked = share_baselines_wide(long, channels).join(before, B.PAIR, "left")
    data = B.join_pairs(nz, looked).fillna(0.0, subset=every + [c + EARLY for c in every])
    share = [clipped_logit(F.coalesce(F.col(ch) / F.col(S.RATE), F.lit(0.0)), S.LOGIT_EPS_STAGE3).alias(f"label_{ch}") for ch in channels]
    data = data.select("*", *share)
    nums, cats = MF.numeric_and_categorical(MF.STAGE1_FEATURES + MF.STAGE3_EXTRA, data.columns)
    prepared = prepare(data, [*nums, *every, *[c + EARLY for c in every]], cats, [f"label_{ch}" for ch in channels], "squared", early=every)
    return prepared, {ch: [*nums, *channel_baseline_cols(ch), *cats] for ch in channels}, long


def train_stage3(df_train: DataFrame, valid_years: Sequence[int], params: dict | None = None,
                 max_iter: int = MAX_ROUNDS, channels: Sequence[str] = MF.STAGE3_CHANNELS,
                 parallelism: int = 5, refit: bool = True) -> dict[str, StageModel]:
    """T4: one boosted regressor per channel on logit(share), fitted concurrently on one set of blocks.

    Share baselines of the rounds-choosing fit come from the years before validation; with ``refit``
    each channel is then fitted on all years with their baselines (which scoring looks up).
    """
    prepared, names, long = prepare_stage3(df_train, valid_years, channels)

    def fit_one(k_ch):
        k, ch = k_ch
        p = dict(DEFAULT_CHANNEL_PARAMS.get(ch, DEFAULT_REG_PARAMS) if params is None else params)
        return ch, StageModel(prepared.fit(names[ch], p, max_iter, target=k, refit=refit), p, {"share_baseline": long})

    with prepared, ThreadPoolExecutor(max_workers=parallelism) as pool:
        return dict(pool.map(fit_one, enumerate(channels)))


def train_all(df_train: DataFrame, valid_years: Sequence[int], channels: bool = True, max_iter: int = MAX_ROUNDS):
    """All stages with their defaults, fitted side by side: (stage 1, stage 2, stage 3 or None)."""
    jobs = [lambda: train_stage1(df_train, valid_years, max_iter=max_iter), lambda: train_stage2(df_train, valid_years, max_iter=max_iter)]
    if channels:
        jobs.append(lambda: train_stage3(df_train, valid_years, max_iter=max_iter))
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        done = [j.result() for j in [pool.submit(job) for job in jobs]]
    return (*done, None)[:3]
