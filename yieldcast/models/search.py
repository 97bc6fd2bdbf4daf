"""Parameter search over prepared blocks.

Trials are drawn by tree-structured Parzen estimators (Bergstra et al., 2011, "Algorithms for hyper-parameter optimization"): past trials are parted
into the better and the others, both get a density per parameter, and of some draws from the better one's that with the largest ratio
is tried. A trial ends early when its validation loss lies above the median of earlier trials at the same round. All trials read the
same blocks; a study ends after ``n_trials`` or when its time is used up.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldcast import schema as S
from yieldcast.models import booster as BO
from yieldcast.models import features as MF
from yieldcast.models import train as T
from yieldcast.operators import metrics as M

# ---------------------------------------------------------------------------
# Ranges (low, high, log scale, whole numbers) and budget of a study
# ---------------------------------------------------------------------------

SPACE = {
    "max_depth": (3, 8, False, True),
    "learning_rate": (0.01, 0.3, True, False),
    "subsample": (0.5, 1.0, False, False),
    "colsample_bytree": (0.4, 1.0, False, False),
    "min_child_weight": (1, 50, False, True),
    "gamma": (0.0, 5.0, False, False),
    "reg_alpha": (1e-8, 10.0, True, False),
    "reg_lambda": (1e-8, 10.0, True, False),
}
CLASSIFIER_SPACE = SPACE | {"max_delta_step": (0, 10, False, True)}
TRIALS, CHANNEL_TRIALS = 50, 20
SECONDS = 21_600
ROUNDS, PATIENCE = 500, 30
STARTUP_TRIALS, WARMUP_ROUNDS, PRUNE_EVERY = 5, 10, 5
RANDOM_TRIALS, CANDIDATES = 10, 24


# ---------------------------------------------------------------------------
# Sampler and pruner
# ---------------------------------------------------------------------------

def _inner(value: float, spec: tuple) -> float:
    """A parameter on the scale where its density is estimated: 0 at the low end, 1 at the high end."""
    lo, hi, log, _ = spec
    return (math.log(value) - math.log(lo)) / (math.log(hi) - math.log(lo)) if log else (value - lo) / (hi - lo)


def _outer(x: float, spec: tuple):
    lo, hi, log, whole = spec
    x = min(max(x, 0.0), 1.0)
    v = math.exp(math.log(lo) + x * (math.log(hi) - math.log(lo))) if log else lo + x * (hi - lo)
    return int(min(max(round(v), lo), hi)) if whole else float(min(max(v, lo), hi))


class Density:
    """Parzen estimate on [0, 1]: a normal kernel at every point, as wide as the gap to its neighbours, and a wide one in the middle."""

    def __init__(self, points: Sequence[float]):
        at = np.sort(np.append(np.asarray(points, dtype=float), 0.5))
        edges = np.concatenate([[0.0], at, [1.0]])
        gap = np.maximum(edges[1:-1] - edges[:-2], edges[2:] - edges[1:-1])
        self.at = at
        self.width = np.clip(gap, 1.0 / min(100, len(at) + 1), 1.0)
        self.width[int(np.searchsorted(at, 0.5))] = 1.0

    def draw(self, rng, n: int) -> np.ndarray:
        k = rng.integers(0, len(self.at), n)
        return np.clip(rng.normal(self.at[k], self.width[k]), 0.0, 1.0)

    def log(self, x: np.ndarray) -> np.ndarray:
        z = (x[:, None] - self.at) / self.width
        return np.log(np.maximum((np.exp(-0.5 * z * z) / self.width).mean(axis=1), 1e-300))


def propose(done: list[tuple[dict, float]], space: dict, seed: int) -> dict:
    """The next trial's parameters from (parameters, value to minimise) of the trials so far; the first ones are uniform draws."""
    rng = np.random.default_rng([seed, len(done)])
    if len(done) < RANDOM_TRIALS:
        return {k: _outer(float(rng.uniform()), spec) for k, spec in space.items()}
    ranked = sorted(done, key=lambda t: t[1])
    cut = min(25, math.ceil(0.1 * len(ranked)))
    out = {}
    for k, spec in space.items():
        good, rest = (Density([_inner(p[k], spec) for p, _ in part]) for part in (ranked[:cut], ranked[cut:]))
        x = good.draw(rng, CANDIDATES)
        out[k] = _outer(float(x[np.argmax(good.log(x) - rest.log(x))]), spec)
    return out


@dataclass
class Pruner:
    """Ends a trial whose best loss so far is worse than the median of the earlier trials' best at the same round."""
    curves: list[list[float]] = field(default_factory=list)

    def worse(self, losses: list[float]) -> bool:
        round_ = len(losses) - 1
        if round_ < WARMUP_ROUNDS or (round_ - WARMUP_ROUNDS) % PRUNE_EVERY or len(self.curves) < STARTUP_TRIALS:
            return False
        others = [min(c[:round_ + 1]) for c in self.curves if len(c) > round_]
        return bool(others) and min(losses) > float(np.median(others))


# ---------------------------------------------------------------------------
# A study
# ---------------------------------------------------------------------------

TRIAL = "trial int, value double, rounds int, state string, params string"


def study(fit: Callable[[dict, Callable], BO.Ensemble], value: Callable[[BO.Ensemble], float], space: dict, n_trials: int = TRIALS,
          seconds: float = SECONDS, seed: int = S.SEED) -> list[tuple]:
    """Run trials one after another: (trial, value to minimise, rounds, complete or pruned, parameters as JSON).

    ``fit(params, watch)`` returns an early-stopped model and calls watch(round, loss) after each round; the running trial ends when the time is used up.
    A first trial is always finished.
    """
    start, done, rows, pruner = time.monotonic(), [], [], Pruner()
    for trial in range(n_trials):
        late = bool(rows) and time.monotonic() - start > seconds
        if late:
            break
        params, losses, state = propose(done, space, seed), [], {"pruned": False, "late": False}

        def watch(round_, loss):
            losses.append(loss)
            state["pruned"] = pruner.worse(losses)
            state["late"] = bool(rows) and time.monotonic() - start > seconds
            return state["pruned"] or state["late"]

        model = fit(params, watch)
        got = value(model)
        pruner.curves.append(losses)
        done.append((params, got))
        name = "pruned" if state["pruned"] else "out of time" if state["late"] else "complete"
        rows.append((trial, float(got), len(model.trees), name, json.dumps(params, sort_keys=True)))
    return rows


def _average_precision(prepared: T.Prepared, names: Sequence[str], final: bool = False) -> Callable[[BO.Ensemble], float]:
    """Average precision of the validation rows, negative for a study that minimises."""
    features = prepared.features(names, final)

    def value(model: BO.Ensemble) -> float:
        scored = prepared.blocks.flatMap(lambda b: zip(model.margin(b["codes"][features][:, b["valid"]]).tolist(), b["y"][0][b["valid"]].tolist()))
        rows = prepared.spark.createDataFrame(scored, "score double, label double")
        got = M.average_precision(rows, "score", "label").first()[0]
        return -float(got) if got is not None else 0.0

    return value


def _least_loss(model: BO.Ensemble) -> float:
    return float(np.nanmin(model.history)) if len(model.history) else float("inf")


def _table(spark: SparkSession, rows: list[tuple], schema: str, dump_to: str | None) -> DataFrame:
    table = spark.createDataFrame(rows, schema)
    if dump_to:
        from yieldcast.sources.files import write_json
        write_json(table, dump_to)
    return table


def search_stage1(df_train: DataFrame, valid_years: Sequence[int], n_trials: int = TRIALS, seconds: float = SECONDS, max_rounds: int = ROUNDS,
                  seed: int = S.SEED, dump_to: str | None = None) -> DataFrame:
    """Trial table of stage 1, best average precision of the validation years first (S9: ``dump_to`` writes it as JSON)."""
    prepared, names = T.prepare_stage1(df_train, valid_years)
    with prepared:
        rows = study(lambda p, watch: prepared.boost(names, p, max_rounds, PATIENCE, watch=watch), _average_precision(prepared, names),
                     CLASSIFIER_SPACE, n_trials, seconds, seed)
    return _table(df_train.sparkSession, [(t, -v, *rest) for t, v, *rest in rows], TRIAL, dump_to).orderBy(F.desc("value"), "trial")


def search_stage2(df_train: DataFrame, valid_years: Sequence[int], n_trials: int = TRIALS, seconds: float = SECONDS, max_rounds: int = ROUNDS,
                  seed: int = S.SEED, dump_to: str | None = None) -> DataFrame:
    """Trial table of stage 2, least mean absolute error of the rate in the validation years first."""
    prepared, names, *_ = T.prepare_stage2(df_train, valid_years)
    with prepared:
        rows = study(lambda p, watch: prepared.boost(names, p, max_rounds, PATIENCE, watch=watch), _least_loss, SPACE, n_trials, seconds, seed)
    return _table(df_train.sparkSession, rows, TRIAL, dump_to).orderBy("value", "trial")


def search_stage3(df_train: DataFrame, valid_years: Sequence[int], n_trials: int = CHANNEL_TRIALS, seconds: float = SECONDS, max_rounds: int = ROUNDS,
                  channels: Sequence[str] = MF.STAGE3_CHANNELS, seed: int = S.SEED, dump_to: str | None = None) -> DataFrame:
    """Trial tables of the channels, searched side by side on one set of blocks, least mean absolute error of the share first."""
    prepared, names, _ = T.prepare_stage3(df_train, valid_years, channels)

    def one(k_ch):
        k, ch = k_ch
        rows = study(lambda p, watch: prepared.boost(names[ch], p, max_rounds, PATIENCE, target=k, watch=watch), _least_loss, SPACE, n_trials, seconds, seed + k)
        return [(ch, *r) for r in rows]

    with prepared, ThreadPoolExecutor(max_workers=len(channels)) as pool:
        rows = [r for part in pool.map(one, enumerate(channels)) for r in part]
    return _table(df_train.sparkSession, rows, f"channel string, {TRIAL}", dump_to).orderBy("channel", "value", "trial")


def best_params(trials: DataFrame) -> dict:
    """Parameters of the first row of a trial table, ready for a training function."""
    return json.loads(trials.first()["params"])


def channel_metrics(predicted: DataFrame, models: dict[str, T.StageModel], rate: str = S.RATE) -> DataFrame:
    """Per channel the rows with a positive rate, mean share, MAE, RMSE and R2 of the share, and the rounds kept.

    ``predicted`` holds the actual channel rates and each channel's ``raw_`` margin. All channels are scored in one pass of partial sums.
    """
    from yieldcast.functions.scalar import sigmoid

    pairs = F.array(*[F.struct(F.lit(ch).alias("channel"), F.lit(m.rounds).alias("best_round"), (F.col(ch) / F.col(rate)).alias("y"),
                               sigmoid(f"raw_{ch}", clip=True).alias("p")) for ch, m in models.items()])
    long = predicted.where(F.col(rate) > 0).select(F.explode(pairs).alias("r")).select("r.*")
    e = F.col("p") - F.col("y")
    return (long.groupBy("channel", "best_round")
            .agg(F.count("y").alias("test_n"), F.avg("y").alias("test_mean_share"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
                 F.try_divide(F.sum(e * e), F.var_pop("y") * F.count("y")).alias("_r"))
            .select("channel", "test_n", "test_mean_share", "mae", "rmse", (F.lit(1.0) - F.col("_r")).alias("r2"), "best_round")
            .orderBy(F.desc("test_mean_share"), "channel"))
