"""Glass-box additive model (T9-T13): margin(x) = intercept + sum of one table per feature [+ one per pair], by cyclic boosting.

Round after round every feature in turn gets a small step on its own table of bins: shrinkage times the gradient sum of each bin over its
hessian sum, given all tables so far. Gradients after a step follow from the one before it by the weights that pairs of bins share, so those
pair sums, one pass over the binned blocks, stand in for the rows: their size depends on features and bins, not on data. For the squared error this is exact
cyclic boosting of the rows. For the log loss the hessian is bounded by a quarter of the weight (Boehning and Lindsay, 1988), and every few rounds a
pass measures the true gradients and validation losses anew.

Rows are dealt into bags by a hash. Each bag's tables are fitted without its rows, which choose its number of rounds; the model is the mean of the bags.
Tables are centred (weighted mean 0, the mean moved into the intercept). Missing and unseen values have a bin of their own.

Pairs are screened by one pass over all of them: sums of residuals and hessians per pair of bins, and the gain of the best four-quadrant cut. The
strongest are fitted by the same boosting on top of the features' tables.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from yieldcast.models import booster as BO
from yieldcast.models import features as MF
from yieldcast.models import train as T
from yieldcast.models.binning import Binning
from yieldcast.session import ship_package

BINS = 16
BAGS = 3
LEARNING_RATE = 0.05
MAX_ROUNDS = 1000
PATIENCE = 50
REFRESH = 10             # rounds between two measurements of a log loss
RIDGE = 1.0              # added to every hessian sum, so that thin bins take small steps
PAIRS = 10               # pairs that are fitted
PAIR_SEP = "__x__"
CELLS = 500_000          # codes of a partition: a pass over pairs of features takes each code as often as there are features


@dataclass
class AdditiveModel:
    """Terms are features or pairs of features, by their places in the binning; a table has a value per bin (or pair of bins)."""
    binning: Binning
    terms: list[tuple[int, ...]]
    tables: list[np.ndarray]
    counts: list[np.ndarray]          # fitted rows per bin
    intercept: float
    objective: str
    rounds: list[int] = field(default_factory=list)

    @property
    def names(self) -> list[str]:
        return [PAIR_SEP.join(self.binning.names[f] for f in t) for t in self.terms]


# -- bins of a term --------------------------------------------------------------

def sizes(binning: Binning) -> list[int]:
    """Bins of each feature, that of missing values (the last) included."""
    return [len(c) + 2 for c in binning.cuts] + [len(v) + 1 for v in binning.levels]


def term_bins(codes: np.ndarray, terms: Sequence[tuple[int, ...]], size: Sequence[int], slots: int) -> np.ndarray:
    """Bin of every row in every term (terms x rows); a pair's bins count through those of its second feature."""
    own = {f: np.where(codes[f] == slots - 1, size[f] - 1, codes[f]).astype(np.int64) for f in {f for t in terms for f in t}}
    out = np.empty((len(terms), codes.shape[1]), dtype=np.int64)
    for i, t in enumerate(terms):
        out[i] = own[t[0]] if len(t) == 1 else own[t[0]] * size[t[1]] + own[t[1]]
    return out


def _term_sizes(terms, size) -> list[int]:
    return [int(np.prod([size[f] for f in t])) for t in terms]


# -- passes over the blocks --------------------------------------------------------

@dataclass
class _State:
    """What tasks need to know of a fit: terms, offsets of their bins in one vector, the bags' vectors, and the tables below them."""
    terms: list
    size: list
    slots: int
    offsets: np.ndarray
    objective: str
    intercept: float
    vectors: np.ndarray               # bags x bins
    under: tuple | None = None        # (terms, offsets, vector) of a model whose margin the terms are added to


def _bags(block, n: int) -> np.ndarray:
    return (BO._mixed(block["keys"] + np.uint64(0xA0761D6478BD642F)) % np.uint64(n)).astype(np.int64)


def _weights(block):
    return BO._weight(block, 0)


def _spots(block, s: _State) -> np.ndarray:
    return term_bins(block["codes"], s.terms, s.size, s.slots) + s.offsets[:-1, None]


def _below(block, s: _State) -> np.ndarray:
    m = np.full(block["codes"].shape[1], s.intercept)
    if s.under:
        terms, offsets, vector = s.under
        m = m + vector[term_bins(block["codes"], terms, s.size, s.slots) + offsets[:-1, None]].sum(axis=0)
    return m


def _slope(s: _State, margin, y, w):
    """Residual (negative gradient) and hessian, or its bound."""
    if s.objective == "logistic":
        return w * (y - BO._sigmoid(margin)), 0.25 * w
    return w * (y - margin), w


def _measure(blocks: RDD, s: _State):
    """Per bag the residual sums of the rows outside it, and the loss of the rows in it: (bags x bins, bags, bags)."""
    n, width = s.vectors.shape

    def part(rows: Iterator):
        sums, loss, seen = np.zeros((n, width), np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for b in rows:
            at, below, bag, y, w = _spots(b, s), _below(b, s), _bags(b, n), b["y"][0], _weights(b)
            for k in range(n):
                margin = below + s.vectors[k][at].sum(axis=0)
                r = np.where(bag != k, _slope(s, margin, y, w)[0], 0.0)
                sums[k] += np.bincount(at.ravel(), weights=np.tile(np.rint(r * BO.SCALE), len(at)), minlength=width).astype(np.int64)
                out = bag == k
                value = BO.losses("logistic", margin, y) if s.objective == "logistic" else 0.5 * (y - margin) ** 2
                loss[k] += int(np.rint((w * value)[out] * BO.SCALE).sum())
                seen[k] += int(np.rint(w[out] * BO.SCALE).sum())
        yield sums, loss, seen

    parts = blocks.mapPartitions(part)
    sums, loss, seen = parts.treeReduce(lambda a, b: tuple(x + y for x, y in zip(a, b)))
    return sums / BO.SCALE, loss / np.maximum(seen, 1), seen


def _pair_sums(blocks: RDD, s: _State, n: int) -> np.ndarray:
    """Hessian sums of every two bins per bag (bags x bins x bins): rows of a bin are reduced apart, no task holds all of a large table."""
    width = int(s.offsets[-1])

    def part(rows: Iterator):
        total: dict = {}
        for b in rows:
            at, bag, w = _spots(b, s), _bags(b, n), _weights(b)
            h = np.rint(w * (0.25 if s.objective == "logistic" else 1.0) * BO.SCALE)
            for k in range(n):
                mine = np.flatnonzero(bag == k)
                spots, weight = at[:, mine], np.tile(h[mine], len(at))
                for t in range(len(s.terms)):
                    span = int(s.offsets[t + 1] - s.offsets[t])
                    cell = ((spots[t] - s.offsets[t]) * width + spots).ravel()
                    got = np.bincount(cell, weights=weight, minlength=span * width).astype(np.int64).reshape(span, width)
                    total[k, t] = total[k, t] + got if (k, t) in total else got
        yield from total.items()

    out = np.zeros((n, width, width))
    for (k, t), got in blocks.mapPartitions(part).reduceByKey(np.add).toLocalIterator():
        out[k, s.offsets[t]:s.offsets[t + 1]] = got / BO.SCALE
    return out


# -- cyclic boosting ----------------------------------------------------------------

def _sweep(vector, slope, pair, h, offsets, rate: float) -> None:
    """One round: each term's bins in turn step by rate * slope / (hessian + RIDGE); ``slope`` follows. Arrays change in place."""
    for a, b in zip(offsets[:-1], offsets[1:]):
        step = rate * slope[a:b] / (h[a:b] + RIDGE)
        vector[a:b] += step
        slope -= pair[a:b].T @ step


def _boost_terms(blocks: RDD, s: _State, rate: float, max_rounds: int, patience: int) -> list[int]:
    """Fit ``s.vectors`` bag by bag in place; returns the rounds that each bag keeps.

    The squared error of a bag's own rows is followed through its pair sums; a log loss is measured every ``REFRESH`` rounds.
    """
    n = len(s.vectors)
    every = 1 if s.objective == "squared" else REFRESH
    per_bag = _pair_sums(blocks, s, n)
    whole = per_bag.sum(axis=0)
    rounds = [0] * n
    if s.objective == "squared":
        slopes, losses, seen = _measure(blocks, s)
        own = _own_slopes(blocks, s)

        def fit_bag(k: int) -> None:
            pair = whole - per_bag[k]
            h, slope, out = np.diag(pair).copy(), slopes[k].copy(), own[k].copy()
            vector, best, waited, loss = s.vectors[k].copy(), (losses[k], 0, s.vectors[k].copy()), 0, losses[k]
            for r in range(1, max_rounds + 1):
                before = vector.copy()
                _sweep(vector, slope, pair, h, s.offsets, rate)
                moved = vector - before
                pushed = per_bag[k] @ moved
                loss += (0.5 * moved @ pushed - out @ moved) / max(seen[k] / BO.SCALE, 1e-300)
                out -= pushed
                if loss < best[0]:
                    best, waited = (loss, r, vector.copy()), 0
                else:
                    waited += 1
                    if waited >= patience:
                        break
            s.vectors[k], rounds[k] = best[2], best[1]

        with ThreadPoolExecutor(max_workers=n) as pool:
            list(pool.map(fit_bag, range(n)))
        return rounds
    np.subtract(whole, per_bag, out=per_bag)             # sums of the rows outside each bag
    best = [(np.inf, 0, v.copy()) for v in s.vectors]
    open_bags, done = set(range(n)), 0
    with ThreadPoolExecutor(max_workers=n) as pool:
        while True:
            slopes, losses, _ = _measure(blocks, s)
            for k in list(open_bags):
                if losses[k] < best[k][0]:
                    best[k] = (losses[k], done, s.vectors[k].copy())
                elif done - best[k][1] >= patience:
                    open_bags.discard(k)
            if not open_bags or done >= max_rounds:
                break

            def step_bag(k: int) -> None:
                h, slope = np.diag(per_bag[k]).copy(), slopes[k].copy()
                for _ in range(every):
                    _sweep(s.vectors[k], slope, per_bag[k], h, s.offsets, rate)

            list(pool.map(step_bag, open_bags))
            done += every
    for k in range(n):
        rounds[k], s.vectors[k] = best[k][1], best[k][2]
    return rounds


def _own_slopes(blocks: RDD, s: _State) -> np.ndarray:
    """Per bag the residual sums of its own rows (bags x bins)."""
    n, width = s.vectors.shape

    def part(rows: Iterator):
        sums = np.zeros((n, width), np.int64)
        for b in rows:
            at, below, bag, y, w = _spots(b, s), _below(b, s), _bags(b, n), b["y"][0], _weights(b)
            for k in range(n):
                r = np.where(bag == k, _slope(s, below + s.vectors[k][at].sum(axis=0), y, w)[0], 0.0)
                sums[k] += np.bincount(at.ravel(), weights=np.tile(np.rint(r * BO.SCALE), len(at)), minlength=width).astype(np.int64)
        yield sums

    return blocks.mapPartitions(part).treeReduce(np.add) / BO.SCALE


def _row_counts(blocks: RDD, s: _State) -> np.ndarray:
    width = int(s.offsets[-1])

    def part(rows: Iterator):
        out = np.zeros(width, np.int64)
        for b in rows:
            out += np.bincount(_spots(b, s).ravel(), minlength=width)
        yield out

    return blocks.mapPartitions(part).treeReduce(np.add)


def _fit(prepared: T.Prepared, terms: list, under: AdditiveModel | None, bags: int, rate: float, max_rounds: int, patience: int) -> AdditiveModel:
    binning, blocks = prepared.binning, prepared.blocks
    size = sizes(binning)
    offsets = np.concatenate([[0], np.cumsum(_term_sizes(terms, size))]).astype(np.int64)
    intercept = under.intercept if under else BO.base_margin(blocks, prepared.objective)
    below = None
    if under:
        below = (under.terms, np.concatenate([[0], np.cumsum([len(t) for t in under.tables])]).astype(np.int64), np.concatenate(under.tables))
    state = _State(terms, size, binning.slots, offsets, prepared.objective, intercept, np.zeros((bags, int(offsets[-1]))), below)
    rounds = _boost_terms(blocks, state, rate, max_rounds, patience)
    vector, counts = state.vectors.mean(axis=0), _row_counts(blocks, state)
    tables, held = [], []
    for a, b in zip(offsets[:-1], offsets[1:]):
        n = counts[a:b]
        mean = float((vector[a:b] * n).sum() / max(n.sum(), 1))
        tables.append(vector[a:b] - mean)
        held.append(n)
        intercept += mean
    if under:
        tables, held, terms = [*under.tables, *tables], [*under.counts, *held], [*under.terms, *terms]
    return AdditiveModel(binning, terms, tables, held, intercept, prepared.objective, rounds)


def prepare_additive(df: DataFrame, features: Sequence[str], label: str, kind: str = "classifier", weight: str | None = None,
                     bins: int = BINS) -> T.Prepared:
    """Binned blocks for one or more additive fits (text columns are categories); only features, label and weight are kept of the rows."""
    text = {c for c, t in df.dtypes if t == "string"}
    names = MF.resolve_features(df.columns, features)
    nums, cats = [c for c in names if c not in text], [c for c in names if c in text]
    data = df.withColumn("_none", F.lit(False))
    return T.prepare(data, nums, cats, [label], "logistic" if kind == "classifier" else "squared", [weight] if weight else [], "_none", max_bins=bins, cells=CELLS)


def fit_prepared(prepared: T.Prepared, bags: int = BAGS, rate: float = LEARNING_RATE, max_rounds: int = MAX_ROUNDS,
                 patience: int = PATIENCE) -> AdditiveModel:
    return _fit(prepared, [(f,) for f in range(len(prepared.binning.names))], None, bags, rate, max_rounds, patience)


def fit_additive(df: DataFrame, features: Sequence[str], label: str, kind: str = "classifier", weight: str | None = None, bins: int = BINS,
                 bags: int = BAGS, rate: float = LEARNING_RATE, max_rounds: int = MAX_ROUNDS, patience: int = PATIENCE) -> AdditiveModel:
    """The additive model of all features, a classifier (log loss) or regressor (squared error)."""
    with prepare_additive(df, features, label, kind, weight, bins) as prepared:
        return fit_prepared(prepared, bags, rate, max_rounds, patience)


# -- pairs ----------------------------------------------------------------------------

def quadrant_gain(r: np.ndarray, h: np.ndarray) -> float:
    """Gain of the best cut of both features into four quadrants, from residual and hessian sums per pair of bins."""
    def quarters(x):
        c = x.cumsum(axis=0).cumsum(axis=1)
        low, left, top, whole = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        return low, left - low, top - low, whole - left - top + low

    if min(r.shape) < 2:
        return 0.0
    gain = sum(a * a / (b + RIDGE) for a, b in zip(quarters(r), quarters(h)))
    return float(gain.max() - r.sum() ** 2 / (h.sum() + RIDGE))


def screen_pairs(prepared: T.Prepared, model: AdditiveModel) -> list[tuple[float, int, int]]:
    """(gain, feature, feature) of all pairs of features, strongest first.

    One pass over the blocks; sums per pair are reduced and searched where they lie, a gain per pair reaches the driver.
    """
    size, slots, width = sizes(prepared.binning), prepared.binning.slots, len(prepared.binning.names)
    terms = [(f,) for f in range(width)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in model.tables])]).astype(np.int64)
    state = _State(terms, size, slots, offsets[:width + 1], prepared.objective, model.intercept, np.zeros((1, 1)),
                   (model.terms, offsets, np.concatenate(model.tables)))

    def part(rows: Iterator):
        total: dict = {}
        for b in rows:
            own = term_bins(b["codes"], terms, size, slots)
            r, h = (np.rint(x * BO.SCALE) for x in _slope(state, _below(b, state), b["y"][0], _weights(b)))
            for i in range(width - 1):
                starts = np.concatenate([[0], np.cumsum(size[i + 1:])]).astype(np.int64)
                span = int(starts[-1])
                cell = (own[i] * span + own[i + 1:] + starts[:-1, None]).ravel()
                got = np.stack([np.bincount(cell, weights=np.tile(x, width - i - 1), minlength=size[i] * span).astype(np.int64).reshape(size[i], span)
                                for x in (r, h)])
                total[i] = total[i] + got if i in total else got
        yield from total.items()

    def search(item):
        i, sums = item
        cut = np.concatenate([[0], np.cumsum(size[i + 1:])]).astype(int)
        r, h = sums / BO.SCALE
        return [(quadrant_gain(r[:, a:b], h[:, a:b]), i, i + 1 + k) for k, (a, b) in enumerate(zip(cut[:-1], cut[1:]))]

    return sorted(prepared.blocks.mapPartitions(part).reduceByKey(np.add).flatMap(search).collect(), key=lambda x: (-x[0], x[1], x[2]))


def with_pairs(prepared: T.Prepared, model: AdditiveModel, pairs: Sequence[tuple[int, int]], bags: int = BAGS, rate: float = LEARNING_RATE,
               max_rounds: int = MAX_ROUNDS, patience: int = PATIENCE) -> AdditiveModel:
    """The model with tables of the given pairs, fitted on top of its own."""
    return _fit(prepared, [tuple(p) for p in pairs], model, bags, rate, max_rounds, patience) if pairs else model


def interactions(df: DataFrame, features: Sequence[str], label: str, kind: str, weight: str | None = None, pairs: int = PAIRS,
                 top_n: int = 10, bins: int = BINS) -> DataFrame:
    """The strongest pairs of features: rank, pair, screening gain and mean |contribution| of the pair's fitted table."""
    spark = df.sparkSession
    with prepare_additive(df, features, label, kind, weight, bins) as prepared:
        model = fit_prepared(prepared)
        ranked = screen_pairs(prepared, model)
        full = with_pairs(prepared, model, [(a, b) for _, a, b in ranked[:pairs]])
    strength = {t: v for t, (_, v) in zip(full.terms, _strengths(full))}
    names = full.binning.names
    rows = [(k + 1, names[a], names[b], float(g), float(strength[(a, b)])) for k, (g, a, b) in enumerate(ranked[:min(pairs, top_n)])]
    return spark.createDataFrame(rows, "rank int, feature_a string, feature_b string, gain double, importance double").orderBy("rank")


# -- tables of a fitted model -------------------------------------------------------------

def _strengths(model: AdditiveModel) -> list[tuple[str, float]]:
    return [(name, float((np.abs(t) * n).sum() / max(n.sum(), 1))) for name, t, n in zip(model.names, model.tables, model.counts)]


def importance(model: AdditiveModel, top_n: int = 20) -> DataFrame:
    """Mean |contribution| of each term over the fitted rows, strongest first."""
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(_strengths(model), "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(top_n)


def shape_functions(model: AdditiveModel) -> DataFrame:
    """Every feature's table: bin, contribution, fitted rows, and the bin's range or category (null for missing values)."""
    spark, rows = SparkSession.getActiveSession(), []
    for (f, *second), name, table, n in zip(model.terms, model.names, model.tables, model.counts):
        if second:
            continue
        number = f < len(model.binning.nums)
        edges = [-np.inf, *model.binning.cuts[f], np.inf] if number else []
        levels = [] if number else model.binning.levels[f - len(model.binning.nums)]
        for b, (v, k) in enumerate(zip(table.tolist(), n.tolist())):
            held = b < len(table) - 1
            rows.append((name, b, float(v), int(k), float(edges[b]) if number and held else None, float(edges[b + 1]) if number and held else None,
                         levels[b] if not number and held else None))
    return spark.createDataFrame(rows, "feature string, bin int, contribution double, n long, lower double, upper double, category string")


def shape_function(model: AdditiveModel, feature: str) -> DataFrame:
    """T11 of one feature, in bin order."""
    if feature not in model.names:
        raise ValueError(f"no feature {feature}")
    return shape_functions(model).where(F.col("feature") == feature).orderBy("bin")


def _contribution_column(model: AdditiveModel, df: DataFrame) -> Column:
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast((model.binning, model.terms, model.tables))

    @pandas_udf("array<double>")
    def parts(*columns):
        import pyarrow as pa

        binning, terms, tables = shared.value
        at = term_bins(binning.codes([pa.Array.from_pandas(c) for c in columns]), terms, sizes(binning), binning.slots)
        return pd.Series(list(np.stack([t[i] for t, i in zip(tables, at)], axis=1)))

    b = model.binning
    return parts(*[F.col(c).cast("double") for c in b.nums], *[F.col(c).cast("string") for c in b.cats])


def contributions(model: AdditiveModel, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per-row contribution of every term (long form) plus the intercept row; they add up to ``margin``."""
    names = F.array(*[F.lit(n) for n in [*model.names, "intercept"]])
    whole = F.concat(_contribution_column(model, df), F.array(F.lit(model.intercept)))
    long = df.select(*keys, F.posexplode(F.arrays_zip(names.alias("feature"), whole.alias("contribution"))).alias("_i", "_t"))
    return long.select(*keys, F.col("_t.feature").alias("feature"), F.col("_t.contribution").alias("contribution"))


def margin(model: AdditiveModel, df: DataFrame) -> DataFrame:
    """Model output (log-odds or logit rate) as column ``margin``."""
    total = F.aggregate(_contribution_column(model, df), F.lit(model.intercept), lambda a, x: a + x)
    return df.withColumn("margin", total)
