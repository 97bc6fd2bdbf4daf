"""Second-order gradient boosting on binned blocks, as Spark jobs.

Every level of a tree is one pass over the blocks (rows that make up one partition go through all levels in its task): tasks add up gradients and hessians per (node, feature, code), the sums of a slab of
features are reduced in one place, and only the best split of each node reaches the driver. Gradients are rounded to a fixed number of
binary places and added as whole numbers, so a fit does not depend on partitions, their order or lost executors.

A split sends a set of codes to the left: values up to a cut, or the categories with the smallest ratio of gradient to hessian. Missing values
go to the side where they gain more. With sums G and H of a node, T the soft threshold at reg_alpha:

    weight = -T(G) / (H + reg_lambda), limited to +-max_delta_step if that is not 0
    score  = -(2 G weight + (H + reg_lambda) weight^2 + 2 reg_alpha |weight|)
    gain   = score(left) + score(right) - score(node)

A split needs a gain of at least gamma and a hessian sum of at least min_child_weight on both sides. After each round the loss of the validation
rows is measured; training ends when the best round lies ``patience`` rounds back, and the ensemble is cut there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from yieldcast.models.binning import Binning

SCALE = float(1 << 24)           # gradients, hessians and losses are counted in units of 1 / SCALE
LEAST_GAIN = 1e-6
CELLS = 16_000_000               # codes of a partition (rows x features)
TOGETHER = 4                     # nodes whose splits are searched at once, so that their sums stay near the processor
REBASE = 10                      # rounds after which rows carry their margin; up to MOST times as many in the task of a single partition
MOST = 5
WHOLE = 10                       # every so many of these, margins are worked out from all trees again
DEFAULTS = {"max_depth": 6, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0, "min_child_weight": 1.0, "gamma": 0.0,
            "reg_alpha": 0.0, "reg_lambda": 1.0, "max_delta_step": 0.0}


# -- trees ---------------------------------------------------------------------

@dataclass
class Tree:
    """Node arrays; ``side`` tells for each node and code whether rows go left. A leaf has feature -1."""
    feature: np.ndarray
    left: np.ndarray
    right: np.ndarray
    side: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        """The node where each row (column of ``codes``) ends."""
        at = np.zeros(codes.shape[1], dtype=np.int32)
        held = [(0, np.arange(codes.shape[1]))]
        while held:
            node, rows = held.pop()
            if self.feature[node] < 0 or not len(rows):
                at[rows] = node
                continue
            go = self.side[node][codes[self.feature[node]][rows]]
            held += [(int(self.left[node]), rows[go]), (int(self.right[node]), rows[~go])]
        return at

    def output(self, codes: np.ndarray) -> np.ndarray:
        return self.value[self.nodes(codes)]


@dataclass
class Ensemble:
    """Trees over a binning; the margin of a row is ``base`` and the sum of its trees' values."""
    binning: Binning
    trees: list[Tree]
    base: float
    objective: str
    history: list[float] = field(default_factory=list)     # validation loss of 0, 1, 2, ... rounds

    def margin(self, codes: np.ndarray) -> np.ndarray:
        out = np.full(codes.shape[1], self.base)
        for tree in self.trees:
            out += tree.output(codes)
        return out

    def narrowed(self, features: Sequence[int], names: Sequence[str]) -> "Ensemble":
        """The same model over some of its features, which must hold all that its trees use, under new names."""
        place = {f: i for i, f in enumerate(features)} | {-1: -1}
        trees = [Tree(np.array([place[int(f)] for f in t.feature], np.int32), t.left, t.right, t.side, t.value, t.cover, t.gain) for t in self.trees]
        return Ensemble(self.binning.narrowed(features, names), trees, self.base, self.objective, self.history)

    def importance(self, spark) -> DataFrame:
        """Splits, total and mean gain per feature, most gain first."""
        total, count = {}, {}
        for tree in self.trees:
            for f, g in zip(tree.feature.tolist(), tree.gain.tolist()):
                if f >= 0:
                    total[f], count[f] = total.get(f, 0.0) + g, count.get(f, 0) + 1
        rows = [(self.binning.names[f], count[f], total[f], total[f] / count[f]) for f in total]
        table = spark.createDataFrame(rows, "feature string, splits long, total_gain double, mean_gain double")
        return table.orderBy(F.desc("total_gain"), "feature")

    def column(self, df: DataFrame) -> Column:
        """The margin as a column over ``df``; only the columns that trees use go to Python, in Arrow batches."""
        used = sorted({int(f) for t in self.trees for f in t.feature if f >= 0})
        if not used:
            return F.lit(float(self.margin(np.zeros((0, 1), self.binning.dtype))[0]))
        place = {f: i for i, f in enumerate(used)}
        packed = [Tree(np.array([place.get(int(f), -1) for f in t.feature]), t.left, t.right, t.side, t.value, t.cover, t.gain) for t in self.trees]
        shared = df.sparkSession.sparkContext.broadcast((self.binning, used, packed, self.base))

        @pandas_udf("double")
        def margins(*columns):
            import pandas as pd
            import pyarrow as pa

            binning, features, trees, base = shared.value
            codes = binning.codes([pa.Array.from_pandas(c) for c in columns], features)
            out = np.full(codes.shape[1], base)
            for tree in trees:
                out += tree.output(codes)
            return pd.Series(out)

        names = self.binning.names
        return margins(*[F.col(names[f]).cast("double" if f < len(self.binning.nums) else "string") for f in used])


# -- objectives ----------------------------------------------------------------

def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -700, 700)))


def gradients(objective: str, margin, y, w):
    """First and second derivatives of the weighted loss: logistic for labels 0 and 1, else squared error."""
    if objective == "logistic":
        p = _sigmoid(margin)
        return w * (p - y), w * np.maximum(p * (1.0 - p), 1e-16)
    return w * (margin - y), w.copy()


def losses(objective: str, margin, y):
    """Validation loss per row: log loss, or for logits the absolute error of the rate."""
    if objective == "logistic":
        return np.logaddexp(0.0, np.where(y > 0, -margin, margin))
    return np.abs(_sigmoid(margin) - _sigmoid(y))


def _whole(x):
    return np.rint(x * SCALE)


# -- splits --------------------------------------------------------------------

def leaf_weight(g, h, p: dict):
    shrunk = np.copysign(np.maximum(np.abs(g) - p["reg_alpha"], 0.0), g)
    weight = -shrunk / np.maximum(h + p["reg_lambda"], 1e-16)
    step = p["max_delta_step"]
    return np.clip(weight, -step, step) if step else weight


def score(g, h, p: dict):
    w = leaf_weight(g, h, p)
    out, curve = 2.0 * g, h + p["reg_lambda"]
    out *= w
    curve *= w
    curve *= w
    out += curve
    out += 2.0 * p["reg_alpha"] * np.abs(w)
    return -out


def best_splits(sums, features: Sequence[int], category, p: dict) -> list[tuple]:
    """Per node the best split of a slab of features: (gain, feature, left codes, G left, H left, G, H); feature -1 without one.

    ``sums``: gradient and hessian sums (2, nodes, features, slots) in units of 1 / SCALE, the last slot for missing
    values. Of equal gains the first feature wins, then missing values to the right, then the smaller cut. Cuts that move no row are not
    scored: they cannot win against the one before, nor missing values on the left where there are none.
    """
    if sums.shape[1] > TOGETHER:
        return [found for a in range(0, sums.shape[1], TOGETHER) for found in best_splits(sums[:, a:a + TOGETHER], features, category, p)]
    g, h = sums.astype(np.float64) / SCALE
    nodes, width, cuts = g.shape[0], g.shape[1], g.shape[2] - 1
    order, moved_g, moved_h = {}, g[:, :, :-1], h[:, :, :-1]
    cat = np.flatnonzero(np.asarray(category, dtype=bool))
    if len(cat):
        held = h[:, cat, :-1]
        ratio = np.where(held > 0, g[:, cat, :-1] / np.maximum(held + p["reg_lambda"], 1e-16), np.inf)
        by_ratio = np.argsort(ratio, axis=2, kind="stable")
        order = {int(f): by_ratio[:, i] for i, f in enumerate(cat)}
        moved_g, moved_h = moved_g.copy(), moved_h.copy()
        moved_g[:, cat] = np.take_along_axis(moved_g[:, cat], by_ratio, 2)
        moved_h[:, cat] = np.take_along_axis(held, by_ratio, 2)
    left_g, left_h = np.cumsum(moved_g, axis=2), np.cumsum(moved_h, axis=2)
    total_g, total_h = left_g[:, 0, -1] + g[:, 0, -1], left_h[:, 0, -1] + h[:, 0, -1]
    least = max(float(p["min_child_weight"]), 1e-16)
    moves = (moved_g != 0) | (moved_h != 0)
    moves[:, :, 0] = True
    whole, missed = score(total_g, total_h, p), ((g[:, :, -1:] != 0) | (h[:, :, -1:] != 0))
    found = []                                           # per side of missing values: place in (node, feature, side, cut) order, gain, ends of nodes
    for side in (0, 1):
        hl = left_h + h[:, :, -1:] if side else left_h
        hr = total_h[:, None, None] - hl
        allowed = (hl >= least) & (hr >= least) & moves
        if side:
            allowed &= missed
        at = np.flatnonzero(allowed)
        pair = at // cuts
        node = pair // width
        gl = left_g.ravel()[at]
        if side:
            gl = gl + g[:, :, -1].ravel()[pair]
        gain = score(gl, hl.ravel()[at], p) + score(total_g[node] - gl, hr.ravel()[at], p) - whole[node]
        found.append((at + (pair + side) * cuts, gain, np.searchsorted(at, np.arange(nodes + 1) * (width * cuts))))
    out = []
    for node in range(nodes):
        won, place = -np.inf, 0
        for places, gain, ends in found:
            a, b = int(ends[node]), int(ends[node + 1])
            if b > a:
                best = a + int(gain[a:b].argmax())
                if gain[best] > won or (gain[best] == won and places[best] < place):
                    won, place = float(gain[best]), int(places[best])
        _, f, missing, cut = (int(x) for x in np.unravel_index(place, (nodes, width, 2, cuts)))
        go = np.zeros(cuts + 1, dtype=bool)
        go[order[f][node, :cut + 1] if f in order else slice(cut + 1)] = True
        go[-1] = bool(missing)
        gl, hl = left_g[node, f, cut] + missing * g[node, f, -1], left_h[node, f, cut] + missing * h[node, f, -1]
        split = won >= max(p["gamma"], LEAST_GAIN)
        out.append((won, int(features[f]) if split else -1, go, float(gl), float(hl), float(total_g[node]), float(total_h[node])))
    return out


# -- passes over the blocks ------------------------------------------------------

@dataclass
class _Pass:
    """What the tasks of one pass need: trees beyond the rows' margins, the tree that grows, its open nodes and the tree's features."""
    objective: str
    target: int
    base: float
    pending: list
    growing: Tree | None
    open_nodes: list
    features: list
    sample: float
    seed: int
    evaluate: bool
    slots: int
    every_row: bool = False


def _mixed(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sampled(keys, share: float, seed: int):
    """Rows of a round's sample: a share of all, by a hash of row number and seed."""
    if share >= 1.0:
        return np.ones(len(keys), dtype=bool)
    with np.errstate(over="ignore"):
        h = _mixed(_mixed(keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)))
    return (h >> np.uint64(11)).astype(np.float64) < share * 2.0 ** 53


def _weight(block, target):
    w = block["w"]
    return w[min(target, len(w) - 1)] if len(w) else np.ones(block["codes"].shape[1])


def _margin(block, task: _Pass):
    m = np.full(block["codes"].shape[1], task.base) if block["margin"] is None else block["margin"].copy()
    for tree in task.pending:
        m += tree.output(block["codes"])
    return m


def _sums(blocks: Iterator, task: _Pass):
    """(sums per node, feature and code; validation loss; validation rows) of a partition, in whole units."""
    hist = np.zeros((2, len(task.open_nodes), len(task.features), task.slots), dtype=np.int64)
    loss = rows_seen = 0
    for block in blocks:
        codes, y, valid = block["codes"], block["y"][task.target], block["valid"]
        margin = _margin(block, task)
        if task.evaluate and valid.any():
            loss += int(_whole(losses(task.objective, margin[valid], y[valid])).sum())
            rows_seen += int(valid.sum())
        if not task.open_nodes:
            continue
        take = sampled(block["keys"], task.sample, task.seed)
        if not task.every_row:
            take = take & ~valid
        place = np.full(1 if task.growing is None else len(task.growing.feature), -1, dtype=np.int64)
        place[task.open_nodes] = np.arange(len(task.open_nodes))
        at = place[np.zeros(codes.shape[1], np.int32) if task.growing is None else task.growing.nodes(codes)]
        rows = np.flatnonzero(take & (at >= 0))
        g, h = (_whole(x) for x in gradients(task.objective, margin[rows], y[rows], _weight(block, task.target)[rows]))
        start, cells = at[rows] * task.slots, len(task.open_nodes) * task.slots
        for i, f in enumerate(task.features):
            spot = start + codes[f, rows]
            for k, x in enumerate((g, h)):
                hist[k, :, i, :] += np.bincount(spot, weights=x, minlength=cells).astype(np.int64).reshape(-1, task.slots)
    return hist, loss, rows_seen


def _run_pass(blocks: RDD, task: _Pass, category, params: dict, slabs: int):
    """One pass: (best split of each open node, validation loss, validation rows).

    Of several partitions, slabs of features are summed and searched apart; the sums never reach the driver.
    """
    features = task.features

    def whole(part):
        hist, loss, n = _sums(part, task)
        found = best_splits(hist, features, category, params) if task.open_nodes else []
        yield found, loss, n

    if blocks.getNumPartitions() == 1:
        found, loss, n = blocks.mapPartitions(whole).collect()[0]
        return found, loss, n
    edges = np.linspace(0, len(features), min(slabs, max(1, len(features))) + 1).astype(int).tolist()

    def keyed(part):
        hist, loss, n = _sums(part, task)
        yield -1, np.array([loss, n], dtype=np.int64)
        if task.open_nodes:
            for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                yield k, hist[:, :, a:b]

    def search(item):
        k, total = item
        if k < 0:
            return k, total
        a, b = edges[k], edges[k + 1]
        return k, best_splits(total, features[a:b], category[a:b], params)

    found, loss, n = None, 0, 0
    for k, got in sorted(blocks.mapPartitions(keyed).reduceByKey(np.add, len(edges)).map(search).collect(), key=lambda x: x[0]):
        if k < 0:
            loss, n = int(got[0]), int(got[1])
        else:
            found = got if found is None else [max(x, y, key=lambda s: s[0]) for x, y in zip(found, got)]
    return found or [], loss, n


def _chosen(features: list[int], share: float, seed: int, round_: int) -> list[int]:
    """The features that a round's tree may use."""
    k = max(1, int(share * len(features)))
    if k == len(features):
        return features
    return sorted(int(f) for f in np.random.default_rng([seed, round_]).choice(features, k, replace=False))


def _merged(blocks: list) -> dict:
    """Blocks of one partition as one, which must carry their margin."""
    if len(blocks) == 1:
        return dict(blocks[0])
    return {k: np.concatenate([b[k] for b in blocks], axis=-1) for k in ("codes", "y", "w", "valid", "keys", "margin")}


class _Growth:
    """The rows of a partition while one tree grows on it: rows and sums of every node.

    Of two sibling nodes only the one with fewer rows is added up, the other one's sums are those of their parent less these
    (whole numbers, so the same as added up). Rows stand by node, none walks down the tree twice.
    """

    def __init__(self, block, task: _Pass):
        self.codes, self.slots = block["codes"], task.slots
        y, valid = block["y"][task.target], block["valid"]
        take = sampled(block["keys"], task.sample, task.seed)
        if not task.every_row:
            take = take & ~valid
        self.features = task.features
        # fitted rows have their gradients and the codes of this tree's features side by side
        fitted = np.flatnonzero(take)
        self.g, self.h = (_whole(x) for x in gradients(task.objective, block["margin"][fitted], y[fitted], _weight(block, task.target)[fitted]))
        # hessians that are all alike are counted, not added up
        self.alike = int(self.h[0]) if len(self.h) and (self.h == self.h[0]).all() else None
        self.near = np.empty((len(task.features), len(fitted)), self.codes.dtype)
        for i, f in enumerate(task.features):
            np.take(self.codes[f], fitted, out=self.near[i])
        self.place = {int(f): i for i, f in enumerate(task.features)}
        self.rows = {0: np.arange(len(fitted))}                     # places among the fitted rows
        self.others = {0: np.flatnonzero(~take)}                    # rows of the partition
        self.fitted, self.sums, self.split = fitted, {}, 0

    def follow(self, tree: Tree) -> None:
        """Move rows through the splits that ``tree`` has gained."""
        for node in range(self.split, len(tree.feature)):
            if tree.feature[node] < 0 or node not in self.rows:
                continue
            f, side = tree.feature[node], tree.side[node]
            for held, codes in ((self.rows, self.near[self.place[int(f)]]), (self.others, self.codes[f])):
                mine = held.pop(node)
                go = side[codes[mine]]
                held[int(tree.left[node])], held[int(tree.right[node])] = mine[go], mine[~go]

    def add_up(self, nodes: list[int]) -> None:
        """Gradient and hessian sums (2, features, slots) of each of the nodes."""
        if not nodes:
            return
        slots, cells = self.slots, len(nodes) * self.slots
        mine = np.concatenate([self.rows[n] for n in nodes])
        start = np.repeat(np.arange(len(nodes)) * slots, [len(self.rows[n]) for n in nodes])
        every = len(mine) == len(self.g)
        g, h = (self.g, self.h) if every and len(nodes) == 1 else (self.g[mine], self.h[mine])
        out = np.zeros((2, len(self.features), cells), dtype=np.int64)
        for i, near in enumerate(self.near):
            spot = near if every and len(nodes) == 1 else near[mine]
            spot = spot.astype(np.intp) if len(nodes) == 1 else start + spot
            out[0, i] = np.bincount(spot, weights=g, minlength=cells)
            if self.alike is None:
                out[1, i] = np.bincount(spot, weights=h, minlength=cells)
            else:
                out[1, i] = np.bincount(spot, minlength=cells)
        if self.alike is not None:
            out[1] *= self.alike
        out = out.reshape(2, len(self.features), len(nodes), slots)
        for k, n in enumerate(nodes):
            self.sums[n] = out[:, :, k]

    def level(self, tree: Tree | None, open_nodes: list[int]) -> np.ndarray:
        """Sums (2, nodes, features, slots) of the open nodes."""
        if tree is None:
            self.add_up(open_nodes)
        else:
            self.follow(tree)
            wanted, parents = set(open_nodes), [n for n in self.sums if tree.feature[n] >= 0]
            fewer, rest = [], []
            for n in parents:
                a, b = int(tree.left[n]), int(tree.right[n])
                if a in wanted or b in wanted:
                    few, many = (a, b) if len(self.rows[a]) <= len(self.rows[b]) else (b, a)
                    fewer.append(few)
                    if many in wanted:
                        rest.append((n, few, many))
            self.add_up(fewer)
            for n, few, many in rest:
                self.sums[many] = self.sums[n] - self.sums[few]
            self.sums = {n: x for n, x in self.sums.items() if n in wanted}
        self.split = min(open_nodes)
        return np.stack([self.sums[n] for n in open_nodes], axis=1)

    def output(self, tree: Tree) -> np.ndarray:
        """The grown tree's value for every row of the partition."""
        self.follow(tree)
        out = np.zeros(self.codes.shape[1])
        for node, mine in self.rows.items():
            out[self.fitted[mine]] = tree.value[node]
        for node, mine in self.others.items():
            out[mine] = tree.value[node]
        return out


def _rounds_in_task(blocks: RDD, start: _Pass, rounds: list[tuple[int, list[int]]], category, p: dict) -> list[tuple]:
    """Several rounds over rows that make up one partition: (tree, validation loss, validation rows) of each.

    The sums of that partition are the whole sums, so its task goes through the levels and rounds without the driver. ``rounds`` holds
    each round's seed and features.
    """
    def part(rows):
        block = _merged([b | {"margin": _margin(b, start)} for b in rows])
        y, valid = block["y"][start.target], block["valid"]
        out = []
        for seed, features in rounds:
            loss = n = 0
            if start.evaluate and valid.any():
                loss, n = int(_whole(losses(start.objective, block["margin"][valid], y[valid])).sum()), int(valid.sum())
            growth = _Growth(block, _Pass(start.objective, start.target, start.base, [], None, [0], features, start.sample, seed, False,
                                          start.slots, start.every_row))

            def run(growing, open_nodes, chosen, evaluate):
                return best_splits(growth.level(growing, open_nodes), chosen, category[chosen], p), loss, n

            out.append(_grow(run, features, start.slots, p))
            block["margin"] = block["margin"] + growth.output(out[-1][0])
        yield out

    return blocks.mapPartitions(part).collect()[0]


def as_blocks(table: DataFrame, binning: Binning, n_labels: int, cells: int = CELLS) -> RDD:
    """Blocks as numpy records, in partitions of about ``cells`` codes, kept in memory or on disk."""
    width, dtype = len(binning.names), binning.dtype
    size = table.agg(F.sum("n")).first()[0] or 0
    parts = max(1, min(table.rdd.getNumPartitions(), -(-size * max(1, width) // cells)))

    def record(r):
        n = r["n"]
        return {"codes": np.frombuffer(r["codes"], dtype=dtype).reshape(width, n), "y": np.frombuffer(r["labels"]).reshape(n_labels, n),
                "w": np.frombuffer(r["weights"]).reshape(-1, n), "valid": np.frombuffer(r["valid"], dtype=bool),
                "keys": np.uint64(r["first"]) + np.arange(n, dtype=np.uint64), "margin": None}

    return table.rdd.map(record).coalesce(parts).persist(StorageLevel.MEMORY_AND_DISK)


def base_margin(blocks: RDD, objective: str, target: int = 0, every_row: bool = False) -> float:
    """Margin without trees: the weighted mean label of the fitted rows, as a logit for the logistic loss."""
    def part(rows):
        wy = w = 0
        for b in rows:
            fit, weight = ~b["valid"] | every_row, _weight(b, target)
            wy += int(_whole(weight * b["y"][target])[fit].sum())
            w += int(_whole(weight)[fit].sum())
        yield wy, w

    wy, w = (sum(x) for x in zip(*blocks.mapPartitions(part).collect()))
    if not w:
        raise ValueError("no rows to fit")
    mean = wy / w
    if objective == "logistic":
        mean = min(max(mean, 1e-6), 1 - 1e-6)
        return float(np.log(mean / (1 - mean)))
    return float(mean)


# -- training --------------------------------------------------------------------

def _grow(run: Callable, features: list[int], slots: int, p: dict) -> tuple[Tree, int, int]:
    """One tree, level by level. Returns it with the validation loss and rows measured on the way."""
    feature, left, right, side, value, cover, gain = [-1], [-1], [-1], [np.zeros(slots, bool)], [0.0], [0.0], [0.0]

    def tree():
        return Tree(np.array(feature, np.int32), np.array(left, np.int32), np.array(right, np.int32), np.array(side), np.array(value), np.array(cover), np.array(gain))

    def weight(g, h):
        return float(p["learning_rate"] * leaf_weight(np.float64(g), np.float64(h), p))

    open_nodes, loss, rows = [0], 0, 0
    for depth in range(max(1, int(p["max_depth"]))):
        found, seen_loss, seen_rows = run(tree() if depth else None, open_nodes, features, depth == 0)
        if depth == 0:
            loss, rows = seen_loss, seen_rows
            value[0], cover[0] = weight(found[0][5], found[0][6]), found[0][6]
        following = []
        for node, (won, f, go, gl, hl, g, h) in zip(open_nodes, found):
            if f < 0:
                continue
            feature[node], side[node], gain[node] = f, go, won
            left[node], right[node] = len(feature), len(feature) + 1
            for gc, hc in ((gl, hl), (g - gl, h - hl)):
                if hc >= 2 * p["min_child_weight"]:
                    following.append(len(feature))
                feature.append(-1)
                left.append(-1)
                right.append(-1)
                side.append(np.zeros(slots, bool))
                value.append(weight(gc, hc))
                cover.append(hc)
                gain.append(0.0)
        open_nodes = following
        if not open_nodes:
            break
    return tree(), loss, rows


def boost(blocks: RDD, binning: Binning, objective: str, params: dict, max_rounds: int, patience: int | None = None, target: int = 0,
          features: Sequence[int] | None = None, seed: int = 42, every_row: bool = False,
          watch: Callable[[int, float], bool] | None = None) -> Ensemble:
    """Fit an ensemble on persisted ``blocks`` (``as_blocks``) for label ``target`` over ``features`` (all if None).

    With ``patience``, rows marked valid choose the number of rounds: training ends when the least loss is that many rounds old, and
    later trees are cut. Without it exactly ``max_rounds`` trees are fitted, with ``every_row`` on the validation rows as well.
    ``watch(round, loss)`` may end a trial by returning True.
    """
    p = DEFAULTS | {k: v for k, v in params.items() if k in DEFAULTS}
    every = list(range(len(binning.names))) if features is None else list(features)
    category, slots = binning.is_category, binning.slots
    slabs = max(1, blocks.getNumPartitions())
    ensemble = Ensemble(binning, [], base_margin(blocks, objective, target, every_row), objective)
    rows, carried, links, stale = blocks, 0, 0, []

    def run(growing, open_nodes, chosen, evaluate):
        task = _Pass(objective, target, ensemble.base, ensemble.trees[carried:], growing, open_nodes, chosen, float(p["subsample"]),
                     seed * 1_000_003 + len(ensemble.trees), evaluate, slots, every_row)
        out = _run_pass(rows, task, category[chosen], p, slabs)
        while stale:
            stale.pop().unpersist()
        return out

    def carry():
        """Give the rows the margin of all trees so far; every ``WHOLE`` times from the first blocks, so that lineage stays short."""
        nonlocal rows, carried, links
        links = (links + 1) % WHOLE
        afresh = links == 0
        task = _Pass(objective, target, ensemble.base, ensemble.trees[0 if afresh else carried:], None, [], [], 1.0, 0, False, slots)
        source = blocks if afresh else rows
        moved = source.map(lambda b: b | {"margin": _margin(b, task)}).persist(StorageLevel.MEMORY_AND_DISK)
        if rows is not blocks:
            stale.append(rows)
        rows, carried = moved, len(ensemble.trees)

    best = (float("inf"), 0)

    def measured(loss, n):
        nonlocal best
        value = loss / SCALE / n if n else float("nan")
        ensemble.history.append(value)
        if value < best[0]:
            best = (value, len(ensemble.trees))
        return value

    def planned(round_):
        return seed * 1_000_003 + round_, _chosen(every, float(p["colsample_bytree"]), seed, round_)

    stopped, one = False, blocks.getNumPartitions() == 1
    while len(ensemble.trees) < max_rounds and not stopped:
        done = len(ensemble.trees)
        if one:
            start = _Pass(objective, target, ensemble.base, ensemble.trees[carried:], None, [], [], float(p["subsample"]), 0, patience is not None, slots, every_row)
            together = REBASE * min(MOST, 1 + done // (REBASE * WHOLE))      # few at first: a trial may soon be cut
            grown = _rounds_in_task(rows, start, [planned(r) for r in range(done, min(done + together, max_rounds))], category, p)
            while stale:
                stale.pop().unpersist()
        else:
            grown = [_grow(run, planned(done)[1], slots, p)]
        for tree, loss, n in grown:
            if patience is not None:
                value = measured(loss, n)
                if len(ensemble.trees) - best[1] >= patience or (watch and watch(len(ensemble.trees), value)):
                    stopped = True
                    break
            ensemble.trees.append(tree)
        if not stopped and (one or len(ensemble.trees) % REBASE == 0):
            carry()
    if patience is not None:
        if not stopped:
            _, loss, n = run(None, [], [], True)
            measured(loss, n)
        ensemble.trees = ensemble.trees[:best[1]]
    if rows is not blocks:
        rows.unpersist()
    return ensemble
