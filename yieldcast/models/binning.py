"""The binned matrix of the boosted models.

Numeric columns are cut at approximate quantiles, category columns are indexed in alphabetical order; null, NaN and unseen categories share
the last slot, so that trees can learn a side for missing values. Rows are stored in blocks: one table row holds the codes of a few
thousand rows as bytes, feature by feature, with their labels, weights and validation flags. The table is written once; every later pass
reads the same blocks, whatever becomes of the executors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BINS = 64            # value bins of a numeric column
ACCURACY = 2000          # of the quantiles (relative rank error 1/ACCURACY)


@dataclass
class Binning:
    """Cut points of numeric columns and values of category columns, in feature order."""
    nums: list[str]
    cuts: list[list[float]]
    cats: list[str]
    levels: list[list[str]]
    slots: int = 0           # codes of a feature, that of missing values (the last) included

    def __post_init__(self):
        self.slots = self.slots or max([1, *(len(c) + 1 for c in self.cuts), *map(len, self.levels)]) + 1

    @property
    def names(self) -> list[str]:
        return self.nums + self.cats

    def narrowed(self, features: Sequence[int], names: Sequence[str]) -> "Binning":
        """The given features under new names; numeric ones must come first, as they do here."""
        nums = [f for f in features if f < len(self.nums)]
        cats = [f - len(self.nums) for f in features if f >= len(self.nums)]
        return Binning(list(names[:len(nums)]), [self.cuts[f] for f in nums], list(names[len(nums):]), [self.levels[f] for f in cats], self.slots)

    @property
    def dtype(self):
        return np.uint8 if self.slots <= 256 else np.uint16

    @property
    def is_category(self) -> np.ndarray:
        return np.array([False] * len(self.nums) + [True] * len(self.cats), dtype=bool)

    def codes(self, columns: Sequence, features: Sequence[int] | None = None) -> np.ndarray:
        """Codes (features x rows) of Arrow columns in feature order (or of the given features only)."""
        import pyarrow as pa
        import pyarrow.compute as pc

        which = list(range(len(self.names))) if features is None else list(features)
        n = len(columns[0]) if len(columns) else 0
        out = np.full((len(which), n), self.slots - 1, dtype=self.dtype)
        for at, (f, column) in enumerate(zip(which, columns)):
            if f < len(self.nums):
                x = pc.fill_null(column.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
                code = np.searchsorted(np.asarray(self.cuts[f]), x)
                out[at] = np.where(np.isnan(x), self.slots - 1, code)
            else:
                known = pa.array(self.levels[f - len(self.nums)], pa.string())
                code = pc.index_in(column.cast(pa.string()), value_set=known)
                out[at] = pc.fill_null(code, self.slots - 1).to_numpy(zero_copy_only=False)
        return out


def _number(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def fit_binning(df: DataFrame, nums: Sequence[str], cats: Sequence[str], max_bins: int = MAX_BINS) -> Binning:
    """Quantile cuts of numeric columns and distinct values of category columns, one pass of partial aggregates each.

    A column without values has no cuts. Distinct values are grouped per (column, value), so a category that nearly
    all rows share moves as one row per task.
    """
    probs = [k / max_bins for k in range(1, max_bins)]
    cuts: list[list[float]] = []
    if nums:
        row = df.agg(*[F.percentile_approx(_number(c), probs, ACCURACY).alias(c) for c in nums]).first()
        cuts = [sorted(set(row[c] or [])) for c in nums]
    levels: list[list[str]] = [[] for _ in cats]
    if cats:
        pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(cats)])
        for r in df.select(F.explode(pairs).alias("p")).select("p.i", "p.v").where("v is not null").distinct().collect():
            levels[r["i"]].append(r["v"])
    return Binning(list(nums), cuts, list(cats), [sorted(v) for v in levels])


def model_columns(binning: Binning) -> list[Column]:
    """Columns in feature order as the tasks expect them."""
    return [F.col(c).cast("double").alias(c) for c in binning.nums] + [F.col(c).cast("string").alias(c) for c in binning.cats]


BLOCK = "first long, n int, codes binary, labels binary, weights binary, valid binary"


def binned_blocks(df: DataFrame, binning: Binning, labels: Sequence[str], weights: Sequence[str] = (), valid: str | None = None) -> DataFrame:
    """Blocks of rows. ``labels`` (and ``weights``, one per label or none) are double columns, ``valid`` marks validation rows.

    ``first`` numbers rows by task and position; once written it stays, and row samples are drawn from it.
    """
    spec = binning
    n_labels, n_weights = len(labels), len(weights)
    extra = [F.col(c).cast("double") for c in [*labels, *weights]] + [F.col(valid) if valid else F.lit(False)]
    # names may repeat (a weight shared by labels): columns are taken by place
    columns = [c.alias(f"c{i}") for i, c in enumerate([*model_columns(binning), *extra])]

    def blocks(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            width = len(spec.names)
            codes = spec.codes(batch.columns[:width]) if width else np.zeros((0, n), spec.dtype)
            rest = [c.to_numpy(zero_copy_only=False) for c in batch.columns[width:]]
            y = np.array(rest[:n_labels], dtype=np.float64)
            w = np.array(rest[n_labels:n_labels + n_weights], dtype=np.float64)
            v = np.asarray(rest[-1], dtype=bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int64()), pa.array([n], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (codes, y, w, v)]],
                ["first", "n", "codes", "labels", "weights", "valid"])
            at += n

    return df.select(*columns).mapInArrow(blocks, BLOCK)
