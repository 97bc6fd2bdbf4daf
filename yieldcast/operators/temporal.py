"""Site-week context, the weekly grid and the lag/rolling/EWMA family."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldcast import schema as S
from yieldcast.functions.scalar import cyclic_week, ieee_div, iso_week_monday, nan_to_zero

# Fixed feature definitions.
SITE_WEEK_SUMS = {
    "site_units_total_week": "units_total",
    "site_weight_total_week": "weight_total",
    "site_units_recovered_week": "units_recovered",
    "site_units_donations_week": "units_donations",
    "site_units_disposal_week": "units_disposal",
    "site_units_warehouse_deals_and_gr_week": "units_warehouse_deals_and_gr",
    "site_units_liquidations_week": "units_liquidations",
    "site_units_sales_week": "units_sales",
    "site_units_return_to_vendor_week": "units_return_to_vendor",
}
SITE_WEEK_RATIOS = {
    "site_units_share_week": ("units_total", "site_units_total_week"),
    "site_weight_share_week": ("weight_total", "site_weight_total_week"),
    "site_recovered_share_week": ("units_recovered", "site_units_recovered_week"),
    "site_prob_recovered_week": ("site_units_recovered_week", "site_units_total_week"),
    "site_prob_donations_week": ("site_units_donations_week", "site_units_total_week"),
    "site_prob_disposal_week": ("site_units_disposal_week", "site_units_total_week"),
    "site_prob_warehouse_deals_and_gr_week": ("site_units_warehouse_deals_and_gr_week", "site_units_total_week"),
    "site_prob_liquidations_week": ("site_units_liquidations_week", "site_units_total_week"),
    "site_prob_sales_week": ("site_units_sales_week", "site_units_total_week"),
    "site_prob_return_to_vendor_week": ("site_units_return_to_vendor_week", "site_units_total_week"),
}
NAN_TO_ZERO = {"site_recovered_share_week"}


def iso_week_monday_col() -> Column:
    return iso_week_monday(S.YEAR, S.WEEK)


def site_week_totals(df: DataFrame, keys: Sequence[str] = (S.SITE, S.WEEK_DATE)) -> DataFrame:
    """Nine partition totals over (site, week) as window sums.

    A partition holds one site-week: at most (#GL x 2 months) rows, so a hot
    site cannot make one task large -- only one site-week.
    """
    w = Window.partitionBy(*keys)
    return df.select("*", *[F.sum(src).over(w).alias(name) for name, src in SITE_WEEK_SUMS.items()])


def gl_share_of_site(df: DataFrame) -> DataFrame:
    """Ratios to the site-week totals with plain IEEE division.

    0/0 is NaN and x/0 is +-inf as in the source; only the recovered share
    maps NaN to 0.
    """
    cols = []
    for name, (num, den) in SITE_WEEK_RATIOS.items():
        expr = ieee_div(num, den)
        cols.append((nan_to_zero(expr) if name in NAN_TO_ZERO else expr).alias(name))
    return df.select("*", *cols)


def cyclic_week_features(df: DataFrame, period: float = S.WEEK_PERIOD) -> DataFrame:
    """week_sin / week_cos."""
    s, c = cyclic_week(S.WEEK, period)
    return df.select("*", s.alias("week_sin"), c.alias("week_cos"))


# ---------------------------------------------------------------------------
# Weekly grid
# ---------------------------------------------------------------------------

def week_grid(df: DataFrame, keys: Sequence[str] = S.SERIES_KEYS) -> DataFrame:
    """W8 (grid only): every week from first to last per series, with start/end."""
    return (df.groupBy(*keys)
              .agg(F.min(S.WEEK_DATE).alias("start"), F.max(S.WEEK_DATE).alias("end"))
              .select(*keys, "start", "end",
                      F.explode(F.sequence("start", "end", F.expr("INTERVAL 1 WEEK"))).alias(S.WEEK_DATE)))


def fill_week_grid(df: DataFrame, keys: Sequence[str] = S.SERIES_KEYS) -> DataFrame:
    """W8 + J1: left-join facts onto the grid; missing weeks become null rows.

    Used when the gap rows themselves are wanted; the temporal features do
    not need them (see positions below). Both sides are clustered by the
    series key, bounded by the calendar per series.
    """
    grid = week_grid(df, keys)
    return grid.join(df, on=[*keys, S.WEEK_DATE], how="left")


# ---------------------------------------------------------------------------
# Lags, rolling means, EWMA
# ---------------------------------------------------------------------------
#
# The features are defined on the gridded series: every week from the first
# to the last, gap weeks as null rows, a week straddling two months as two
# rows. Instead of materialising gap rows and joining (a second scan of the
# input and an extra shuffle), each fact row gets its position in that
# gridded series:
#
#     pos = (row_number - 1) + week_index - (dense_rank(week) - 1)
#
# i.e. fact rows before it plus gap weeks before it. Gap rows only ever add
# nulls, so "n rows back" is the row at pos - n (or none) and "the previous
# n rows" is the RANGE frame [pos - n, pos - 1] on the fact rows alone.

#
# A series is dealt into segments of gridded positions, and each segment also
# sees the rows of the segment before it. No window partition is longer than
# two segments, whatever the series' length, and EWMA weights, which count
# from the segment's start, stay in range. A segment is at least as long as
# every lag and rolling window, and so long that older values weigh under
# 1e-30 of the latest one.

POS = "_pos"
SEG = "_seg"
NEGLIGIBLE = 1e-30       # weight, relative to the latest value's, below which old values are left out
MICRO = 12               # places of the values that rolling means add up
LARGEST = 1e18           # magnitudes from here on count as infinite in rolling means and EWMA
_HIGH = 1 << 32          # two counts share a long


def series_window(keys: Sequence[str] = S.SERIES_KEYS):
    """``W``: per series, by week, ties (one week in two months) by year, month."""
    return Window.partitionBy(*keys).orderBy(S.WEEK_DATE, S.YEAR, S.MONTH)


def segment_length(lags: Sequence[int], sizes: Sequence[int], alphas: Sequence[float]) -> int:
    """Gridded rows of a segment."""
    least = max([1, *lags, *sizes])
    decay = [math.ceil(math.log(NEGLIGIBLE) / math.log(1.0 - a)) for a in alphas if 0.0 < a < 1.0]
    return max([least, *decay])


def with_series_position(df: DataFrame, keys: Sequence[str] = S.SERIES_KEYS, segment: int | None = None) -> DataFrame:
    """start/end of the series and each row's gridded position; with ``segment`` also ``_seg``, ``_own`` and copies.

    A row is copied into the following segment where the series has one; only rows with ``_own`` are results.
    """
    whole = Window.partitionBy(*keys)
    by_row = series_window(keys)
    by_week = Window.partitionBy(*keys).orderBy(S.WEEK_DATE)
    start = F.min(S.WEEK_DATE).over(whole)
    end = F.max(S.WEEK_DATE).over(whole)
    week_index = (F.datediff(F.col(S.WEEK_DATE), start) / 7).cast("long")
    pos = F.row_number().over(by_row) + week_index - F.dense_rank().over(by_week)
    out = df.select("*", start.alias("start"), end.alias("end"), pos.alias(POS))
    if segment is None:
        return out
    own = F.floor(F.col(POS) / segment)
    last = F.max(POS).over(whole)
    here = F.struct(own.alias(SEG), F.lit(True).alias("_own"))
    after = F.struct((own + 1).alias(SEG), F.lit(False).alias("_own"))
    marked = out.withColumn("_last", F.floor(last / segment))
    both = F.when(F.col("_last") > own, F.array(here, after)).otherwise(F.array(here))
    return marked.withColumn("_s", F.explode(both)).select(*out.columns, f"_s.{SEG}", "_s._own")


class _Running:
    """Running values of every column up to a row: exact sums, counts, and weighted sums for each alpha.

    Finite values are added in units of 10^-``MICRO`` as decimals, so a sum has no error and no order. NaN and infinities are
    counted apart (two counts to a long), so that they reach exactly the windows that hold them.
    """

    def __init__(self, df: DataFrame, cols: Sequence[str], alphas: Sequence[float], segment: int):
        self.cols, self.alphas, self.segment = list(cols), list(alphas), segment
        types = dict(df.dtypes)
        self.real = {c for c in cols if types[c] in ("double", "float")}

    def exprs(self, over: str) -> list[str]:
        """Running aggregates as SQL text (a column object per operator would make building the plan slow)."""
        out = []
        for i, c in enumerate(self.cols):
            x = _quoted(c)
            real = c in self.real
            finite = f"IF(abs({x}) < {LARGEST}D, {x}, NULL)" if real else x
            present = f"CAST(IF({x} IS NULL, 0, 1) AS BIGINT)"
            if real:
                micro = f"CAST(round({finite} * {10 ** MICRO}D) AS DECIMAL(31, 0))"
                present += f" + IF(isnan({x}), {_HIGH}L, 0L)"
                out.append(f"sum(IF({x} >= {LARGEST}D AND NOT isnan({x}), 1L, 0L) + IF({x} <= -{LARGEST}D, {_HIGH}L, 0L)) {over} AS h{i}")
            else:
                micro = f"CAST({x} AS DECIMAL(25, 0)) * CAST({10 ** MICRO} AS DECIMAL(13, 0))"
            out += [f"sum({micro}) {over} AS s{i}", f"sum({present}) {over} AS k{i}"]
            for j, a in enumerate(self.alphas):
                if a < 1.0:
                    out += [f"sum({finite} * _w{j}) {over} AS n{i}_{j}", f"sum(IF({x} IS NULL, NULL, _w{j})) {over} AS d{i}_{j}"]
        return out

    def weights(self) -> list[str]:
        return [f"exp(({POS} - {SEG} * {self.segment}) * {math.log(1.0 / (1.0 - a))!r}D) AS _w{j}" for j, a in enumerate(self.alphas) if a < 1.0]

    def packed(self) -> str:
        """The running values of a row as one struct of arrays, in column order."""
        m = range(len(self.cols))
        huge = [f"h{i}" if c in self.real else "0L" for i, c in enumerate(self.cols)]
        parts = [f"array({', '.join(f's{i}' for i in m)}) AS s", f"array({', '.join(f'k{i}' for i in m)}) AS k", f"array({', '.join(huge)}) AS h"]
        for j, a in enumerate(self.alphas):
            if a < 1.0:
                parts += [f"array({', '.join(f'{v}{i}_{j}' for i in m)}) AS {v}{j}" for v in "nd"]
        return f"struct({', '.join(parts)})"

    def _each(self, body: str) -> str:
        """An array with ``body`` for every column; ``i`` is its place. One small expression serves all columns."""
        return f"transform(sequence(0, {len(self.cols) - 1}), i -> {body})"

    @staticmethod
    def _settled(k: str, h: str, value: str) -> str:
        """``value`` unless the window's counts ``k`` and ``h`` tell of a NaN or an infinity."""
        return (f"CASE WHEN shiftright({k}, 32) = 0 AND {h} = 0 THEN {value} WHEN shiftright({k}, 32) > 0 OR (({h} & {_HIGH - 1}L) > 0 AND shiftright({h}, 32) > 0) "
                f"THEN double('NaN') WHEN shiftright({h}, 32) = 0 THEN double('Infinity') ELSE double('-Infinity') END")

    def rolling(self, n: int, least: int) -> str:
        """Means of the n rows before, of all columns, as ``_m<n>``."""
        before = f"_r{n + 1}"
        k, h = (f"(_r1.{v}[i] - coalesce({before}.{v}[i], 0L))" for v in "kh")
        total = f"_r1.s[i] - coalesce({before}.s[i], CAST(0 AS DECIMAL(38, 0)))"
        count = f"({k} & {_HIGH - 1}L)"
        mean = f"CAST(coalesce({total}, 0) AS DOUBLE) / CAST({count} AS DOUBLE) / {10 ** MICRO}D"
        return self._each(f"CASE WHEN {count} >= {max(1, least)} THEN {self._settled(k, h, mean)} END") + f" AS _m{n}"

    def ewma(self, j: int, least: int) -> str:
        """EWMA of all columns for the j-th alpha, as ``_e<j>``."""
        value = f"_r1.n{j}[i] / _r1.d{j}[i]" if self.alphas[j] < 1.0 else "_l1.x[i]"
        return self._each(f"CASE WHEN (_r1.k[i] & {_HIGH - 1}L) >= {max(1, least)} AND _l1.x[i] IS NOT NULL THEN {self._settled('_r1.k[i]', '_r1.h[i]', value)} END") + f" AS _e{j}"


def ewma_suffix(alpha: float) -> str:
    return str(alpha).replace("0.", "") + "a"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ewma_suffix(alpha: float) -> str:
    return str(alpha).replace("0.", "") + "a"


def temporal_feature_columns(df: DataFrame, exclude=S.TEMPORAL_EXCLUDE) -> list[str]:
    """Numeric columns that get temporal features (sorted for a stable layout)."""
    from yieldcast.operators.clean import numeric_columns
    return numeric_columns(df, exclude)


def temporal_features(df: DataFrame, cols: Sequence[str] | None = None,
                      lags: Sequence[int] = S.LAG_WEEKS, rolling: Sequence[int] = S.ROLLING_WEEKS,
                      rolling_long: Sequence[int] = S.ROLLING_WEEKS_LONG,
                      alphas: Sequence[float] = S.EWMA_ALPHAS, keys: Sequence[str] = S.SERIES_KEYS,
                      period: float | None = S.WEEK_PERIOD, num_partitions: int | None = None,
                      min_periods: int = S.EWMA_MIN_PERIODS) -> DataFrame:
    """All lag/rolling/EWMA columns in one projection over one shuffle.

    * lag n: the value n gridded rows back (null when that row is a gap);
    * rolling n: mean of the previous n rows when at least max(1, n // 2) are present, for the long sizes
      ``S.LONG_MIN_PERIODS``; exact on values of 12 places;
    * EWMA: for row t sum_{j<t} x_j (1-a)^(t-1-j) / sum_{j<t, x_j present} (1-a)^(t-1-j), null when fewer than
      ``min_periods`` values precede or the previous row is missing. Values and counts reach back to the start of the
      previous segment, at least ``segment_length`` rows.

    A NaN in a window makes its mean NaN, infinities make it infinite (both signs: NaN), windows without them are untouched.

    One hash exchange on the series key serves all windows. Every column's running values stand in one struct per row, and a
    frame picks one struct: five frames in all for the rolling means and EWMA, one per lag, instead of one per column. The exchange gets an
    explicit partition count (default: the session's ``spark.sql.shuffle.partitions``): this stage is CPU-bound while its input is small
    in bytes, and AQE would otherwise coalesce it by size into too few tasks. Output rows are the fact rows, with start/end of the series and the
    cyclic week.
    """
    cols = list(cols) if cols is not None else temporal_feature_columns(df)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = [(k, max(1, k // 2)) for k in rolling] + [(k, S.LONG_MIN_PERIODS) for k in rolling_long]
    segment = segment_length(lags, [k for k, _ in sizes], alphas)
    positioned = with_series_position(df.repartition(n, *keys), keys, segment)
    over = f"OVER (PARTITION BY {', '.join(map(_quoted, keys))}, {SEG} ORDER BY {POS} "
    running = _Running(df, cols, alphas, segment)
    held = [_quoted(c) for c in positioned.columns if c not in (SEG, "_own")]
    ends = sorted({1, *(k + 1 for k, _ in sizes)}) if sizes or alphas else []
    backs = sorted({*lags, *([1] if alphas else [])})
    if not cols:
        ends, backs, sizes, lags, alphas = [], [], [], [], []
    stage = positioned
    if ends:
        sums = running.exprs(over + "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
        stage = stage.selectExpr("*", *running.weights()).selectExpr(*held, SEG, "_own", *sums)
        stage = stage.selectExpr(*held, SEG, "_own", f"{running.packed()} AS _p")
    values = ", ".join(f"{_quoted(c)} AS v{i}" for i, c in enumerate(cols))
    if alphas:
        values += f", array({', '.join(f'CAST({_quoted(c)} AS DOUBLE)' for c in cols)}) AS x"
    stage = stage.selectExpr(*held, "_own", *[f"last(_p) {over}RANGE BETWEEN UNBOUNDED PRECEDING AND {m} PRECEDING) AS _r{m}" for m in ends],
                             *[f"first(struct({values})) {over}RANGE BETWEEN {m} PRECEDING AND {m} PRECEDING) AS _l{m}" for m in backs])
    means = [running.rolling(k, least) for k, least in sizes] + [running.ewma(j, min_periods) for j in range(len(alphas))]
    stage = stage.where("_own").selectExpr("*", *means)
    feats = [f"_l{m}.v{i} AS {_quoted(f'{c}_lag_{m}w')}" for i, c in enumerate(cols) for m in lags]
    feats += [f"_m{k}[{i}] AS {_quoted(f'{c}_rolling_{k}w')}" for k, _ in sizes for i, c in enumerate(cols)]
    feats += [f"_e{j}[{i}] AS {_quoted(f'{c}_ewma_{ewma_suffix(a)}')}" for j, a in enumerate(alphas) for i, c in enumerate(cols)]
    out = stage.selectExpr(*[c for c in held if c != _quoted(POS)], *feats)
    if period is not None:
        out = cyclic_week_features(out, period)
    return out
