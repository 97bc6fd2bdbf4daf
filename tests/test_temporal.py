"""Temporal features on hand-made series: gaps, duplicate weeks, short series, EWMA."""

import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from yieldcast.operators import temporal as W


def _series(spark, rows):
    # rows: (site, gl, year, month, week, week_date, x)
    return spark.createDataFrame(rows, "hashed_fc string, gl_product_group int, year int, month int, "
                                       "week int, week_date date, x double")


def _grid_reference(rows, n_lag, roll, alpha):
    """Brute force on the explicitly gridded series with pandas."""
    df = pd.DataFrame(rows, columns=["s", "g", "year", "month", "week", "wd", "x"])
    out = {}
    for (s, g), part in df.groupby(["s", "g"]):
        start, end = part.wd.min(), part.wd.max()
        weeks = pd.date_range(start, end, freq="7D").date
        grid = pd.DataFrame({"wd": weeks})
        full = grid.merge(part, on="wd", how="left").sort_values(["wd", "year", "month"], na_position="first")
        full = full.reset_index(drop=True)
        xs = full.x.tolist()
        for i, r in full.iterrows():
            if pd.isna(r.week):
                continue
            lag = xs[i - n_lag] if i - n_lag >= 0 else None
            window = [v for v in xs[max(0, i - roll):i] if not pd.isna(v)]
            rmean = sum(window) / len(window) if len(window) >= max(1, roll // 2) else None
            num = den = 0.0
            cnt = 0
            for j in range(i):
                if not pd.isna(xs[j]):
                    wgt = (1 - alpha) ** (i - 1 - j)
                    num += xs[j] * wgt
                    den += wgt
                    cnt += 1
            prev_ok = i >= 1 and not pd.isna(xs[i - 1])
            ew = num / den if (cnt >= 4 and prev_ok) else None
            out[(s, g, int(r.year), int(r.month), int(r.week))] = (lag, rmean, ew)
    return out


def _rows():
    d = dt.date(2022, 1, 3)
    wk = lambda k: d + dt.timedelta(days=7 * k)
    rows = []
    # series A: gap in the middle, one week straddling two months (two rows)
    for k, x in [(0, 1.0), (1, 2.0), (2, None), (3, 4.0), (6, 5.0), (7, 6.0), (8, 7.0), (9, 8.0), (10, 9.0)]:
        rows.append(("A", 1, 2022, 1 + k // 4, k + 1, wk(k), x))
    rows.append(("A", 1, 2022, 2 + 7 // 4, 8, wk(7), 60.0))  # duplicate week 8, other month
    # series B: short (3 rows) and one-row series C
    for k in range(3):
        rows.append(("B", 2, 2022, 1, k + 1, wk(k), float(k)))
    rows.append(("C", 3, 2022, 1, 1, wk(0), 5.0))
    # series D: long with gaps at the start region and after 52 weeks
    for k in list(range(0, 20)) + list(range(60, 75)):
        rows.append(("D", 4, 2022 + k // 52, 1, (k % 52) + 1, wk(k), float((k * 7) % 11)))
    return rows


@pytest.mark.parametrize("n_lag,roll,alpha", [(1, 4, 0.5), (4, 12, 0.1), (13, 4, 0.5)])
def test_positions_match_gridded_bruteforce(spark, n_lag, roll, alpha):
    rows = _rows()
    df = _series(spark, rows)
    out = W.temporal_features(df, cols=["x"], lags=[n_lag], rolling=[roll], rolling_long=[], alphas=[alpha],
                              period=None)
    got = {(r.hashed_fc, r.gl_product_group, r.year, r.month, r.week):
           (r[f"x_lag_{n_lag}w"], r[f"x_rolling_{roll}w"], r[f"x_ewma_{W.ewma_suffix(alpha)}"])
           for r in out.collect()}
    want = _grid_reference(rows, n_lag, roll, alpha)
    assert set(got) == set(want)
    for k, (a, b) in ((k, (got[k], want[k])) for k in want):
        for x, y in zip(a, b):
            if y is None or (isinstance(y, float) and math.isnan(y)):
                assert x is None, (k, a, b)
            else:
                assert x == pytest.approx(y, rel=1e-12, abs=1e-12), (k, a, b)


def test_week_grid_fills_gaps(spark):
    df = _series(spark, _rows())
    g = W.fill_week_grid(df)
    a = g.filter("hashed_fc = 'A'").collect()
    # 11 grid weeks + 1 duplicate-week row
    assert len(a) == 12
    assert sum(1 for r in a if r.week is None) == 2


def _weeks(values, first=dt.date(2000, 1, 3)):
    return [("S", 1, 2000, 1, 1, first + dt.timedelta(days=7 * k), v) for k, v in enumerate(values) if v != "gap"]


def _features(spark, values, **named):
    base = dict(cols=["x"], lags=[], rolling=[], rolling_long=[], alphas=[], period=None)
    rows = W.temporal_features(_series(spark, _weeks(values)), **(base | named)).orderBy("week_date").collect()
    return [[r[c] for c in rows[0].__fields__ if c.startswith("x_")] for r in rows]


def test_nan_and_infinity_reach_only_the_windows_that_hold_them(spark):
    values = [1.0, 1.0, float("nan"), 1.0, 1.0, 1.0, 1.0, 1.0, float("inf"), 1.0, float("-inf"), 1.0, 1.0, 1.0, 1.0, 2.0, 1e300]
    got = [r[0] for r in _features(spark, values, rolling=[4])]
    want = [None, None]
    for t in range(2, len(values)):
        w = values[max(0, t - 4):t]
        up, down = any(v >= 1e24 for v in w), any(v <= -1e24 for v in w)
        mean = math.nan if any(map(math.isnan, w)) or (up and down) else math.inf if up else -math.inf if down else sum(w) / len(w)
        want.append(mean)
    assert got[1] is None or got[1] == 1.0       # half the window is enough from the third row on
    for t in range(2, len(values)):
        assert got[t] == want[t] or (math.isnan(got[t]) and math.isnan(want[t])), t


def test_rolling_means_of_large_and_small_values_are_exact(spark):
    values = [1e13, 0.000001, 0.000002, 0.000003, 0.000004, 0.000005, -1e13, 1e13, 0.1, 0.2, 0.3, 0.4]
    got = [r[0] for r in _features(spark, values, rolling=[4])]
    assert got[5] == pytest.approx(2.5e-6, rel=1e-15) and got[11] == (1e13 + 0.6) / 4 or got[11] == pytest.approx((1e13 + 0.6) / 4, rel=1e-15)
    assert got[6] == pytest.approx(3.5e-6, rel=1e-15)


@pytest.mark.parametrize("alpha", [0.5, 0.1])
def test_ewma_of_a_long_series_equals_pandas(spark, alpha):
    values = [float((k * 37) % 101) + 0.25 for k in range(5000)]
    values[700:760] = ["gap"] * 60
    values[2000] = None
    got = [r[0] for r in _features(spark, values, alphas=[alpha])]
    full = pd.Series([math.nan if v in ("gap", None) else v for v in values])
    want = full.shift(1).ewm(alpha=alpha, adjust=True, ignore_na=False, min_periods=4).mean()
    prev = full.shift(1)
    want = [w if not pd.isna(p) else None for w, p, v in zip(want, prev, values) if v != "gap"]
    assert len(got) == len(want) == 4940
    for t, (x, y) in enumerate(zip(got, want)):
        assert (x is None) == (y is None or math.isnan(y)), t
        assert x is None or x == pytest.approx(y, rel=1e-12), t


def test_lags_and_means_cross_segment_borders(spark):
    values = [float(k % 17) for k in range(1500)]
    got = _features(spark, values, lags=[1, 52], rolling_long=[52], alphas=[0.5, 0.1])
    assert len(got) == 1500
    for t in range(60, 1500):
        assert got[t][0] == values[t - 1] and got[t][1] == values[t - 52]
        assert got[t][2] == pytest.approx(sum(values[t - 52:t]) / 52, rel=1e-12)


def test_integer_columns_and_empty_tables(spark):
    rows = [("S", 1, 2000, 1, 1, dt.date(2000, 1, 3) + dt.timedelta(days=7 * k), 2 ** 62 - k) for k in range(6)]
    df = spark.createDataFrame(rows, "hashed_fc string, gl_product_group int, year int, month int, week int, week_date date, x long")
    named = dict(cols=["x"], lags=[1], rolling=[4], rolling_long=[], alphas=[0.5], period=None)
    last = W.temporal_features(df, **named).orderBy(F.desc("week_date")).first()
    assert last["x_lag_1w"] == 2 ** 62 - 4 and last["x_rolling_4w"] == pytest.approx(2 ** 62 - 2.5)
    assert W.temporal_features(df.limit(0), **named).count() == 0
    assert W.temporal_features(df, cols=[], period=None).count() == 6


def test_segment_length():
    assert W.segment_length([52], [26], [0.5, 0.1]) == 656
    assert W.segment_length([52], [26], []) == 52
