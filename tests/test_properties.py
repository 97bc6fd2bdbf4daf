"""Property tests (hypothesis): random series vs the gridded brute force; share bounds."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.test_temporal import _grid_reference, _series
from yieldcast.operators import temporal as W

week_steps = st.lists(st.tuples(st.integers(1, 9), st.booleans(), st.one_of(st.none(), st.floats(0, 100))),
                      min_size=1, max_size=40)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(week_steps, min_size=1, max_size=6))
def test_random_series_match_bruteforce(spark, series):
    rows = []
    d0 = dt.date(2020, 1, 6)
    for s_idx, steps in enumerate(series):
        k = 0
        for gap, dup, x in steps:
            k += 1 if gap > 6 else gap   # mostly consecutive, sometimes long gaps
            d = d0 + dt.timedelta(days=7 * k)
            rows.append((f"S{s_idx}", 1, 2020, 1, k + 1, d, x))
            if dup:   # the same week again in the next month
                rows.append((f"S{s_idx}", 1, 2020, 2, k + 1, d, None if x is None else x + 1))
    df = _series(spark, rows)
    out = W.temporal_features(df, cols=["x"], lags=[4], rolling=[12], rolling_long=[], alphas=[0.1], period=None)
    got = {(r.hashed_fc, r.gl_product_group, r.year, r.month, r.week): (r.x_lag_4w, r.x_rolling_12w, r.x_ewma_1a)
           for r in out.collect()}
    want = _grid_reference(rows, 4, 12, 0.1)
    assert set(got) == set(want)
    for k in want:
        for a, b in zip(got[k], want[k]):
            if b is None or b != b:   # pandas turns a missing value into NaN
                assert a is None, (k, got[k], want[k])
            else:
                assert a == pytest.approx(b, rel=1e-9, abs=1e-9), (k, got[k], want[k])


def test_shares_within_unit_interval(spark):
    from pyspark.sql import functions as F
    from yieldcast.plans.common import weekly
    from yieldcast.operators.aggregate import RECOVERY_MIX, UNIT_SHARES
    df = weekly(spark, "/root/testdata/sf0.001")
    # share_sales is |Sales| / |not Sales| in the source (a ratio, may exceed 1)
    cols = list(UNIT_SHARES) + [c for c in RECOVERY_MIX if c != "share_sales"]
    bad = df.select([F.count_if((F.col(c) < 0) | (F.col(c) > 1)).alias(c) for c in cols]).first()
    assert all(v == 0 for v in bad)
