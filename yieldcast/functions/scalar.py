"""Scalar column functions (all JVM-side built-in expressions, codegen friendly)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldcast import schema as S

__all__ = [
    "col_", "round_half_away", "fixed_point_mean", "safe_div", "ieee_div", "nan_to_zero", "round_floats", "iso_week_monday",
    "cyclic_week", "clipped_logit", "sigmoid", "sample_weight", "rate_bucket",
    "rate_bucket_order", "volume_bucket", "volume_bucket_order", "quarter", "horizontal_sum",
    "abs_error", "short_label", "fmt_value", "majority_flag", "nan_to_null",
]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """num / den with a zero (or null) denominator giving NULL."""
    num, den = col_(num), col_(den)
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def ieee_div(num, den) -> Column:
    """IEEE division (x/0 = +-inf, 0/0 = NaN) without tripping ANSI mode."""
    num, den = col_(num).cast("double"), col_(den).cast("double")
    return (
        F.when(den.isNull() | num.isNull(), F.lit(None).cast("double"))
        .when(den != 0, num / den)
        .when(F.isnan(num) | (num == 0), F.lit(float("nan")))
        .when(num > 0, F.lit(float("inf")))
        .otherwise(F.lit(float("-inf")))
    )


def nan_to_zero(c) -> Column:
    """``fill_nan(0)``: NaN becomes 0, null stays null."""
    return F.nanvl(col_(c), F.lit(0.0))


def nan_to_null(c) -> Column:
    c = col_(c)
    return F.when(~F.isnan(c), c)


def round_half_away(c, decimals: int = S.ROUND_DECIMALS) -> Column:
    """Round like ``(x * 10^d).round() / 10^d`` in binary floating point.

    This is the rule of the source pipeline's float rounding (and of DuckDB):
    the scaled value is rounded half away from zero. Spark's ``round`` on a
    double instead rounds its shortest decimal string, which differs on
    values such as 1050.1021875 (binary 1050.10218749999...).
    """
    scale = float(10 ** decimals)
    return F.round(col_(c) * F.lit(scale), 0) / F.lit(scale)


def fixed_point_mean(c, decimals: int = S.ROUND_DECIMALS) -> Column:
    """Mean of a column already rounded to ``decimals`` places, summed as integers.

    The sum of round(x * 10^d) is exact in any order, so the result does not
    depend on partitioning or summation order (a double sum does, in its last
    bit, which matters when a mean lands on a rounding tie):
    (sum / n) / 10^d with two IEEE divisions.
    """
    scale = float(10 ** decimals)
    x = col_(c)
    return F.sum(F.round(x * F.lit(scale)).cast("bigint")) / F.count(x) / F.lit(scale)


def round_floats(df: DataFrame, decimals: int = S.ROUND_DECIMALS) -> DataFrame:
    """round every float/double column in one projection."""
    return df.select([
        round_half_away(F.col(f.name), decimals).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def iso_week_monday(year, week) -> Column:
    """Monday of ISO week ``week`` of ``year`` (the week holding Jan 4, shifted)."""
    jan4 = F.make_date(col_(year), F.lit(1), F.lit(4))
    monday = F.to_date(F.date_trunc("week", jan4))
    return F.date_add(monday, (col_(week).cast("int") - 1) * 7)


def cyclic_week(week, period: float = S.WEEK_PERIOD) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*week/period."""
    angle = F.lit(2 * math.pi) * col_(week).cast("double") / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def clipped_logit(p, eps: float) -> Column:
    """logit of p clipped to [eps, 1 - eps]."""
    q = F.greatest(F.lit(eps), F.least(F.lit(1 - eps), col_(p).cast("double")))
    return F.log(q / (F.lit(1.0) - q))


def sigmoid(x, clip: bool = False) -> Column:
    """1 / (1 + exp(-x)); optionally clipped to [0, 1]."""
    s = F.lit(1.0) / (F.lit(1.0) + F.exp(-col_(x)))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), s)) if clip else s


def sample_weight(rate) -> Column:
    """F8: band weights emphasising 10-60% rates."""
    r = col_(rate)
    expr = F.when(F.lit(False), F.lit(0.0))
    for lo, hi, w in S.SAMPLE_WEIGHT_BANDS:
        cond = (r >= lo) if hi is None else ((r >= lo) & (r < hi))
        expr = expr.when(cond, F.lit(w))
    return expr.otherwise(F.lit(S.SAMPLE_WEIGHT_DEFAULT))


def rate_bucket(rate, inclusive: bool = False) -> Column:
    """zero / 0-10% / 10-30% / 30-60% / >60%.

    ``inclusive=False`` uses ``<`` at the edges (scoring); ``True`` uses ``<=``
    (exploration). NULL and NaN fall to ``>60%`` like a ``select`` default.
    """
    r = col_(rate)
    e1, e2, e3 = S.RATE_EDGES
    lt = (lambda a, b: a <= b) if inclusive else (lambda a, b: a < b)
    return (F.when(r == 0, "zero").when(lt(r, e1), "0-10%").when(lt(r, e2), "10-30%")
            .when(lt(r, e3), "30-60%").otherwise(">60%"))


def _ordinal(c, labels) -> Column:
    expr = F.when(F.lit(False), F.lit(0))
    for i, label in enumerate(labels):
        expr = expr.when(col_(c) == label, F.lit(i))
    return expr


def rate_bucket_order(bucket) -> Column:
    return _ordinal(bucket, S.RATE_BUCKETS)


def volume_bucket(units) -> Column:
    """<10 / 10-100 / 100-1k / >1k."""
    u = col_(units)
    a, b, c = S.VOLUME_EDGES
    return F.when(u < a, "<10").when(u < b, "10-100").when(u < c, "100-1k").otherwise(">1k")


def volume_bucket_order(bucket) -> Column:
    return _ordinal(bucket, S.VOLUME_BUCKETS)


def quarter(month) -> Column:
    """'Q1'..'Q4' from a month number."""
    return F.concat(F.lit("Q"), F.ceil(col_(month).cast("double") / 3).cast("int").cast("string"))


def horizontal_sum(cols, skip_nulls: bool = True) -> Column:
    """row sum; ``skip_nulls`` treats null terms as 0 (else null wins)."""
    terms = [F.coalesce(col_(c), F.lit(0)) if skip_nulls else col_(c) for c in cols]
    return reduce(lambda a, b: a + b, terms)


def abs_error(pred, actual) -> Column:
    """F14."""
    return F.abs(col_(pred) - col_(actual))


def short_label(c, n: int = 14) -> Column:
    """display form of a key -- cast to string, first n characters, ellipsis if cut."""
    s = col_(c).cast("string")
    return F.when(F.length(s) > n, F.concat(F.substring(s, 1, n), F.lit("\u2026"))).otherwise(s)


def fmt_value(feature, value) -> Column:
    """F16: display form of a feature's value: n/a, percent of shares and rates, whole units, else three places."""
    name, v = col_(feature), col_(value).cast("double")
    plain = [F.regexp_replace(F.format_number(x, k), ",", "") for x, k in ((v * 100, 1), (v, 3))]
    return (F.when(v.isNull() | F.isnan(v), F.lit("n/a"))
            .when(name.startswith("share_") | name.contains("prob_recovered"), F.concat(plain[0], F.lit("%")))
            .when(name.rlike("(units|cogs|weight)_total"), F.format_number(v, 0)).otherwise(plain[1]))


def majority_flag(share, threshold: float = 0.5) -> Column:
    """share above threshold."""
    return col_(share) > F.lit(threshold)
