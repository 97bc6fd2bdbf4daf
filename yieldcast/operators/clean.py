"""Projection, filtering and cleaning of raw records."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldcast import schema as S

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def null_profile(df: DataFrame) -> DataFrame:
    """P1 (lazy part): one row per column with its non-null count.

    A single aggregate pass (partial counts per task, one tiny shuffle), then
    ``stack`` to unpivot; ``all_null`` marks the columns to drop.
    """
    cols = df.columns
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    return (counts.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, non_null)")
            .withColumn("all_null", F.col("non_null") == 0))


def drop_all_null_columns(df: DataFrame, keep: Iterable[str] = S.CLEAN_COLUMNS) -> DataFrame:
    """Drop columns that hold only nulls (runs one aggregate action).

    Columns in ``keep`` are never dropped, so a required column that happens
    to be all null survives as nulls instead of failing the projection.
    """
    keep = set(keep)
    empty = {r["column_name"] for r in null_profile(df).filter("all_null").collect()}
    return df.drop(*[c for c in df.columns if c in empty and c not in keep])


def drop_excluded_recovery_type(df: DataFrame, value: str = S.EXCLUDED_RECOVERY_TYPE) -> DataFrame:
    """Remove one recovery_type value (null recovery_type rows go as well)."""
    return df.filter(F.col("recovery_type") != value)


def marketplace_mismatches(df: DataFrame) -> DataFrame:
    """P3 check: rows where marketplace_id differs from country."""
    return df.filter(~F.col("country").eqNullSafe(F.col("marketplace_id")))


def drop_marketplace(df: DataFrame) -> DataFrame:
    """Drop the redundant marketplace column."""
    return df.drop("marketplace_id")


def drop_missing_gl(df: DataFrame) -> DataFrame:
    """Keep rows with a known product group (not null, not -1)."""
    return df.filter(F.col(S.GL).isNotNull() & (F.col(S.GL) != -1))


def recovery_flag(df: DataFrame) -> DataFrame:
    """P5: recovery = 0 for Sales, 1 otherwise (null type counts as 1)."""
    flag = F.when(F.col("recovery_type") == S.SALES, F.lit(0)).otherwise(F.lit(1))
    return df.withColumn("recovery", flag)


def project_clean(df: DataFrame, columns: Sequence[str] = S.CLEAN_COLUMNS) -> DataFrame:
    """Fixed-order projection; missing carried columns come back as nulls."""
    present = set(df.columns)
    return df.select([F.col(c) if c in present else F.lit(None).cast("string").alias(c)
                      for c in columns])


def clean_records(df: DataFrame, drop_empty_columns: bool = False) -> DataFrame:
    """P1-P6 as one lazy chain.

    The fixed projection already removes any column outside the required
    list, so the all-null scan (P1) changes nothing in the result and costs a
    full extra pass over the raw data; it runs only when asked for.
    """
    if drop_empty_columns:
        df = drop_all_null_columns(df)
    return (df.transform(drop_excluded_recovery_type)
              .transform(drop_marketplace)
              .transform(drop_missing_gl)
              .transform(recovery_flag)
              .transform(project_clean))


def prediction_scope(df: DataFrame, years: Sequence[int] | None = None,
                     sites: Sequence[str] | None = None, gl_groups: Sequence[int] | None = None,
                     weeks: Sequence[int] | None = None) -> DataFrame:
    """Restrict rows to the scoring scope; default year = the latest year.

    The latest year is a one-row aggregate joined back by broadcast, so the
    whole thing stays one lazy plan (no driver round trip).
    """
    if years is None:
        latest = df.agg(F.max(S.YEAR).alias("_max_year"))
        df = (df.join(F.broadcast(latest), F.col(S.YEAR) == F.col("_max_year"), "inner")
                .drop("_max_year"))
    else:
        df = df.filter(F.col(S.YEAR).isin(list(years)))
    if sites is not None:
        df = df.filter(F.col(S.SITE).isin(list(sites)))
    if gl_groups is not None:
        df = df.filter(F.col(S.GL).isin(list(gl_groups)))
    if weeks is not None:
        df = df.filter(F.col(S.WEEK).isin(list(weeks)))
    return df


def split_by_years(df: DataFrame, train_years: Sequence[int], test_years: Sequence[int]):
    """(train, test) frames by year lists."""
    return (df.filter(F.col(S.YEAR).isin(list(train_years))),
            df.filter(F.col(S.YEAR).isin(list(test_years))))


def positive_rate(df: DataFrame, rate: str = S.RATE) -> DataFrame:
    """Rows with a non-zero target rate."""
    return df.filter(F.col(rate) > 0)


def binary_label(rate: str = S.RATE) -> F.Column:
    """P10: 1.0 when the rate is above zero."""
    return (F.col(rate) > 0).cast("double")


def resolve_features(present: Sequence[str], wanted: Sequence[str]) -> list[str]:
    """The wanted names among those present, in wanted order."""
    have = set(present)
    return [c for c in wanted if c in have]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns from the schema (no scan), sorted, minus ``exclude``."""
    ex = set(exclude)
    return sorted(f.name for f in df.schema.fields
                  if isinstance(f.dataType, _NUMERIC) and f.name not in ex)


def data_checks(df: DataFrame, rate: str = S.RATE, units: str = "units_total",
                predictions: Sequence[str] = ()) -> DataFrame:
    """One-row table counting rule violations (all in one aggregate)."""
    checks = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(units) <= 0).alias("n_units_not_positive"),
        F.count_if((F.col(rate) < 0) | (F.col(rate) > 1)).alias("n_rate_out_of_range"),
        F.count_if(F.col(rate).isNull()).alias("n_rate_null"),
    ]
    for p in predictions:
        checks.append(F.count_if((F.col(p) < 0) | (F.col(p) > 1)).alias(f"n_{p}_out_of_range"))
    return df.agg(*checks)


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The frame itself, or an error that names the columns it lacks."""
    lacking = sorted(set(names) - set(df.columns))
    if lacking:
        raise ValueError(f"missing columns: {lacking}")
    return df


def row_counts(**frames: DataFrame) -> DataFrame:
    """Rows of each named frame, and whether all hold equally many."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("frame"), "n_rows") for name, df in frames.items()]
    table = parts[0]
    for p in parts[1:]:
        table = table.unionAll(p)
    same = table.agg((F.min("n_rows") == F.max("n_rows")).alias("equal"))
    return table.crossJoin(F.broadcast(same))


def drop_gap_rows(df: DataFrame) -> DataFrame:
    """Remove the gap rows added by the week grid (no week number)."""
    return df.dropna(subset=[S.WEEK])
