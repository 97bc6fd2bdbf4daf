"""Baselines, hierarchical priors, holdout and sampling.

Lookup tables derived from the data (site x GL, GL, site) are joined without
a broadcast hint: AQE measures the materialised side at runtime and switches
to a broadcast hash join only when it is below the broadcast threshold,
otherwise it stays a sort-merge join. Only one-row tables (global prior,
latest year, per-stratum quotas) are broadcast explicitly -- their size is
fixed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yieldcast import schema as S
from yieldcast.functions.scalar import fixed_point_mean

PAIR = [S.SITE, S.GL]
BASELINE_COLS = ["site_gl_mean_rate", "site_gl_std_rate", "site_gl_n_nonzero_weeks"]


def _mean(t, decimals):
    return fixed_point_mean(t, decimals) if decimals is not None else F.avg(t)


def site_gl_baseline(df_nz: DataFrame, target: str = S.RATE, decimals: int | None = S.ROUND_DECIMALS) -> DataFrame:
    """Per (site, GL) mean, sample std and count of the target.

    The target of the feature table is rounded to 6 places, so its mean is
    taken in fixed point (order-independent); ``decimals=None`` for others.
    """
    t = F.col(target)
    return df_nz.groupBy(*PAIR).agg(_mean(t, decimals).alias("site_gl_mean_rate"),
                                    F.stddev_samp(t).alias("site_gl_std_rate"),
                                    F.count(t).alias("site_gl_n_nonzero_weeks"))


def baseline_priors(df_nz: DataFrame, target: str = S.RATE,
                    decimals: int | None = S.ROUND_DECIMALS) -> dict[str, DataFrame]:
    """A10: GL prior, site prior and the one-row global prior."""
    t = F.col(target)
    return {
        "gl": df_nz.groupBy(S.GL).agg(_mean(t, decimals).alias("gl_mean_rate"), F.stddev_samp(t).alias("gl_std_rate")),
        "site": df_nz.groupBy(S.SITE).agg(_mean(t, decimals).alias("site_mean_rate"),
                                          F.stddev_samp(t).alias("site_std_rate")),
        "global": df_nz.agg(_mean(t, decimals).alias("global_mean_rate"), F.stddev_samp(t).alias("global_std_rate")),
    }


def prior_levels(df_nz: DataFrame, target: str = S.RATE, decimals: int | None = S.ROUND_DECIMALS) -> DataFrame:
    """A10 in one pass: GROUPING SETS ((GL), (site), ()) -> level, key, mean, std."""
    t = F.col(target)
    g = df_nz.groupingSets([[S.GL], [S.SITE], []], S.GL, S.SITE).agg(
        _mean(t, decimals).alias("mean_rate"), F.stddev_samp(t).alias("std_rate"),
        F.grouping_id().alias("_gid"))
    level = F.when(F.col("_gid") == 1, "gl").when(F.col("_gid") == 2, "site").otherwise("global")
    key = F.when(F.col("_gid") == 1, F.col(S.GL).cast("string")).when(F.col("_gid") == 2, F.col(S.SITE))
    return g.select(level.alias("level"), key.alias("key"), "mean_rate", "std_rate")


def join_baseline(df: DataFrame, baseline: DataFrame) -> DataFrame:
    """Left join of the (site, GL) baseline."""
    return df.join(baseline, on=PAIR, how="left")


def fill_baseline(df: DataFrame, priors: dict[str, DataFrame]) -> DataFrame:
    """Fill missing baseline values GL -> site -> global; count -> 0."""
    out = (df.join(priors["gl"], on=S.GL, how="left")
             .join(priors["site"], on=S.SITE, how="left")
             .crossJoin(F.broadcast(priors["global"])))
    return out.select(
        *[c for c in df.columns if c not in BASELINE_COLS],
        F.coalesce("site_gl_mean_rate", "gl_mean_rate", "site_mean_rate", "global_mean_rate").alias("site_gl_mean_rate"),
        F.coalesce("site_gl_std_rate", "gl_std_rate", "site_std_rate", "global_std_rate").alias("site_gl_std_rate"),
        F.coalesce(F.col("site_gl_n_nonzero_weeks"), F.lit(0).cast("bigint")).alias("site_gl_n_nonzero_weeks"),
    )


def join_pairs(df: DataFrame, looked_up: DataFrame) -> DataFrame:
    """Left join of a table with one row per (site, GL); null keys match each other."""
    right = looked_up.select(*[F.col(k).alias(f"_{k}") for k in PAIR], *[c for c in looked_up.columns if c not in PAIR])
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in PAIR]
    return df.join(right, on, "left").drop(*[f"_{k}" for k in PAIR])


def with_baselines(df: DataFrame, baseline: DataFrame, priors: dict[str, DataFrame], min_support: int | None = None) -> DataFrame:
    """J2, J3 and optionally C5: baseline columns of the wide rows by one join.

    Fallbacks are resolved on the distinct (site, GL) pairs, so the wide rows are shuffled once, by the pair.
    """
    pairs = fill_baseline(join_baseline(df.select(*PAIR).distinct(), baseline), priors)
    if min_support:
        pairs = shrink_low_support(pairs, priors, min_support)
    return join_pairs(df.drop(*BASELINE_COLS), pairs)


def shrink_low_support(df: DataFrame, priors: dict[str, DataFrame], min_support: int = S.MIN_SUPPORT) -> DataFrame:
    """Pairs seen in fewer than ``min_support`` weeks fall back to the priors."""
    low = F.col("site_gl_n_nonzero_weeks") < min_support
    df = df.withColumn("site_gl_mean_rate", F.when(~low, F.col("site_gl_mean_rate"))) \
           .withColumn("site_gl_std_rate", F.when(~low, F.col("site_gl_std_rate")))
    return fill_baseline(df, priors)


def unseen_share(df_joined: DataFrame) -> DataFrame:
    """Share of rows whose pair had no baseline (before filling)."""
    return df_joined.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("site_gl_mean_rate").isNull()).alias("n_unseen"),
        (F.count_if(F.col("site_gl_mean_rate").isNull()) / F.count(F.lit(1))).alias("unseen_share"))


# ---------------------------------------------------------------------------
# Hash-ordered sampling (M1-M4)
# ---------------------------------------------------------------------------

HASH_BUCKET_BITS = 16  # 65,536 buckets: the offset table has at most 65,536 rows per stratum


def hash_rank(df: DataFrame, key_cols: Sequence[str], seed: int = S.SEED,
              strata: Sequence[str] = ()) -> DataFrame:
    """Add ``_rank``: 1-based rank of each row by a hash of seed and keys within its stratum.

    The hash is the first 15 hex digits of the MD5 of ``seed|key|key...`` (nulls left out), so that any
    engine can rank the same rows.

    A global ``row_number`` would pull every row into one task. Instead the
    hash's top bits pick one of 65,536 buckets; a per-(stratum, bucket) count
    table gives each bucket's offset (a running sum over at most 65,536 rows
    per stratum), and the rank inside a bucket is a window over that bucket
    only. A stratum holding a third of all rows is still spread over all
    buckets. The result is exact and repeatable for a given seed.
    """
    hashed = df.select("*", _hash_order(key_cols, seed).alias("_h")).withColumn("_b", F.shiftright("_h", 60 - HASH_BUCKET_BITS))
    counts = hashed.groupBy(*strata, "_b").agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy(*strata).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*strata, "_b", F.coalesce(F.sum("_n").over(run), F.lit(0)).alias("_off"))
    in_bucket = Window.partitionBy(*strata, "_b").orderBy("_h", *key_cols)
    ranked = hashed.join(offsets, on=[*strata, "_b"], how="inner")
    return ranked.select(*df.columns, (F.col("_off") + F.row_number().over(in_bucket)).alias("_rank"))


def holdout_pairs(baseline: DataFrame, fraction: float = S.HOLDOUT_FRACTION, seed: int = S.SEED) -> DataFrame:
    """M1: exactly floor(fraction * n) (site, GL) pairs, chosen by seeded hash order."""
    n = baseline.agg(F.floor(F.count(F.lit(1)) * F.lit(fraction)).alias("_k"))
    ranked = hash_rank(baseline.select(*PAIR), PAIR, seed)
    return ranked.crossJoin(F.broadcast(n)).filter(F.col("_rank") <= F.col("_k")).select(*PAIR)


def holdout_share(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows, rows whose (site, GL) pair is held out, and their share."""
    marked = join_pairs(df.select(*PAIR), pairs.select(*PAIR, F.lit(1).alias("_held")))
    held = F.count("_held")
    return marked.agg(F.count(F.lit(1)).alias("n_rows"), held.alias("n_held_out"), F.try_divide(held.cast("double"), F.count(F.lit(1))).alias("held_out_share"))


def remove_pairs(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """Anti join on (site, GL)."""
    return df.join(pairs, on=PAIR, how="left_anti")


def _hash_order(key_cols: Sequence[str], seed: int):
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def mark_sample(df: DataFrame, n: int, key_cols: Sequence[str], seed: int = S.SEED, strata: Sequence[str] = (),
                per_stratum: bool = False) -> DataFrame:
    """Add ``_picked``: whether a row is among the n first of its stratum by the hash order of ``hash_rank``.

    With ``per_stratum`` n is shared out: max(1, n // #strata) each. Wide rows are not shuffled. Rows per (stratum, hash bucket) tell in which bucket
    the n-th row lies; the hashes of that bucket alone are ranked, which gives the hash of the n-th row. A row is picked if its hash is
    smaller; the few rows with just that hash are ranked by their keys.
    """
    strata = list(strata)
    hashed = df.withColumn("_h", _hash_order(key_cols, seed))
    null_safe = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_s{i}") for i, c in enumerate(strata)]
    null_safe += [F.col(c).isNull().alias(f"_z{i}") for i, c in enumerate(strata)]
    keys = [f"_s{i}" for i in range(len(strata))] + [f"_z{i}" for i in range(len(strata))]
    slim = hashed.select(*null_safe, "_h", F.shiftright("_h", 60 - HASH_BUCKET_BITS).alias("_b"))
    counts = slim.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    quota = F.lit(n).cast("bigint")
    if per_stratum:
        share = slim.select(*keys).distinct().agg(F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(n) / F.count(F.lit(1)))).alias("_q"))
        counts, quota = counts.crossJoin(F.broadcast(share)), F.col("_q")
    counts = counts.withColumn("_off", F.coalesce(F.sum("_n").over(run), F.lit(0).cast("bigint"))).withColumn("_want", quota - F.col("_off"))
    last = counts.where((F.col("_want") > 0) & (F.col("_want") <= F.col("_n"))).select(*keys, "_b", "_want")
    at = Window.partitionBy(*keys).orderBy("_h")
    ranked = slim.join(last, [*keys, "_b"]).withColumn("_r", F.row_number().over(at)).withColumn("_lo", F.rank().over(at))
    edge = ranked.where("_r = _want").select(*keys, F.col("_h").alias("_edge"), (F.col("_want") - F.col("_lo") + 1).alias("_ties"))
    if not strata:
        # one row at most: all rows are taken where there are fewer than n
        edge = edge.agg(F.first("_edge").alias("_edge"), F.first("_ties").alias("_ties"))
        both = hashed.crossJoin(F.broadcast(edge))
    else:
        both = hashed.select("*", *null_safe).join(edge, keys, "left")
    none = n <= 0
    by_key = Window.partitionBy(*keys).orderBy(*key_cols)
    sure = both.where(F.col("_edge").isNull() | (F.col("_h") != F.col("_edge")))
    sure = sure.select(*df.columns, (F.lit(not none) & (F.col("_edge").isNull() | (F.col("_h") < F.col("_edge")))).alias("_picked"))
    tied = both.where(F.col("_h") == F.col("_edge")).withColumn("_k", F.row_number().over(by_key))
    return sure.unionAll(tied.select(*df.columns, (F.col("_k") <= F.col("_ties")).alias("_picked")))


def sample_rows(df: DataFrame, n: int, key_cols: Sequence[str], seed: int = S.SEED) -> DataFrame:
    """M3: n rows (all when fewer), by seeded hash order."""
    return mark_sample(df, n, key_cols, seed).filter("_picked").drop("_picked")


def stratified_sample(df: DataFrame, n: int, stratum: str, key_cols: Sequence[str],
                      seed: int = S.SEED) -> DataFrame:
    """M2: equal count per stratum, max(1, n // #strata), capped by stratum size."""
    return mark_sample(df, n, key_cols, seed, [stratum], per_stratum=True).filter("_picked").drop("_picked")


def band_sample(df: DataFrame, n: int, key_cols: Sequence[str], rate: str = S.RATE,
                lo: float = 0.1, hi: float = 0.6, seed: int = S.SEED) -> DataFrame:
    """M4: n rows whose rate lies in [lo, hi)."""
    return sample_rows(df.filter((F.col(rate) >= lo) & (F.col(rate) < hi)), n, key_cols, seed)


# ---------------------------------------------------------------------------
# Class balance, site constancy, share baselines
# ---------------------------------------------------------------------------

def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """n_neg, n_pos and scale_pos_weight = n_neg / n_pos (null without positives)."""
    return df.agg(F.count_if(F.col(label) == 0).alias("n_neg"),
                  F.count_if(F.col(label) == 1).alias("n_pos")).select(
        "n_neg", "n_pos",
        F.when(F.col("n_pos") > 0, F.col("n_neg") / F.col("n_pos")).alias("scale_pos_weight"))


def with_class_weight(df: DataFrame, label: str = "label", weight: str = "weight") -> DataFrame:
    """Positive rows weighted by scale_pos_weight (one-row table, broadcast).

    Without negative rows that weight is 0 and would leave no row to fit: there is nothing to balance, all rows weigh 1.
    """
    bal = class_balance(df, label).select(F.when(F.col("n_neg") > 0, F.col("scale_pos_weight")).otherwise(F.lit(1.0)).alias("scale_pos_weight"))
    return (df.crossJoin(F.broadcast(bal))
              .withColumn(weight, F.when(F.col(label) == 1, F.col("scale_pos_weight")).otherwise(F.lit(1.0)))
              .drop("scale_pos_weight"))


def require_positives(df: DataFrame, label: str = "label") -> float:
    """A12 guard: raise when the training split has no positive rows."""
    row = class_balance(df, label).first()
    if not row["n_pos"]:
        raise ValueError("no positive samples in the training split")
    return float(row["scale_pos_weight"])


def site_rate_stats(df: DataFrame, rate: str = S.RATE) -> DataFrame:
    """Per-site mean and sample std of the rate."""
    return df.groupBy(S.SITE).agg(F.avg(rate).alias("mean_recovery_rate"),
                                  F.stddev_samp(rate).alias("std_recovery_rate"))


def constant_sites(stats: DataFrame, value: float) -> DataFrame:
    """Sites whose rate is always ``value`` (mean = value and std = 0)."""
    return stats.filter((F.col("mean_recovery_rate") == value) & (F.col("std_recovery_rate") == 0)).select(S.SITE)


def exclude_constant_sites(df: DataFrame, values: Sequence[float] = (1.0,), rate: str = S.RATE) -> DataFrame:
    """Drop sites that always recover everything (and/or nothing)."""
    stats = site_rate_stats(df, rate)
    for v in values:
        df = df.join(constant_sites(stats, v), on=S.SITE, how="left_anti")
    return df


def semi_join_keys(df: DataFrame, keys_df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keep rows whose key is in ``keys_df`` (IN (subquery))."""
    return df.join(keys_df.select(*on), on=list(on), how="left_semi")
