"""Model feature lists (fixed values, generated by their naming rule)."""

from __future__ import annotations

from collections.abc import Sequence

from yieldcast import schema as S
from yieldcast.operators.clean import resolve_features

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

CATEGORICAL = ["hashed_fc", "gl_product_group", "country", "country_state", "site_type", "site_category"]
COMPOSITION = ["share_food", "share_non_food", "share_pet_food", "share_RETAIL", "share_FBA", "share_hazmat"]
VOLUME = ["units_total", "cogs_total", "weight_total", "avg_cogs_per_unit", "avg_weight_per_unit",
          "cogs_per_unit_weight"]
GL_AT_SITE = ["site_units_share_week", "site_weight_share_week"]
SITE_CONTEXT = ["site_units_total_week", "site_weight_total_week", "site_type", "site_category", "country",
                "country_state"]
CALENDAR = ["month", "week"]
STAGE3_CHANNELS = S.RECOVERY_CHANNELS
CHANNEL_SHORT = [c.removeprefix("prob_") for c in STAGE3_CHANNELS]

LAG_SUFFIXES = [f"lag_{n}w" for n in S.LAG_WEEKS]
ROLL_SUFFIXES = [f"rolling_{n}w" for n in S.ROLLING_WEEKS + S.ROLLING_WEEKS_LONG]
EWMA_SUFFIXES = ["ewma_5a", "ewma_1a"]
ALL_SUFFIXES = LAG_SUFFIXES + ROLL_SUFFIXES + EWMA_SUFFIXES


def temporal(base: str, suffixes: Sequence[str] = ALL_SUFFIXES) -> list[str]:
    return [f"{base}_{s}" for s in suffixes]


TEMPORAL_SITE_CONTEXT = (temporal("site_units_total_week", LAG_SUFFIXES)
                         + temporal("site_weight_total_week", LAG_SUFFIXES)
                         + temporal("site_prob_recovered_week", LAG_SUFFIXES + ROLL_SUFFIXES))
TEMPORAL_STAGE1 = [c for b in COMPOSITION + ["units_total", "cogs_total", "weight_total", S.RATE]
                   for c in temporal(b)]

STAGE1_FEATURES = (COMPOSITION + VOLUME + GL_AT_SITE + SITE_CONTEXT + TEMPORAL_SITE_CONTEXT + CALENDAR
                   + TEMPORAL_STAGE1)
STAGE2_BASELINE = ["site_gl_mean_rate", "site_gl_std_rate", "site_gl_n_nonzero_weeks"]
STAGE2_FEATURES = STAGE1_FEATURES + STAGE2_BASELINE
STAGE3_EXTRA = ([c for ch in CHANNEL_SHORT for c in temporal(f"prob_{ch}")]
                + [c for ch in CHANNEL_SHORT for c in temporal(f"site_prob_{ch}_week")])
STAGE3_BASELINE = ["baseline_share_mean", "baseline_share_std", "baseline_share_count"]
STAGE3_FEATURES = STAGE1_FEATURES + STAGE3_EXTRA + STAGE3_BASELINE

HUGE = 1.0e30        # stands for infinity where a quantile needs a finite value


def numeric_and_categorical(features: Sequence[str], present: Sequence[str]):
    """The features that a frame holds, in order, as (numeric, categories)."""
    feats = resolve_features(present, features)
    cats = [f for f in feats if f in CATEGORICAL]
    nums = [f for f in feats if f not in CATEGORICAL]
    return nums, cats
