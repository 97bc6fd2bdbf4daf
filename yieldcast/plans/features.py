"""Feature build: raw records -> weekly site x GL feature table.

Plan shape (what ``explain`` shows): scan with the cleaning filters pushed
down -> partial hash aggregate -> shuffle on the aggregation key -> final
aggregate -> shuffle on (site, week_date), shared by the second aggregate
level and the site-week window -> shuffle on (site, GL) for all series
windows -> write. Only the first shuffle sees raw-sized input, and it carries
map-side pre-aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from yieldcast import schema as S
from yieldcast.functions.scalar import round_floats
from yieldcast.operators import aggregate as A
from yieldcast.operators import clean as C
from yieldcast.operators import temporal as W


def weekly_table(raw: DataFrame, decimals: int | None = S.ROUND_DECIMALS) -> DataFrame:
    """Entry 2 without the temporal step: clean, aggregate, shares, site context."""
    df = (raw.transform(C.clean_records)
             .transform(A.aggregate_site_gl_week)
             .transform(A.consolidate_channels)
             .transform(A.unit_shares)
             .transform(A.recovery_mix)
             .transform(W.site_week_totals)
             .transform(W.gl_share_of_site)
             .transform(A.unit_averages))
    return round_floats(df, decimals) if decimals is not None else df


def feature_table(raw: DataFrame, period: float = S.WEEK_PERIOD,
                  decimals: int | None = S.ROUND_DECIMALS) -> DataFrame:
    """Entry 2: the full feature table (57 features + 627 temporal columns)."""
    weekly = weekly_table(raw, decimals)
    return W.temporal_features(weekly, period=period)
