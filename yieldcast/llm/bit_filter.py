"""Filters of 64-bit hashes with a bounded size: bits that tasks test before they give rows to a shuffle.

A filter lets every hash of its set pass and few others; fuller, it lets more pass, and an exact join or count behind it
drops them. Its size never exceeds ``MOST_BITS``, whatever the set's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27    # 16 MB at most


def build(hashes: DataFrame, column: str):
    """Bits, in 64-bit words, of the long column of a table: about sixteen for each row."""
    import numpy as np

    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * max(1, hashes.count()) - 1).bit_length()))
    slot = F.col(column).bitwiseAND(F.lit(bits - 1).cast("long"))
    words = (hashes.select(F.shiftright(slot, 6).alias("at"), F.expr(f"shiftleft(1L, cast(`{column}` & 63 as int))").alias("bit"))
             .groupBy("at").agg(F.bit_or("bit").alias("bits")))
    held = words.toPandas()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[held["at"].to_numpy(dtype=np.int64)] = held["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def may_hold(bits, h):
    """Which of the unsigned hashes may be in the set."""
    import numpy as np

    slot = h & np.uint64(len(bits) * 64 - 1)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
