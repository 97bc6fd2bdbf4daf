"""Exact quantiles by distributed selection.

``percentile`` keeps a map of all distinct values of a group in one task. Here no task holds a group: rows are counted in equal ranges between a
group's least and largest value, the range that holds a wanted rank is cut into ranges again, and when a range holds few rows (or one value)
its rows alone are ranked. Each pass is one partial aggregation over the values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yieldcast.session import cut_lineage
from yieldcast.sources.stage import delete

RANGES = 1024            # ranges that a range is cut into
FEW = 10_000             # rows that may be ranked together
_MOST = 1.7976931348623157e308


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], few: int = FEW, ranges: int = RANGES) -> DataFrame:
    """Per group (one row without keys) the count ``n`` of values and the quantiles ``q0``, ``q1``, ... at ``probs``.

    Between two ranks the value is interpolated, as ``percentile`` does. Nulls and NaN are left out; infinite values count as the
    largest or least doubles and come back as infinite; a group without values has no row (without keys: n 0 and null quantiles). Null keys are a group.
    """
    group = [f"_g{i}" for i in range(len(keys))] + ["_one"]
    v = F.col(value).cast("double")
    base = df.select(*[F.struct(F.col(k).alias("k")).alias(f"_g{i}") for i, k in enumerate(keys)], F.lit(1).alias("_one"),
                     F.greatest(F.least(v, F.lit(_MOST)), F.lit(-_MOST)).alias("_v")).where(v.isNotNull() & ~F.isnan(v))
    base = base.persist(StorageLevel.MEMORY_AND_DISK)
    done: list[str] = []
    try:
        whole = base.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        at = F.array(*[F.lit(float(p)) for p in probs])
        ranks = F.array_distinct(F.flatten(F.transform(at, lambda p: F.array(F.floor(p * (F.col("n") - 1)), F.ceil(p * (F.col("n") - 1))))))
        state = cut_lineage(whole.select(*group, "n", "lo", "hi", F.explode(ranks).alias("rank"), F.lit(0).cast("long").alias("before"), F.col("n").alias("inside")), done)
        while True:
            wide = state.where((F.col("hi") > F.col("lo")) & (F.col("inside") > few))
            if wide.isEmpty():
                break
            spans = wide.select(*group, "lo", "hi").distinct()
            # halves, so that the distance of extreme values stays finite
            share = (F.col("_v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
            cell = F.least(F.floor(share * ranges), F.lit(ranges - 1))
            counts = (base.join(spans, group).where((F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi")))
                      .groupBy(*group, "lo", "hi", cell.alias("cell")).agg(F.count(F.lit(1)).alias("k"), F.min("_v").alias("to_lo"), F.max("_v").alias("to_hi")))
            run = Window.partitionBy(*group, "lo", "hi").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
            counts = counts.withColumn("ahead", F.coalesce(F.sum("k").over(run), F.lit(0).cast("long")))
            found = (wide.join(counts, [*group, "lo", "hi"])
                     .where((F.col("rank") - F.col("before") >= F.col("ahead")) & (F.col("rank") - F.col("before") < F.col("ahead") + F.col("k"))))
            cut = found.select(*group, "n", F.col("to_lo").alias("lo"), F.col("to_hi").alias("hi"), "rank", (F.col("before") + F.col("ahead")).alias("before"), F.col("k").alias("inside"))
            rest = state.where((F.col("hi") <= F.col("lo")) | (F.col("inside") <= few))
            state = cut_lineage(rest.unionByName(cut), done)
        settled = state.where("hi <= lo").select(*group, "rank", F.col("lo").alias("x"))
        small = state.where("hi > lo")
        spans = small.select(*group, "lo", "hi").distinct()
        ranked = base.join(spans, group).where((F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi")))
        ranked = ranked.withColumn("r", F.row_number().over(Window.partitionBy(*group, "lo", "hi").orderBy("_v")) - 1)
        near = small.join(ranked, [*group, "lo", "hi"]).where("rank - before = r").select(*group, "rank", F.col("_v").alias("x"))
        values = settled.unionByName(near).groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("rank", "x"))).alias("_x"))

        def quantile(p):
            where = F.lit(float(p)) * (F.col("n") - 1)
            low, high = F.floor(where), F.ceil(where)
            a, b = F.col("_x")[low], F.col("_x")[high]
            q = F.when(a == b, a).otherwise((high - where) * a + (where - low) * b)
            return F.when(q >= _MOST, F.lit(math.inf)).when(q <= -_MOST, F.lit(-math.inf)).otherwise(q)

        out = whole.select(*group, "n").join(values, group).select(
            *[F.col(f"_g{i}.k").alias(k) for i, k in enumerate(keys)], "n", *[quantile(p).alias(f"q{i}") for i, p in enumerate(probs)])
        if not keys:
            none = df.sparkSession.range(1).select(F.lit(0).cast("long").alias("n"), *[F.lit(None).cast("double").alias(f"q{i}") for i in range(len(probs))])
            out = out if base.limit(1).count() else none
        return cut_lineage(out)
    finally:
        base.unpersist()
        for path in done:
            delete(df.sparkSession, path)
