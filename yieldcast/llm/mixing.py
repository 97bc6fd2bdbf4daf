"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they
belong to). A flow network routes each pattern's tokens to the quotas of its
sources; taking a pattern's tokens again costs more each time. The flow says how
many whole passes each pattern gets and how many tokens of one more; that
last part goes to documents in a seeded order.
"""

from __future__ import annotations

from collections import deque
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from yieldcast.llm.common import connected_components, scratch

MAX_PASSES = 3
SEED = 20_231
_BUCKETS = 4096


def share_targets(sizes: dict[str | None, int], weights: dict[str | None, float], total: float,
                  passes: int = MAX_PASSES) -> dict[str | None, float]:
    """Targets by weight, none above ``passes`` times its source's size; the excess is shared again by weight."""
    target = {s: 0.0 for s in sizes}
    open_, rest = [s for s in sizes if sizes[s] > 0], float(total)
    while open_:
        weight = sum(weights[s] for s in open_)
        full = [s for s in open_ if rest * weights[s] / weight > passes * sizes[s]]
        if not full:
            for s in open_:
                target[s] = rest * weights[s] / weight
            break
        for s in full:
            target[s] = float(passes * sizes[s])
            rest -= target[s]
            open_.remove(s)
    return target


def min_cost_flow(supply: list[int], members: list[list[int]], quota: list[int], passes: int = MAX_PASSES) -> list[list[int]]:
    """Tokens each pattern sends to each of its sources: a maximum flow of least cost.

    Pattern p may send its supply up to ``passes`` times; the r-th time costs r - 1 a
    token (convex, so earlier passes fill first). Successive shortest paths:
    every path fills an arc, so steps follow the size of the network, not the tokens.
    """
    n_p, n_s = len(supply), len(quota)
    source, sink = n_p + n_s, n_p + n_s + 1
    head: list[list[int]] = [[] for _ in range(n_p + n_s + 2)]
    to, cap, cost = [], [], []

    def arc(u, v, c, w):
        head[u].append(len(to)); to.append(v); cap.append(c); cost.append(w)      # noqa: E702
        head[v].append(len(to)); to.append(u); cap.append(0); cost.append(-w)     # noqa: E702

    for p in range(n_p):
        for r in range(passes):
            arc(source, p, supply[p], r)
    routes = {}
    for p in range(n_p):
        for s in members[p]:
            routes[p, s] = len(to)
            arc(p, n_p + s, passes * supply[p], 0)
    for s in range(n_s):
        arc(n_p + s, sink, quota[s], 0)
    while True:
        dist: list[float] = [float("inf")] * len(head)
        via = [-1] * len(head)
        queued = [False] * len(head)
        dist[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            queued[u] = False
            for e in head[u]:
                v = to[e]
                if cap[e] > 0 and dist[u] + cost[e] < dist[v]:
                    dist[v] = dist[u] + cost[e]
                    via[v] = e
                    if not queued[v]:
                        queued[v] = True
                        queue.append(v)
        if via[sink] < 0:
            break
        path, v = [], sink
        while v != source:
            path.append(via[v])
            v = to[via[v] ^ 1]
        push = min(cap[e] for e in path)
        for e in path:
            cap[e] -= push
            cap[e ^ 1] += push
    return [[cap[routes[p, s] + 1] if (p, s) in routes else 0 for s in range(n_s)] for p in range(n_p)]


def _boundaries(slim: DataFrame, wanted: DataFrame) -> DataFrame:
    """Key tuple up to which each pattern's documents, in seeded order, make up the wanted tokens.

    Tables with a row per pattern are written, so that Spark broadcasts them by their known size or not at all.
    ``slim``: pattern, size and the order keys o0, o1, ... (each key tells apart what the ones before leave
    equal). ``wanted``: pattern, rest. Each level sums per key inside the last boundary only, so no task
    orders more than one level's distinct keys of a pattern.
    """
    levels = [c for c in slim.columns if c[0] == "o"]
    found = scratch(wanted)
    for k, key in enumerate(levels):
        inside = slim.join(found, ["pattern", *levels[:k]]).where("rest > 0")
        sums = inside.groupBy("pattern", *levels[:k], key).agg(F.sum("size").alias("held"), F.first("rest").alias("rest"))
        w = Window.partitionBy("pattern").orderBy(key)
        upto = sums.withColumn("past", F.sum("held").over(w))
        # the last key whose start lies below the wanted tokens
        at = upto.where("past - held < rest").groupBy("pattern", *levels[:k]).agg(
            F.max_by(F.struct(F.col(key), (F.col("rest") - F.col("past") + F.col("held")).alias("rest"), "held"), key).alias("x"))
        found = scratch(at.select("pattern", *levels[:k], f"x.{key}", "x.rest", F.col("x.held").alias("held")))
    return found


def _split_flow(part, passes: int, quota: dict[int, int]):
    """Passes and further tokens of the patterns of one set of linked sources, by min-cost flow."""
    import pandas as pd

    part = part.sort_values("pattern")
    sources = sorted({int(i) for m in part["members"] for i in m})
    place = {i: k for k, i in enumerate(sources)}
    supply = [int(s) for s in part["supply"]]
    flow = min_cost_flow(supply, [[place[int(i)] for i in m] for m in part["members"]], [quota[i] for i in sources], passes)
    sent = [sum(f) for f in flow]
    return pd.DataFrame({"pattern": part["pattern"], "base": [f // s if s else 0 for f, s in zip(sent, supply)],
                         "rest": [f % s if s else 0 for f, s in zip(sent, supply)]})


def _planned(patterns: DataFrame, index: DataFrame, quota: dict[int, int], passes: int) -> DataFrame:
    """(pattern, base, rest): whole passes of each pattern and tokens of one more.

    A pattern whose only source belongs to no other pattern sends what that source wants. Other patterns share sources; sources that
    patterns link form independent flows, each solved in a task of its own.
    """
    member = patterns.select("pattern", F.posexplode("m").alias("at", "x"))
    known = member.join(index.withColumnRenamed("name", "n"), F.col("x").eqNullSafe(F.col("n"))).select("pattern", "at", "i", "quota")
    listed = known.groupBy("pattern").agg(F.array_sort(F.collect_list("i")).alias("members"), F.max("quota").alias("quota"))
    supplied = scratch(patterns.select("pattern", F.col("s").alias("supply")).join(listed, "pattern"))
    shared = (supplied.select("pattern", F.explode("members").alias("i")).groupBy("i").agg(F.count(F.lit(1)).alias("k"))
              .where("k > 1").select("i"))
    alone = supplied.where(F.size("members") == 1).withColumn("i", F.col("members")[0]).join(shared, "i", "left_anti")
    sent = F.least("quota", F.lit(passes) * F.col("supply"))
    whole = F.when(F.col("supply") > 0, F.call_function("div", sent, F.col("supply"))).otherwise(0).cast("long")
    rest = F.when(F.col("supply") > 0, sent % F.col("supply")).otherwise(0).cast("long")
    simple = alone.select("pattern", whole.alias("base"), rest.alias("rest"))
    linked = supplied.join(alone.select("pattern"), "pattern", "left_anti")
    if linked.isEmpty():
        return simple
    pairs = linked.where(F.size("members") > 1).select(F.col("members")[0].alias("a"), F.explode("members").alias("b")).where("a != b")
    roots = connected_components(pairs)
    group = F.coalesce("root", F.col("members")[0])
    grouped = linked.join(roots, F.col("members")[0] == F.col("node"), "left").select("pattern", "members", "supply", group.alias("group"))
    return simple.unionByName(grouped.groupBy("group").applyInPandas(partial(_split_flow, passes=passes, quota=quota), "pattern string, base long, rest long"))


def mix(docs: DataFrame, members: Column, size: Column, doc_id: str = "doc_id", *,
        weights=None, seed: int = SEED, passes: int = MAX_PASSES) -> DataFrame:
    """One row per input row: its columns, size, source_size, target, taken and passes taken.

    ``members``: array of the sources a row belongs to (null stands for a source of its own, last in order; null arrays
    and empty ones belong to none and are not taken). ``size``: tokens of a row. ``weights``: function
    from the sources in code point order to their weights; by default 1, 2, 3, 1, ... Targets share the
    total size; source_size and target are those of the row's first source. A row is taken whole, 0 to ``passes`` times.
    The seeded order depends on the id and, among equal ids, the size, so reruns agree however rows are split
    over tasks; equal rows are interchangeable. Sizes of 0 are taken 0. An empty table gives an empty result.
    Input columns named like a result column are replaced. On the driver: a row per source (its size and target).
    """
    results = ["size", "source_size", "target", "taken", "passes"]
    keep = [c for c in docs.columns if c not in results]
    u = F.xxhash64(F.lit(seed), F.col(doc_id), F.col("size"))
    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(doc_id),
                       F.array_sort(F.array_distinct(members)).alias("pattern_of"), F.element_at(members, 1).alias("first"),
                       size.cast("long").alias("size"))
    slim = scratch(slim.select(
        "row", F.to_json("pattern_of").alias("pattern"), "pattern_of", "first", "size",
        F.pmod(u, F.lit(_BUCKETS)).alias("o0"), F.pmod(F.shiftrightunsigned(u, 12), F.lit(_BUCKETS)).alias("o1"),
        u.alias("o2"), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(_BUCKETS)).alias("o3"),
        F.monotonically_increasing_id().alias("o4")))

    patterns = scratch(slim.groupBy("pattern").agg(F.first("pattern_of").alias("m"), F.sum("size").alias("s")).where(F.size("m") > 0))
    sizes = {r["x"]: r["s"] for r in patterns.select(F.explode("m").alias("x"), "s").groupBy("x").agg(F.sum("s").alias("s")).collect()}
    names = sorted(sizes, key=lambda x: (x is None, x))
    total = patterns.agg(F.sum("s")).first()[0] or 0
    given = weights(names) if weights else [1 + i % 3 for i in range(len(names))]
    target = share_targets(sizes, dict(zip(names, given)), total, passes)
    spark = docs.sparkSession
    quota = {i: round(target[x]) for i, x in enumerate(names)}
    index = spark.createDataFrame([(x, i, quota[i]) for i, x in enumerate(names)], "name string, i long, quota long")
    planned = scratch(_planned(patterns, index, quota, passes))
    order = ["o0", "o1", "o2", "o3", "o4"]
    edge = _boundaries(slim.select("pattern", "size", *order), planned.select("pattern", "rest"))
    edge = edge.select("pattern", F.struct(*order).alias("edge"),
                       (2 * F.col("rest") >= F.col("held")).alias("edge_in"))     # nearest: the last one goes in if half of it fits
    by_pattern = scratch(planned.select("pattern", "base").join(edge, "pattern", "left"))
    by_source = spark.createDataFrame([(x, sizes[x], target[x]) for x in names], T.StructType([
        T.StructField("first", T.StringType()), T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType())]))
    here = F.struct(*order)
    more = F.coalesce((here < F.col("edge")) | ((here == F.col("edge")) & F.col("edge_in")), F.lit(False))
    done = (slim.join(by_pattern, "pattern", "left")
            .join(by_source.withColumnRenamed("first", "f"), F.col("first").eqNullSafe(F.col("f")), "left")
            .withColumn("passes", F.coalesce(F.col("base") + more.cast("long"), F.lit(0))))
    return done.select(*[F.col("row").getField(c).alias(c) for c in keep], "size", "source_size", "target",
                       (F.col("size") * F.col("passes")).alias("taken"), "passes")
