"""Exact top-k search by inner product with a pivot-distance index.

Vectors are mapped so that a larger inner product is a smaller distance: with M the
largest norm, x becomes (x, sqrt(M^2 - |x|^2)) and a query q becomes (q, 0), and then
|q - x|^2 = |q|^2 + M^2 - 2 <q, x>. Every vector is keyed by its nearest pivot and by the annulus of its
distance to it. A query visits the annuli nearest to it first; by the triangle inequality an annulus from r to
R around a pivot at distance d holds nothing nearer than max(r - d, d - R), so it stops when that passes its
k-th distance. Scores are integer inner products and exact; bounds leave room for rounding.

Vectors with a component too large for exact sums in doubles are not in the index. They are compared block by block
with all others in whole numbers of any size, and both results are merged by rank.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from yieldcast.llm.common import release, scratch, small_batches

PIVOTS = 32              # most pivots; fewer where the rows make fewer cells
RINGS = 16               # most annuli per pivot
CELL = 1024              # vectors in one cell; a larger annulus is split into several
QUERY_BLOCK = 1024       # queries of one pivot answered together
PASS_BYTES = 16 << 20    # query blocks sent to all tasks at once
CELLS_AT_ONCE = 16       # cells or blocks in an Arrow batch
FIRST_CELLS = 2          # annuli of the first round
DIGIT = 20               # bits of a digit of a large component
LIMIT = 1 << DIGIT       # vectors with a larger scaled component are not in the index: sums stay exact in doubles
SPAN = 4096              # components summed at once in doubles
_SLACK = 1e-6


def _matrix(column):
    """Rows of an Arrow list<int> column as a float matrix; shorter rows are filled with zeros."""
    import numpy as np

    ends = np.asarray(column.offsets)
    length = np.diff(ends)
    out = np.zeros((len(length), int(length.max(initial=0))))
    out[np.arange(out.shape[1]) < length[:, None]] = np.asarray(column.values)[ends[0]:ends[-1]]
    return out


def _unpacked(packed: bytes, rows: int, dim: int):
    """A matrix of whole numbers from the bytes that ``_packed`` gave."""
    import numpy as np

    return np.frombuffer(packed, dtype=np.int32).reshape(rows, dim) if rows * dim else np.zeros((rows, dim), dtype=np.int32)


def _packed(m) -> bytes:
    import numpy as np

    return m.astype(np.int32).tobytes()      # usable components are below LIMIT


def _wide(m, dim: int):
    import numpy as np

    return m if m.shape[1] == dim else np.hstack([m, np.zeros((len(m), dim - m.shape[1]))])


def _lift(m, top: float):
    """Rows with the extra coordinate that gives all of them the norm sqrt(top)."""
    import numpy as np

    return np.hstack([m, np.sqrt(np.maximum(top - (m * m).sum(axis=1), 0))[:, None]])


def _distances(a, b):
    import numpy as np

    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def _fits(e: Column, scale: int) -> Column:
    return F.forall(e, lambda x: x.isNotNull() & (F.abs(x.cast("double")) * scale < LIMIT))   # false for NaN and infinities


def usable(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(row, vec_id, v): scaled and floored integer vectors of the index. Vectors null or holding null or non-finite
    components take no part; those with components beyond LIMIT after scaling are given by ``large``."""
    e = F.col(embedding)
    return vectors.where(e.isNotNull() & _fits(e, scale)).select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(e, lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("v"))


def large(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(row, vec_id, v, x): finite vectors that ``usable`` leaves out, unscaled in ``x``; their rows are negative."""
    e = F.col(embedding)
    finite = F.forall(e, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(e.isNotNull() & finite & ~_fits(e, scale)).select(
        (-1 - F.monotonically_increasing_id()).alias("row"), F.col(vec_id).cast("long").alias("vec_id"),
        F.lit(None).cast("array<int>").alias("v"), e.cast("array<double>").alias("x"))


def _key_task(batches: Iterator, pivots, top: float) -> Iterator:
    import numpy as np
    import pyarrow as pa

    dim = pivots.shape[1] - 1
    for batch in batches:
        m = _lift(_wide(_matrix(batch.column(2)), dim), top)
        d = _distances(m, pivots)
        near = d.argmin(axis=1) if len(m) else np.zeros(0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(near, pa.int32()), pa.array(d[np.arange(len(m)), near])],
            ["row", "vec_id", "v", "pivot", "dist"])


def _pack_task(batches: Iterator) -> Iterator:
    """Cells as packed matrices, their vectors in the order of ids, null ids last."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        out = []
        for cell in batch.column(1):
            ids = cell.values.field("vec_id")
            order = np.lexsort((ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)))
            m = _matrix(cell.values.field("v"))[order]
            out.append((ids.take(pa.array(order)), _packed(m), m.shape[1]))
        ids, packed, dims = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.to_pylist() for x in ids], pa.list_(pa.int64())), pa.array(packed, pa.binary()),
                                          pa.array(dims, pa.int32())], ["annulus", "ids", "m", "dim"])


def build_index(vectors: DataFrame) -> tuple[DataFrame | None, dict, object, float]:
    """(cells, annuli, pivots, top) for usable vectors. Cells: annulus, ids, m (packed matrix), dim.

    Pivots are up to PIVOTS rows, spread by a hash of the vector, so copies of one vector give one pivot. Annuli
    (arrays of their ends, -1 to -1 and none where no vector lies) and pivots are bounded by PIVOTS * RINGS and held on the driver.
    """
    import numpy as np

    spark, done = vectors.sparkSession, []
    shape = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x.cast("long") * x)).alias("top"), F.max(F.size("v")).alias("dim")).first()
    if shape["dim"] is None:
        return None, {}, None, 0.0
    top, dim = float(shape["top"]), int(shape["dim"])
    wanted = -(-shape["n"] // CELL)
    n_pivots = min(PIVOTS, math.isqrt(wanted - 1) + 1)
    n_rings = min(RINGS, -(-wanted // n_pivots))
    hashed = vectors.select("v", F.xxhash64("v").alias("h"))
    hashes = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(n_pivots).collect()]
    chosen = {r["h"]: r["v"] for r in hashed.where(F.col("h").isin(hashes)).groupBy("h").agg(F.first("v").alias("v")).collect()}
    raw = np.zeros((len(hashes), dim))
    for o, h in zip(raw, hashes):
        o[:len(chosen[h])] = chosen[h]
    pivots = _lift(raw, top)
    keyed = scratch(vectors.mapInArrow(partial(_key_task, pivots=pivots, top=top),
                                           "row long, vec_id long, v array<int>, pivot int, dist double"), done)
    edges = {r["pivot"]: sorted(set(r["e"])) for r in keyed.groupBy("pivot").agg(
        F.percentile_approx("dist", [i / n_rings for i in range(1, n_rings)] or [1.0], 1000).alias("e")).collect()}
    cuts = F.array(*[F.array(*map(F.lit, edges.get(p, ()))).cast("array<double>") for p in range(len(hashes))])
    ring = F.size(F.filter(F.element_at(cuts, F.col("pivot") + 1), lambda x: F.col("dist") > x))
    ringed = keyed.withColumn("annulus", F.col("pivot") * n_rings + ring)
    annuli = {"pivot": np.arange(len(hashes) * n_rings) // n_rings, "low": np.full(len(hashes) * n_rings, np.inf), "high": np.full(len(hashes) * n_rings, -np.inf)}
    slots = [1] * (len(hashes) * n_rings)
    for a in ringed.groupBy("annulus").agg(F.min("dist").alias("low"), F.max("dist").alias("high"), F.count(F.lit(1)).alias("n")).collect():
        annuli["low"][a["annulus"]], annuli["high"][a["annulus"]] = a["low"], a["high"]
        slots[a["annulus"]] = -(-a["n"] // CELL)
    slot = F.pmod(F.xxhash64("row"), F.element_at(F.array(*map(F.lit, slots)), F.col("annulus") + 1))
    cells = ringed.groupBy("annulus", slot.alias("slot")).agg(F.collect_list(F.struct("vec_id", "v")).alias("rows")).select("annulus", "rows")
    with small_batches(spark, CELLS_AT_ONCE):
        cells = scratch(cells.mapInArrow(_pack_task, "annulus int, ids array<long>, m binary, dim int"))
    del keyed, ringed
    release(spark, done)
    return cells, annuli, pivots, top


def _plan_task(batches: Iterator, pivots, top: float, annuli: dict, first: bool) -> Iterator:
    """Blocks of queries as packed matrices, with the annuli each query still has to visit (bits by annulus) and those that any has to."""
    import numpy as np
    import pyarrow as pa

    dim = pivots.shape[1] - 1
    low, high = annuli["low"], annuli["high"]
    for batch in batches:
        out = []
        for block in batch.column(0):
            b = block.values
            q = _wide(_matrix(b.field("v")), dim)
            d = _distances(np.hstack([q, np.zeros((len(q), 1))]), pivots)[:, annuli["pivot"]]
            bound = np.maximum(np.maximum(low - d, d - high), 0)
            order = np.argsort(bound, axis=1, kind="stable")
            nearest = np.zeros_like(bound, dtype=bool)
            np.put_along_axis(nearest, order[:, :FIRST_CELLS], True, axis=1)
            if first:
                visit = nearest
            else:
                kth = np.array([np.nan if x is None else x for x in b.field("kth").to_pylist()], dtype=float)
                reach = np.sqrt(np.maximum((q * q).sum(axis=1) + top - 2 * kth, 0)) * (1 + _SLACK) + _SLACK
                visit = ~nearest & ~(bound > reach[:, None])     # without k scores yet, nothing is ruled out
            visit &= low <= high
            out.append((b.field("row").to_pylist(), b.field("vec_id").to_pylist(), b.field("kth").to_pylist(), _packed(q), q.shape[1],
                        np.packbits(visit.T, axis=1).tobytes(), np.flatnonzero(visit.any(axis=0)).tolist()))
        types = [pa.list_(pa.int64())] * 3 + [pa.binary(), pa.int32(), pa.binary(), pa.list_(pa.int32())]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * 7, types)],
                                         ["row", "query_id", "kth", "q", "q_dim", "visits", "annuli"])


def _scan_task(batches: Iterator, k: int) -> Iterator:
    """Candidates of the queries of a block in a cell that their annuli call for: the k best of each but those below k scores met before."""
    import numpy as np
    import pyarrow as pa

    known: dict = {}                         # by block: the least score that can still be among a query's k best
    for batch in batches:
        at = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        for x in range(batch.num_rows):
            rows, own = at["row"][x].values.to_numpy(), at["query_id"][x].values.to_numpy()
            stride = -(-len(rows) // 8)
            bits = np.frombuffer(at["visits"][x].as_buffer(), dtype=np.uint8)[at["annulus"][x].as_py() * stride:][:stride]
            asked = np.flatnonzero(np.unpackbits(bits, count=len(rows)))
            if not len(asked):
                continue
            least = known.get(rows[0])
            if least is None:
                least = known[rows[0]] = np.array([-np.inf if y is None else y for y in at["kth"][x].as_py()], dtype=np.float64)
            ids = at["ids"][x].values
            q = _unpacked(at["q"][x].as_buffer(), len(rows), at["q_dim"][x].as_py())[asked].astype(np.float64)
            m = _unpacked(at["m"][x].as_buffer(), len(ids), at["dim"][x].as_py()).astype(np.float64)
            dim = min(q.shape[1], m.shape[1])                    # beyond it one side is zero
            # no sum of products passes the product of the norms, so small ones are exact in single precision
            if (q * q).sum(axis=1).max() * (m * m).sum(axis=1).max() < 1 << 48:
                q, m = q.astype(np.float32), m.astype(np.float32)
            scores = q[:, :dim] @ m[:, :dim].T
            named = ids.fill_null(0).to_numpy(zero_copy_only=False)[:len(ids) - ids.null_count]
            first, last = np.searchsorted(named, own[asked]), np.searchsorted(named, own[asked], "right")
            for i in np.flatnonzero(first < last):
                scores[i, first[i]:last[i]] = -np.inf
            floor = least[asked].astype(scores.dtype)
            new = np.flatnonzero(floor == -np.inf)
            if len(new) and len(ids) > k:
                floor[new] = np.partition(scores[new], -k, axis=1)[:, -k]
            hit = (scores >= floor[:, None]) & (scores > -np.inf)
            for i in np.flatnonzero(hit.sum(axis=1) > 4 * k):
                cut = np.partition(scores[i], -k)[-k]
                hit[i] = scores[i] > cut
                hit[i, np.flatnonzero(scores[i] == cut)[:k]] = True
            i, c = np.nonzero(hit)
            score = scores[i, c].astype(np.int64)
            order = np.lexsort((c, -score, i))
            i, c, score = i[order], c[order], score[order]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            full = place == k - 1
            least[asked[i[full]]] = np.maximum(least[asked[i[full]]], score[full])
            i, c, score = i[place < k], c[place < k], score[place < k]
            yield pa.RecordBatch.from_arrays([pa.array(rows[asked[i]]), pa.array(own[asked[i]]), ids.take(pa.array(c)), pa.array(score)],
                                             ["row", "query_id", "vec_id", "score"])


def _visit(queries: DataFrame, cells: DataFrame, k: int, parts: list[int], passes: int, plan) -> DataFrame:
    """(row, query_id, vec_id, score, rank) of the cells that ``plan`` gives. ``queries``: row, vec_id, v, pivot, kth.

    Queries of a pivot make up blocks, since they visit much the same cells. Cells stay where they are: blocks are sent to them, in passes of
    bounded size.
    """
    spark = cells.sparkSession
    part = F.pmod(F.xxhash64("row"), F.element_at(F.array(*map(F.lit, parts)), F.col("pivot") + 1)).alias("part")
    blocks = queries.groupBy("pivot", part).agg(F.collect_list(F.struct("row", "vec_id", "v", "kth")).alias("queries")).select("queries")
    found = None
    with small_batches(spark, CELLS_AT_ONCE):
        blocks = scratch(blocks.mapInArrow(plan, "row array<long>, query_id array<long>, kth array<long>, q binary, q_dim int, visits binary, annuli array<int>"))
        for number in range(passes):
            sent = blocks.where(F.pmod(F.xxhash64(F.col("row")[0]), F.lit(passes)) == number)
            pairs = cells.join(F.broadcast(sent), F.array_contains("annuli", F.col("annulus"))).drop("annuli")
            one = scratch(pairs.mapInArrow(partial(_scan_task, k=k), "row long, query_id long, vec_id long, score long"))
            found = one if found is None else found.unionAll(one)
    return _best(found, k)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _whole(items, scale: int):
    """Matrix of Python integers of an Arrow struct column: ``v`` as it stands, else floor(scale * x)."""
    import numpy as np

    def one(x):
        y = x * scale
        return math.floor(y) if math.isfinite(y) else int(x) * scale    # beyond 2^53 a double has no fraction

    rows = [v if v is not None else [one(y) for y in x] for v, x in zip(items.field("v").to_pylist(), items.field("x").to_pylist())]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), dtype=object)
    for o, r in zip(out, rows):
        o[:len(r)] = r
    return out


def _digits(m):
    """(shift, float matrix) such that the matrices shifted left add up to ``m``; all entries below LIMIT."""
    import numpy as np

    sign, rest, out, shift = np.where(m < 0, -1, 1), np.abs(m), [], 0
    while rest.any():
        low = (rest & (LIMIT - 1)).astype(np.float64) * sign
        if low.any():
            out.append((shift, low))
        rest = rest >> DIGIT
        shift += DIGIT
    return out


def _products(a, b):
    """Inner products of the rows of two matrices of Python integers, exact at any size."""
    import numpy as np

    dim = min(a.shape[1], b.shape[1])      # beyond it one side is zero
    total = np.zeros((len(a), len(b)), dtype=object)
    right = _digits(b[:, :dim])
    for i, x in _digits(a[:, :dim]):
        for j, y in right:
            for at in range(0, dim, SPAN):
                part = x[:, at:at + SPAN] @ y[:, at:at + SPAN].T
                total += part.astype(np.int64).astype(object) << (i + j)
    return total


def _order(score: int) -> tuple[int, int | None, bytes | None]:
    """(side, score, key) in the order of scores: side 1 above the longs, -1 below them, where only the key tells them apart."""
    if -(1 << 63) <= score < 1 << 63:
        return 0, score, None
    size = (abs(score).bit_length() + 7) // 8
    key = size.to_bytes(4, "big") + abs(score).to_bytes(size, "big")
    return (1, None, key) if score > 0 else (-1, None, bytes(255 - x for x in key))


def _exact_task(batches: Iterator, k: int, scale: int) -> Iterator:
    """The k best candidates of each query in one block, by exact products."""
    import numpy as np
    import pyarrow as pa

    types = [pa.int64(), pa.int64(), pa.int64(), pa.int8(), pa.int64(), pa.binary()]
    for batch in batches:
        for cell, queries in zip(batch.column(0), batch.column(1)):
            c, q = cell.values, queries.values
            ids = c.field("vec_id").to_pylist()
            by_id = np.array(sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0)))
            scores = _products(_whole(q, scale), _whole(c, scale)[by_id])
            out = []
            for row, own, line in zip(q.field("row").to_pylist(), q.field("vec_id").to_pylist(), scores):
                taken = 0
                for i in np.argsort(-line, kind="stable"):
                    if taken == k:
                        break
                    if (other := ids[by_id[i]]) != own:
                        out.append((row, own, other, *_order(int(line[i]))))
                        taken += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)],
                                                 ["row", "query_id", "vec_id", "side", "score", "key"])


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Rows gathered in blocks of about ``size``, one list a row."""
    n = max(1, -(-rows.count() // size))
    return scratch(rows.groupBy(F.pmod(F.xxhash64("row"), F.lit(n)).alias("block"))
                   .agg(F.collect_list(F.struct("row", "vec_id", "v", "x")).alias(name)).select(name))


def _exact(queries: DataFrame, candidates: DataFrame, k: int, scale: int) -> DataFrame:
    """(row, query_id, vec_id, side, score, key): k best of every block of candidates for each query."""
    pairs = _blocks(candidates, CELL, "rows").crossJoin(_blocks(queries, QUERY_BLOCK, "queries"))
    return pairs.select("rows", "queries").mapInArrow(
        partial(_exact_task, k=k, scale=scale), "row long, query_id long, vec_id long, side byte, score long, key binary")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256,
          vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k highest integer inner products with rows of other ids.

    Components are floor(scale * x). Ties go to the smaller id. ``is_query`` picks the query rows by their columns;
    all rows with finite components are candidates but those with the query's own id. Vectors of different lengths are
    compared as if filled up with zeros. A repeated row is a candidate each time it stands, and a repeated query row is answered
    each time. Null ids are candidates, after all others in ties, and answer no query. An empty table gives an empty result.
    Ranks are exact at any size of the components; a score that no long can hold is null.
    """
    picked = vectors.where(is_query & F.col(vec_id).isNotNull())
    rows = usable(vectors, vec_id, embedding, scale)
    queries = scratch(usable(picked, vec_id, embedding, scale))
    found = _indexed(rows, queries, k)
    beyond = scratch(large(vectors, vec_id, embedding, scale))
    if not beyond.isEmpty():
        asked = scratch(large(picked, vec_id, embedding, scale))
        empty = F.lit(None).cast("array<double>").alias("x")
        everyone = beyond.unionAll(rows.select("row", "vec_id", "v", empty))
        far = _exact(queries.select("row", "vec_id", "v", empty), beyond, k, scale)
        if not asked.isEmpty():
            far = far.unionAll(_exact(asked, everyone, k, scale))
        near = found.select("row", "query_id", "vec_id", F.lit(0).cast("byte").alias("side"), "score", F.lit(None).cast("binary").alias("key"))
        order = Window.partitionBy("row").orderBy(F.desc("side"), F.desc("score"), F.desc("key"), F.asc_nulls_last("vec_id"))
        found = near.unionAll(far).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def _indexed(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(row, query_id, vec_id, score, rank) by the index of ``rows``."""
    cells, annuli, pivots, top = build_index(rows)
    if cells is None:
        return rows.sparkSession.createDataFrame([], "row long, query_id long, vec_id long, score long, rank int")
    asked = scratch(queries.mapInArrow(partial(_key_task, pivots=pivots, top=top), "row long, vec_id long, v array<int>, pivot int, dist double"))
    held = {r["pivot"]: r["count"] for r in asked.groupBy("pivot").count().collect()}
    parts = [-(-held.get(p, 1) // QUERY_BLOCK) for p in range(len(pivots))]
    row_bytes = 4 * pivots.shape[1] + len(annuli["low"]) // 8 + 24
    passes = max(1, -(-sum(held.values()) * row_bytes // PASS_BYTES))
    plan = partial(_plan_task, pivots=pivots, top=top, annuli=annuli)
    first = scratch(_visit(asked.withColumn("kth", F.lit(None).cast("long")), cells, k, parts, passes, partial(plan, first=True)))
    kth = first.where(F.col("rank") == k).select("row", F.col("score").alias("kth"))
    rest = _visit(asked.join(kth, "row", "left"), cells, k, parts, passes, partial(plan, first=False))
    return _best(first.unionAll(rest).drop("rank"), k)
