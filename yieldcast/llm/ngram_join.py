"""N-gram Jaccard self-join by signature trees.

A text is the set of its distinct word shingles. Equal sets are one node of
the join from the start. The root level of the tree splits the rest by
signatures such that two sets within the threshold share one at least: the
shingle space is dealt by hash into more classes than two linked sets can differ in, so
some class holds the same shingles of both. Sets that share signatures form a
candidate family; a family's sets are put in order and cut into blocks of
bounded size. In and between blocks, trees whose nodes hold OR-combined token
bitmaps and size ranges are traversed in pairs; a node pair is dropped when its
largest possible overlap is too small, and at the leaves sets are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from yieldcast.llm.common import connected_components, release, scratch, small_batches, word_array

BLOCK = 256              # sets of a family in one block
LEAF = 8                 # sets in a leaf of a tree
FANOUT = 4
BITS = 4096              # width of a node's bitmap
RANGE = 1.5              # ratio of a size range's ends
ROWS_AT_ONCE = 256       # rows sent to a task at once
_MASK = (1 << 64) - 1


# -- shingle sets ------------------------------------------------------------

def _mix(x):
    """64-bit finaliser, vectorised (splitmix64)."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(word_hashes, width: int):
    """Sorted distinct 64-bit shingle hashes of a word-hash array; fewer words than the width make one shingle."""
    import numpy as np

    w = word_hashes.astype(np.uint64)
    if len(w) == 0:
        return w
    with np.errstate(over="ignore"):
        k = min(width, len(w))
        h = np.full(len(w) - k + 1, np.uint64(k))
        for j in range(k):
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + w[j:len(w) - k + 1 + j])
    return np.unique(h)


def _fingerprint(s) -> bytes:
    import hashlib

    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sets(batch, width: int):
    """The shingle set of each row of a batch whose column ``w`` holds word hashes."""
    import numpy as np

    column = batch.column(batch.schema.get_field_index("w"))
    flat = np.asarray(column.values).view(np.uint64)
    ends = np.asarray(column.offsets)
    for a, b in zip(ends[:-1], ends[1:]):
        yield shingle_set(flat[a:b], width)


# -- signatures --------------------------------------------------------------

def _range_low(i: int) -> int:
    """First size of range i."""
    return -int(-RANGE ** i // 1)


def _range_of(size: int) -> int:
    i = 0
    while _range_low(i + 1) <= size:
        i += 1
    return i


def _classes(i: int, percent: int) -> tuple[int, int, int]:
    """(classes, spare, least) for pairs whose smaller set is in range i.

    Sets x and y with J >= t differ in at most (1 - t) / (1 + t) * (|x| + |y|) shingles, so of
    ``differ + 1 + spare`` classes at least ``1 + spare`` hold the same shingles of both.
    """
    top = _range_low(i + 1) - 1
    differ = (100 - percent) * (top + top * 100 // percent) // (100 + percent)
    classes = differ + 1
    full = top / 1.25 / classes        # shingles in a usual class
    least = 2 if full > 5 else 1
    spare = 2 + classes // 8
    return classes + spare, spare, least


def _differ(size: int, i: int, percent: int) -> int:
    """Most shingles in which a set of this size differs from a linked one, if the smaller of both is in range i."""
    top = _range_low(i + 1) - 1
    other = size * 100 // percent if size <= top else top      # the smaller set of the pair, or the larger one
    return (100 - percent) * (size + other) // (100 + percent)


def signatures(s, percent: int):
    """(signatures, marks) of a set: for every size range in which it can be one of a linked pair, a hash per class.

    A set that differs from any linked one in at most d shingles agrees with it in all classes but d, so
    it may pass over one less than that. A class with few shingles says little and would gather unlinked sets: such weak
    classes are left out first, if no more of them are there. A mark holds the range and how many more of its
    classes may be passed over (see ``_candidate_pairs``), -1 if weak ones had to stay.
    """
    import numpy as np

    size = len(s)
    own = _range_of(size)
    out, marks = [], []
    for i in range(_range_of(-(-size * percent // 100)), own + 1):
        m, spare, least = _classes(i, percent)
        if m - spare == 1:                  # linked sets of such sizes are equal
            continue
        with np.errstate(over="ignore"):
            cls = (_mix(s ^ np.uint64(0xA24BAED4963EE407)) % np.uint64(m)).astype(np.int64)
            held = np.bincount(cls, minlength=m)
            total = np.zeros(m, dtype=np.uint64)
            np.add.at(total, cls, _mix(s))
            tag = np.uint64((i + 1) * 0x100000001B3 & _MASK) + np.arange(m, dtype=np.uint64)
            sig = _mix(_mix(total + held.astype(np.uint64)) ^ _mix(tag))
        strong = held >= least
        left = m - _differ(size, i, percent) - 1 - int(m - strong.sum())
        sig = sig[strong] if left >= 0 else sig
        out.append(sig)
        marks.append(np.full(len(sig), (i << 20) + max(left, -1) + 1, dtype=np.int32))
    if not out:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32)
    return np.concatenate(out), np.concatenate(marks)


def _candidate_pairs(sigs: DataFrame, paths: list[str]) -> DataFrame:
    """Edges (a, b) that connect the sets of each signature. ``sigs``: sig, mark, fp. ``paths`` gets the folder that the edges are read from.

    Passages that many texts share make common signatures, which would chain unlinked sets. Every set passes over as many of its
    signatures as its mark allows, the most common ones first. No link is lost: sets agree in one class more than either may
    pass over, classes that they agree in stand in the same order in both, so the least common of these is
    passed over by neither. Rows are sorted by signature (spilled if need be) and neighbours
    make an edge; no list of members is built.
    """
    count = F.count(F.lit(1)).over(Window.partitionBy("sig"))
    shared = scratch(sigs.withColumn("k", count).where("k > 1"), paths)
    place = F.dense_rank().over(Window.partitionBy("fp", "mark").orderBy(F.desc("k"), "sig"))
    kept = shared.withColumn("place", place).where("place > mark % 1048576 - 1").select("sig", "fp")
    before = F.lag("fp").over(Window.partitionBy("sig").orderBy("fp"))
    return (kept.withColumn("before", before).where("before is not null and before != fp")
            .select(F.col("before").alias("a"), F.col("fp").alias("b")))


# -- signature trees ---------------------------------------------------------

class Tree:
    """Signature tree over one block: leaves of LEAF sets in order, inner nodes of FANOUT nodes.

    Level arrays: ``bits`` (OR of the token bitmaps), ``low`` and ``high`` (size range), ``extra``
    (most tokens of a set beyond its distinct bits). Two sets under nodes A and B share at
    most popcount(bits A & bits B) + min(extra A, extra B) tokens.
    """

    def __init__(self, sets):
        import numpy as np

        self.sets = sets
        bits = np.zeros((len(sets), BITS // 64), dtype=np.uint64)
        for row, s in zip(bits, sets):
            at = s % np.uint64(BITS)
            np.bitwise_or.at(row, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        size = np.array([len(s) for s in sets])
        extra = size - np.bitwise_count(bits).sum(axis=1)
        self.levels = [(bits, size, size, extra)]
        step = LEAF
        while len(self.levels[-1][1]) > 1:
            b, lo, hi, ex = self.levels[-1]
            cut = np.arange(0, len(lo), step)
            self.levels.append((np.bitwise_or.reduceat(b, cut, axis=0), np.minimum.reduceat(lo, cut),
                                np.maximum.reduceat(hi, cut), np.maximum.reduceat(ex, cut)))
            step = FANOUT


def possible(a, i, b, j, percent: int):
    """Which node pairs (i of level a, j of level b) may hold a linked pair, by size ranges and largest overlap."""
    import numpy as np

    lo_a, hi_a, lo_b, hi_b = a[1][i], a[2][i], b[1][j], b[2][j]
    near = (100 * hi_b >= percent * lo_a) & (100 * hi_a >= percent * lo_b)
    overlap = np.bitwise_count(a[0][i] & b[0][j]).sum(axis=1) + np.minimum(a[3][i], b[3][j])
    return near & ((100 + percent) * overlap >= percent * (lo_a + lo_b))


def linked(x, y, percent: int) -> bool:
    """100 * intersection >= percent * union, exactly."""
    import numpy as np

    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def dual_traversal(left: Tree, right: Tree, percent: int, same):
    """Links that connect sets of two trees (or of one tree with itself), as (left index, right index).

    ``same(i, j)`` tells whether two sets are already in one component; such pairs
    need no comparison. Every pair that is linked and not yet connected when it is met is returned.
    """
    import numpy as np

    one = left is right
    la, lb = len(left.levels) - 1, len(right.levels) - 1
    pairs = (np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))
    while True:
        ok = possible(left.levels[la], pairs[0], right.levels[lb], pairs[1], percent)
        i, j = pairs[0][ok], pairs[1][ok]
        if (la == 0 and lb == 0) or not len(i):
            break

        def children(level, nodes, tree):
            step = LEAF if level == 1 else FANOUT
            first, count = nodes * step, len(tree.levels[level - 1][1])
            return [np.minimum(first + k, count) for k in range(step)], count

        if la >= lb:
            kids, count = children(la, i, left)
            i, j = np.concatenate(kids), np.tile(j, len(kids))
            inside, la = i < count, la - 1
        else:
            kids, count = children(lb, j, right)
            i, j = np.tile(i, len(kids)), np.concatenate(kids)
            inside, lb = j < count, lb - 1
        if one and la == lb:
            inside &= i <= j
        pairs = (i[inside], j[inside])
    if one:
        i, j = i[i < j], j[i < j]
    order = np.lexsort((j, i))
    for a, b in zip(i[order].tolist(), j[order].tolist()):
        if not same(a, b) and linked(left.sets[a], right.sets[b], percent):
            yield a, b


class _Union:
    """Disjoint sets over keys seen in one task."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        path = []
        while self.up.get(x, x) != x:
            path.append(x)
            x = self.up[x]
        for p in path:
            self.up[p] = x
        return x

    def join(self, a, b):
        self.up[self.find(a)] = self.find(b)


def _block_links(pdf, percent: int):
    """Links among the sets of one block, or across the two blocks of a pair (column ``side``)."""
    import numpy as np
    import pandas as pd

    pdf = pdf.sort_values(["side", "n", "sid"])
    union, found = _Union(), []
    sides = []
    for _, part in pdf.groupby("side", sort=True):
        sets = [np.frombuffer(b, dtype=np.uint64) for b in part["items"]]
        sides.append((list(part["sid"]), list(part["comp"]), Tree(sets)))
    (ids_a, comp_a, a), (ids_b, comp_b, b) = sides[0], sides[-1]
    for i, j in dual_traversal(a, b, percent, lambda i, j: union.find(comp_a[i]) == union.find(comp_b[j])):
        union.join(comp_a[i], comp_b[j])
        found.append((ids_a[i], ids_b[j]))
    return pd.DataFrame(found, columns=["a", "b"])


# -- the join ----------------------------------------------------------------

def _word_hashes(docs: DataFrame, text: str, lower: bool) -> DataFrame:
    t = F.col(text).cast("string")
    if lower:
        t = F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return docs.withColumn("w", F.transform(word_array(t), lambda x: F.xxhash64(x)))


def _read_task(batches: Iterator, width: int, percent: int) -> Iterator:
    """Set fingerprint, size and signatures of each row; a set that the task met before gives no signatures again."""
    import numpy as np
    import pyarrow as pa

    seen = set()
    for batch in batches:
        sids, sizes, sigs, marks = [], [], [], []
        for s in _sets(batch, width):
            sid = _fingerprint(s) if len(s) else None
            sids.append(sid)
            sizes.append(len(s))
            sig, mark = signatures(s, percent) if sid and sid not in seen else (np.zeros(0, np.uint64), np.zeros(0, np.int32))
            sigs.append(sig)
            marks.append(mark)
            seen.add(sid)
        short = [x and int.from_bytes(x[:8], "little", signed=True) for x in sids]
        ends = pa.array(np.cumsum([0, *map(len, sigs)]), pa.int32())
        both = pa.StructArray.from_arrays([pa.array(np.concatenate(sigs or [[]]).astype(np.uint64).view(np.int64)),
                                           pa.array(np.concatenate(marks or [[]]).astype(np.int32))], ["sig", "mark"])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sids, pa.binary()), pa.array(short, pa.int64()),
                                          pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(ends, both)], ["id", "sid", "fp", "n", "sigs"])


def _set_task(batches: Iterator, width: int) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        out = [(_fingerprint(s), s.tobytes(), len(s)) for s in _sets(batch, width)]
        sid, items, n = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(sid, pa.binary()), pa.array(items, pa.binary()), pa.array(n, pa.int64())],
                                         ["sid", "items", "n"])


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3,
                       percent: int = 90, lower: bool = True) -> DataFrame:
    """Per row: its id, n_shingles and component_id, the smallest id that links lead to (its own included).

    Links: 100 * intersection >= percent * union of the distinct ``width``-word shingle sets
    (words are runs of other than ASCII white space; A-Z are lower-cased if ``lower``). Fewer words than ``width``
    make one shingle of all of them; null, empty and blank texts have none and link with nothing. Rows with equal sets are
    linked, so repeated rows share a component. Null ids are passed over in the smallest id; a component without any id has null.
    An empty table gives an empty result. Only the two named columns are read.
    """
    base = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    hashed = _word_hashes(base, "text", lower)
    done: list[str] = []
    with small_batches(base.sparkSession, ROWS_AT_ONCE):
        signed = scratch(hashed.select("id", "w").mapInArrow(
            partial(_read_task, width=width, percent=percent),
            f"id {dict(base.dtypes)['id']}, sid binary, fp long, n long, sigs array<struct<sig:long,mark:int>>"), done)
    rows = scratch(signed.drop("sigs"))

    # Candidate families: sets that are connected by shared signatures.
    pairs = _candidate_pairs(signed.select(F.explode("sigs").alias("s"), "fp").select("s.sig", "s.mark", "fp"), done)
    family = connected_components(pairs)
    del signed, pairs
    release(base.sparkSession, done)

    # One representative row per candidate set, found by its id, gives the set again.
    members = rows.join(family, F.col("fp") == F.col("node"))
    reps = scratch(members.groupBy("sid", "n", "root").agg(F.min("id").alias("id")))
    labels = _links(base, reps, width, percent, lower)

    grouped = rows.join(labels, "sid", "left") if labels is not None else rows.withColumn("top", F.lit(None).cast("binary"))
    grouped = grouped.withColumn("top", F.coalesce("top", "sid"))
    # written, so that the join below has two exchanges of its own and a large component's rows can be split
    smallest = scratch(grouped.where("n > 0").groupBy("top").agg(F.min("id").alias("component_id")))
    return (grouped.join(smallest, "top", "left")
            .select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")))


def _links(base: DataFrame, reps: DataFrame, width: int, percent: int, lower: bool) -> DataFrame | None:
    """(sid, top): the component of every candidate set that has a link; None without candidates.

    Large families are compared in three steps, each between sets that are not yet connected: inside blocks, between
    neighbouring blocks, and the sets outside a family's largest component against all of its blocks.
    """
    if reps.isEmpty():
        return None
    wanted = reps.select(F.col("id").alias("rep")).distinct()
    found = _word_hashes(base.join(wanted, base["id"].eqNullSafe(wanted["rep"]), "left_semi"), "text", lower)
    sets = (found.select("w").mapInArrow(partial(_set_task, width=width), "sid binary, items binary, n long")
            .join(reps.select("sid", "root"), "sid").dropDuplicates(["sid"]))
    many = reps.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    done: list[str] = []
    with small_batches(base.sparkSession, ROWS_AT_ONCE):
        held = scratch(sets.join(many, "root").withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks"))), done)
    release(base.sparkSession, [])
    task, pair = partial(_block_links, percent=percent), "a binary, b binary"
    fields = ["sid", "n", "items", "comp"]

    inside = held.select("root", "block", "sid", "n", "items", F.col("sid").alias("comp"), F.lit(0).alias("side"))
    edges = scratch(inside.groupBy("root", "block").applyInPandas(task, pair), done)
    release(base.sparkSession, [])
    labels = _tops(edges)

    large = held.where("blocks > 1")
    if not large.isEmpty():
        now = _labelled(large, labels)
        ring = now.withColumn("at", F.explode(F.array(
            F.struct(F.col("block").alias("x"), F.lit(0).alias("side")),
            F.struct(F.pmod(F.col("block") - 1, F.col("blocks")).alias("x"), F.lit(1).alias("side")))))
        edges = scratch(edges.unionAll(ring.select("root", "at.x", "at.side", *fields).groupBy("root", "x").applyInPandas(task, pair)), done)
        release(base.sparkSession, [])
        labels = _tops(edges)

        now = scratch(_labelled(large, labels), done)
        main = (now.groupBy("root", "comp").agg(F.count(F.lit(1)).alias("k"))
                .groupBy("root").agg(F.max_by("comp", F.struct("k", "comp")).alias("main")))
        outside = now.join(main, "root").where("comp != main").drop("main")
        chunks = outside.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("chunks"))
        left = scratch(outside.join(chunks, "root").withColumn("chunk", F.pmod(F.xxhash64(F.lit(1), "sid"), F.col("chunks")))
                       .select("root", "chunk", "blocks", *fields), done)
        right = now.join(chunks, "root").select("root", "chunks", "block", *fields)
        release(base.sparkSession, [])
        passes = _passes(left, right, now)
        for number in range(passes):
            across = _crossed(left, right, number, passes, fields)
            edges = edges.unionAll(scratch(across.groupBy("root", "chunk", "y").applyInPandas(task, pair), done))
            del across
            release(base.sparkSession, [])
        labels = _tops(edges)
        del now, ring, main, outside, chunks, left, right
    del held, edges
    release(base.sparkSession, done)
    return labels


def _passes(left: DataFrame, right: DataFrame, held: DataFrame) -> int:
    """Passes over pairs of a chunk and a block, so that one copies about as many sets as are held: the disk of all would be that of their pairs."""
    copies = left.agg(F.sum("blocks")).first()[0] or 0
    copies += right.agg(F.sum("chunks")).first()[0] or 0
    return max(1, -(-int(copies) // max(1, held.count())))


def _crossed(left: DataFrame, right: DataFrame, number: int, passes: int, fields: list[str]) -> DataFrame:
    """The sets of the chunk and of the block of every pair (root, chunk, y) that is dealt to this pass."""
    def mine(chunk, y):
        return F.pmod(F.xxhash64("root", chunk, y), F.lit(passes)) == number

    def upto(count):
        return F.sequence(F.lit(0).cast("long"), F.col(count) - 1)

    one = left.select("root", "chunk", F.explode(F.filter(upto("blocks"), lambda y: mine(F.col("chunk"), y))).alias("y"), F.lit(0).alias("side"), *fields)
    two = right.select("root", F.explode(F.filter(upto("chunks"), lambda c: mine(c, F.col("block")))).alias("chunk"), F.col("block").alias("y"),
                       F.lit(1).alias("side"), *fields)
    return one.unionAll(two)


def _tops(edges: DataFrame) -> DataFrame:
    return connected_components(edges).select(F.col("node").alias("sid"), F.col("root").alias("top"))


def _labelled(held: DataFrame, labels: DataFrame) -> DataFrame:
    return held.join(labels, "sid", "left").withColumn("comp", F.coalesce("top", "sid")).drop("top")
