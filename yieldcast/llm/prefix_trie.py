"""Prefix trie of conversations by van Emde Boas recursion.

Levels of the trie are cut at half depth again and again: blocks of 1, 2, 4, ... levels. Going up a size, the last prefix before
a cut names what lies below it, so that after the largest block every turn holds a name of its whole prefix and turns of equal prefixes are one
node. All blocks of a size are worked on at once. Totals go the same way: in a block each node first has the total of
its subtree within its half; then the tops of the lower forests are grafted onto the upper trie, each adding its total to its ancestors
in the upper half. A top finds those among the turns of its smallest member, so a size never makes more rows than there are turns.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from yieldcast.llm.common import scratch, word_count

CHUNK = 256          # ids of one piece of a list that is hashed


def numbered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, at, tag, words): turns of each conversation numbered from 1, their content as a 128-bit hash, and words of the text.

    Order: turn, null first, then role and text, null ones being empty. Rows without an id take no part. Rows are dealt by ranges of the whole
    order, so that a conversation of any length is numbered by many tasks.
    """
    base = conversations.select(F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).where("conv is not null")
    order = ["turn", "role", "text", "row"]
    dealt = base.withColumn("row", F.monotonically_increasing_id()).repartitionByRange("conv", *order)
    content = F.concat(F.octet_length("role").cast("string"), F.lit(" "), "role", "text")
    local = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order))
    runs = scratch(dealt.withColumn("part", F.spark_partition_id()).select(
        "conv", "part", local.alias("at"), F.unhex(F.md5(content)).alias("tag"), word_count(F.col("text")).alias("words")))
    sizes = runs.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("k"))
    earlier = F.sum("k").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ahead = sizes.select("conv", "part", F.coalesce(earlier, F.lit(0)).alias("ahead"))
    return scratch(runs.join(ahead, ["conv", "part"]).select("conv", (F.col("at") + F.col("ahead")).alias("at"), "tag", "words"))


def with_shared_starts(turns: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Rebuilt conversations: the first h turns of conversation c - c % ``group``, then c's own after its first h.

    h is the unsigned crc32 of c in decimal, modulo ``most``. Fewer turns give all, a missing conversation none. Position 0 of
    every conversation is a root without content, so conversations that end up without turns stay.
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    first = turns.where(F.col("at") < most)
    convs = turns.select("conv").distinct().select("conv", h.alias("h"), (F.col("conv") - F.col("conv") % group).alias("from"))
    start = convs.join(first.select(F.col("conv").alias("from"), "at", "tag", "words"), "from").where("at <= h").select("conv", "at", "tag", "words")
    held = first.groupBy(F.col("conv").alias("from")).agg(F.max("at").alias("has"))
    shift = convs.join(held, "from", "left").select("conv", F.least(F.coalesce("has", F.lit(0)), "h").alias("got"))
    own = turns.where(F.col("at") > h).join(shift, "conv").select("conv", (F.col("at") - h + F.col("got")).alias("at"), "tag", "words")
    root = convs.select("conv", F.lit(0).cast("long").alias("at"), F.lit(b"").alias("tag"), F.lit(0).cast("long").alias("words"))
    return start.unionByName(own).unionByName(root)


def _sizes(depth: int) -> list[int]:
    """Exponents of the block sizes that lie below a trie of levels 0 to ``depth``."""
    return list(range(depth.bit_length()))


def _named(seqs: DataFrame, depth: int) -> DataFrame:
    """Give every position the name of its whole prefix: (conv, at, name, words)."""
    rows = scratch(seqs.select("conv", "at", F.col("tag").alias("name"), "words"))
    for r in _sizes(depth):
        low = F.shiftright("at", r).bitwiseAND(F.lit(1).cast("long")) == 1
        cut = F.shiftleft(F.shiftright("at", r), r) - 1
        lower = rows.where(low).withColumn("cut", cut)
        # last positions before a cut: those of the upper half whose successor starts the lower half
        last = rows.where(F.shiftleft(F.shiftright(F.col("at") + 1, r), r) == F.col("at") + 1).where(~low)
        above = last.select("conv", F.col("at").alias("cut"), F.col("name").alias("above"))
        renamed = lower.join(above, ["conv", "cut"]).select("conv", "at", F.unhex(F.md5(F.concat("above", "name"))).alias("name"), "words")
        rows = scratch(rows.where(~low).unionByName(renamed))
    return rows


def _list_task(batches: Iterator) -> Iterator:
    """Runs of sorted (name, conv) as pieces of comma-joined text: (name, first, ids)."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        name = batch.column(0).to_pylist()
        conv = np.asarray(batch.column(1))
        cut = [0, *[k for k in range(1, len(name)) if name[k] != name[k - 1]], len(name)]
        out = [(name[i], int(conv[i]), ",".join(map(str, conv[i:min(i + CHUNK, b)].tolist())))
               for a, b in zip(cut[:-1], cut[1:]) for i in range(a, b, CHUNK)]
        names, first, ids = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(first, pa.int64()), pa.array(ids, pa.string())], ["name", "first", "ids"])


def _digest_task(batches: Iterator) -> Iterator:
    """SHA-256 of the joined pieces of each name, read in order; only the running state is held."""
    import hashlib

    import pyarrow as pa

    now, state = None, None
    for batch in batches:
        out = []
        for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if name != now:
                if state:
                    out.append((now, state.hexdigest()))
                now, state = name, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _digests(out)
    if state:
        yield _digests([(now, state.hexdigest())])


def _digests(out):
    import pyarrow as pa

    names, sums = zip(*out) if out else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(sums, pa.string())], ["name", "ends_sha256"])


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """Nodes of the prefix trie of ``seqs``: (conv long, at long, tag binary, words long), positions 0 (the root), 1, 2, ... of each conv.

    Per node: conv_id (its smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves
    (childless nodes of its subtree), saved_tokens (words of each node's last turn times its members but one, summed over its subtree) and
    ends_sha256 (of the ids of the members that end there, ascending, comma-joined; of the empty string if none). Equal tags are equal turns.
    An empty table has no nodes. A list of ids is hashed as a stream, since SHA-256 has no other way: one task reads it, in pieces.
    """
    depth = seqs.agg(F.max("at")).first()[0]
    rows = _named(seqs, depth or 0)
    nodes = scratch(rows.groupBy(F.col("at").alias("depth"), "name").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words")))
    step = rows.select("conv", (F.col("at") + 1).alias("depth"), F.col("name").alias("parent"))
    linked = scratch(nodes.join(step, ["conv", "depth"], "left"))
    children = linked.where("parent is not null").groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    zero = F.lit(0).cast("long")
    totals = scratch(nodes.join(children, "name", "left").select(
        "name", "conv", "depth", F.coalesce("n_children", zero).alias("n_children"), F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved")))
    for r in _sizes(depth or 0):
        block = F.shiftright("depth", r)
        top = totals.where((block.bitwiseAND(F.lit(1).cast("long")) == 1) & (F.shiftleft(block, r) == F.col("depth")))
        grafts = top.select("conv", (block - 1).alias("block"), "leaves", "saved")
        above = rows.select("conv", F.shiftright("at", r).alias("block"), "name")
        added = above.join(grafts, ["conv", "block"]).groupBy("name").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        totals = scratch(totals.join(added, "name", "left").select(
            "name", "conv", "depth", "n_children", (F.col("leaves") + F.coalesce("more_leaves", zero)).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved")))

    last = rows.groupBy("conv").agg(F.max("at").alias("at"))
    ends = rows.select("conv", "at", "name").join(last, ["conv", "at"]).select("name", "conv")
    pieces = ends.repartitionByRange("name", "conv").sortWithinPartitions("name", "conv").mapInArrow(_list_task, "name binary, first long, ids string")
    digests = (pieces.repartition("name").sortWithinPartitions("name", "first").select("name", "ids")
               .mapInArrow(_digest_task, "name binary, ends_sha256 string"))
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv").alias("parent_conv_id"))
    whole = linked.join(totals.select("name", "n_children", "leaves", "saved"), "name").join(digests, "name", "left").join(parents, "parent", "left")
    return whole.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
