"""Shared helpers: word splitting, let-binding in expressions, connected components."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldcast.session import checkpoint_dir

# The white space that separates words: space, tab, line feed, vertical tab,
# form feed, carriage return. A word is ``[^\x20\x09-\x0D]+``.
SPACE = " \t\n\x0b\x0c\r"
_SPACES = "[\\x20\\x09-\\x0D]+"


def word_array(text: Column) -> Column:
    """Words of a text; null and blank texts give an empty array."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACES))


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for null."""
    return F.size(word_array(text)).cast("long")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it any number of times in ``body``.

    A plain reference may be inlined by the optimizer into a lambda and then
    be evaluated once per element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def hold_out(doc_id: Column) -> Column:
    """True where crc32 of the id's text leaves remainder 1 by 3; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


_WRITTEN: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, kind: str = "table") -> str:
    """A new folder under the shared checkpoint folder; it is removed when the driver ends."""
    path = f"{checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(lambda: [remove(s, p) for s, p in _WRITTEN])
    _WRITTEN.append((spark, path))
    return path


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    if jvm is None or spark.sparkContext._jsc is None:      # the session has been stopped
        return
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def scratch(df: DataFrame, paths: list[str] | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: the plan is cut, and a lost executor costs a reread.

    A checkpoint would carry the plan's constraints along, which multiply in loops. ``paths`` gets the
    folder's path, for tables that a loop removes itself. ``codec`` is Parquet's, by default the session's.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path, compression=codec)
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


_ROWS_OF_A_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most ``rows`` rows in an Arrow batch to Python, for jobs run inside; a smaller setting of the session stands.

    A batch is held several times beside the executor's heap (vectors that double as they grow, the bytes sent to the
    worker), so whole partitions of wide rows would take hundreds of megabytes there.
    """
    before = spark.conf.get(_ROWS_OF_A_BATCH)
    if not 0 < int(before) <= rows:
        spark.conf.set(_ROWS_OF_A_BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_ROWS_OF_A_BATCH, before)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Remove scratch tables that no later plan reads, and let Spark drop the shuffle files of plans that are no longer referred to.

    Shuffle files go when the driver collects their plans, which a driver with little to do puts off.
    """
    import gc

    while paths:
        remove(spark, paths.pop())
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def connected_components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """Connected components of an undirected edge list: one row (node, root) per node with an edge.

    Root is the smallest node of the component. Every round each remaining
    vertex hooks onto its smallest neighbour, trees are flattened by pointer
    jumping, and edges are rewritten to the roots, so a round at least halves
    the vertices that still have edges. All state is distributed; lineage is
    cut in the shared checkpoint folder. Self loops and nulls are ignored.
    """
    spark, done = edges.sparkSession, []

    def pairs(df, x, y):
        return df.where(F.col(x) != F.col(y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()

    left = scratch(pairs(edges, src, dst), done)
    labels = left.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    first = True
    while not left.isEmpty():
        both = left.select("a", "b").unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = scratch(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("p"))
                         .select("node", F.least("node", "p").alias("root")), done)
        while True:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            jumped = scratch(parent.join(up, "root").select("node", "root", "higher"), done)
            moved = not jumped.where("root != higher").isEmpty()
            parent = jumped.select("node", F.col("higher").alias("root"))
            if not moved:
                break
        left = scratch(pairs(
            left.join(parent.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
                .join(parent.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b"), "ra", "rb"), done)
        if first:
            labels, first = parent, False
        else:
            step = parent.select(F.col("node").alias("root"), F.col("root").alias("top"))
            labels = scratch(labels.join(step, "root", "left").select("node", F.coalesce("top", "root").alias("root")), done)
    labels = scratch(labels)
    for path in done:
        remove(spark, path)
    return labels
