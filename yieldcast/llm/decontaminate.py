"""Benchmark decontamination by winnowing.

Of every window of ten words the smallest hash of its five-word grams is kept as the window's fingerprint. The choice depends on the window's words alone, so a window that training text
shares with a benchmark item gives the same fingerprint on both sides: no shared span of ten words or more is missed. An item of fewer words is
one window of its own length, and documents are also winnowed at each such length. Fingerprints of both sides are
joined; a hit is extended to the windows around it and holds where all words of a window agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldcast.llm import bit_filter
from yieldcast.llm.byte_words import grams, kinds, parts, split_words
from yieldcast.llm.common import scratch

WINDOW = 10                          # words of a window
GRAM = 5                             # words of a fingerprinted gram
LETTERS = b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def winnow(h, row, width: int):
    """(window starts, fingerprints) of all windows of ``width`` words that lie within one row."""
    import numpy as np

    k = min(GRAM, width)
    n = max(0, len(h) - width + 1)
    g = grams(h, k)
    least = g[:n].copy()
    for j in range(1, width - k + 1):
        np.minimum(least, g[j:j + n], out=least)
    starts = np.flatnonzero(row[:n] == row[width - 1:width - 1 + n])
    return starts, least[starts]


def _window_keys(h, starts, width: int):
    """Two 64-bit hashes of the words of each window."""
    import numpy as np

    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    words = h[starts[:, None] + np.arange(width)].ravel()
    return tuple(grams(words, width, seed)[::width] for seed in (1, 2))


def _bench_task(batches: Iterator, window: int) -> Iterator:
    """Windows of the items: (item, m, f, h1, h2), each once per item of a batch."""
    import numpy as np
    import pyarrow as pa

    kind = kinds(words=LETTERS)
    for batch in batches:
        for first, data, at in parts(batch.column(1)):
            h, row, *_ = split_words(data, at, kind)
            count = np.bincount(row, minlength=len(at) - 1)
            for m in sorted(set(np.minimum(count, window).tolist()) - {0}):
                starts, f = winnow(h, row, m)
                own = np.minimum(count[row[starts]], window) == m
                starts, f = starts[own], f[own]
                h1, h2 = _window_keys(h, starts, m)
                item = batch.column(0).take(pa.array(first + row[starts]))
                yield pa.RecordBatch.from_arrays(
                    [item, pa.array(np.full(len(f), m, np.int32)), *[pa.array(x.view(np.int64)) for x in (f, h1, h2)]],
                    ["item", "m", "f", "h1", "h2"])


def _doc_task(batches: Iterator, lengths: list[int], filter_bits) -> Iterator:
    """(line, id, n_words, hits) of each row; a hit is one distinct window whose fingerprint may be a benchmark's."""
    import numpy as np
    import pyarrow as pa

    kind, bits = kinds(words=LETTERS), filter_bits.value
    for batch in batches:
        n_words = np.zeros(batch.num_rows, dtype=np.int64)
        found = []                   # (row, m, f, h1, h2, start) arrays
        for first, data, at in parts(batch.column(2)):
            h, row, *_ = split_words(data, at, kind)
            n_words[first:first + len(at) - 1] = np.bincount(row, minlength=len(at) - 1)
            begin = np.searchsorted(row, np.arange(len(at) - 1))
            for m in lengths:
                starts, f = winnow(h, row, m)
                may = bit_filter.may_hold(bits, f)
                starts, f = starts[may], f[may]
                h1, h2 = _window_keys(h, starts, m)
                found.append((first + row[starts], np.full(len(f), m, np.int32), f, h1, h2, starts - begin[row[starts]]))
        row, m, f, h1, h2, start = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else [()] * 6))
        order = np.lexsort((start, h2, h1, m, row))
        row, m, f, h1, h2, start = (x[order] for x in (row, m, f, h1, h2, start))
        new = np.ones(len(row), dtype=bool)
        if len(row):
            new[1:] = (row[1:] != row[:-1]) | (m[1:] != m[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        at = np.flatnonzero(new)
        spots = pa.ListArray.from_arrays(pa.array(np.append(at, len(row)), pa.int32()), pa.array(start, pa.int32()))
        hit = pa.StructArray.from_arrays([pa.array(m[at], pa.int32()), *[pa.array(x[at].astype(np.uint64).view(np.int64)) for x in (f, h1, h2)], spots],
                                         ["m", "f", "h1", "h2", "starts"])
        ends = np.searchsorted(row[at], np.arange(batch.num_rows + 1))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_words), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), hit)],
                                         ["line", "id", "n_words", "hits"])


def _cover_task(batches: Iterator) -> Iterator:
    """Words covered by a document's windows: (line, n_hit)."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        out = []
        for spans in batch.column(1):
            begin = np.concatenate([np.asarray(x["starts"].values) for x in spans])
            end = np.concatenate([np.asarray(x["starts"].values) + x["m"].as_py() for x in spans])
            order = np.argsort(begin, kind="stable")
            begin, reach = begin[order], np.maximum.accumulate(end[order])
            out.append(int((reach - np.maximum(begin, np.append(0, reach[:-1]))).clip(0).sum()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.int64())], ["line", "n_hit"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: its id, n_words, n_hit, n_items, items_sha256 and contaminated.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased. A window is ``window``
    consecutive words of an item, or all words of an item with fewer; a document word inside any occurrence of a window is hit.
    n_items counts the distinct item ids with an occurring window; items_sha256 is the lower-case hex SHA-256 of those ids, sorted as
    strings and comma-joined (of the empty string if there are none). A null text has no words and no hits; items without words have no
    windows; a null item id counts as an empty one. Repeated documents each get their own row; repeated items are one. Without
    items nothing is hit; without documents the result is empty. Only the named columns are read.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(item_text).cast("string").alias("text"))
    windows = scratch(items.mapInArrow(partial(_bench_task, window=window), "item string, m int, f long, h1 long, h2 long").distinct())
    prints = windows.select("m", "f").distinct()
    lengths = sorted(r[0] for r in windows.select("m").distinct().collect())
    bits = spark.sparkContext.broadcast(bit_filter.build(prints, "f"))

    numbered = docs.select(F.monotonically_increasing_id().alias("line"), F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    rows = scratch(numbered.mapInArrow(
        partial(_doc_task, lengths=lengths, filter_bits=bits),
        f"line long, id {dict(numbered.dtypes)['id']}, n_words long, hits array<struct<m:int,f:long,h1:long,h2:long,starts:array<int>>>"))

    key = ["m", "h1", "h2"]
    joined = rows.select("line", F.explode("hits").alias("x")).select("line", "x.*").join(prints, ["m", "f"], "left_semi")
    extended = scratch(joined.join(windows.select(*key).distinct(), key).select("line", *key, "starts"))

    # documents with the same windows share one list of items
    tag = [F.bit_xor(F.xxhash64(*cols)) for cols in (key, key[::-1])]
    pattern = F.concat_ws(" ", F.count(F.lit(1)), *tag)
    per_doc = scratch(extended.groupBy("line").agg(F.collect_list(F.struct("m", "starts")).alias("spans"), pattern.alias("pattern")))
    one = per_doc.groupBy("pattern").agg(F.min("line").alias("line"))
    listed = (extended.select("line", *key).join(one, "line").join(windows.select("item", *key).distinct(), key)
              .select("pattern", "item").distinct().groupBy("pattern").agg(F.sort_array(F.collect_list("item")).alias("items")))
    digest = listed.select("pattern", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    covered = per_doc.select("line", "spans").mapInArrow(_cover_task, "line long, n_hit long")
    hit = covered.join(per_doc.select("line", "pattern"), "line").join(digest, "pattern").drop("pattern")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return (rows.select("line", "id", "n_words").join(hit, "line", "left")
            .select(F.col("id").alias(doc_id), "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
                    F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (n_hit > 0).alias("contaminated")))
