"""Packing of tokenised documents into sequences by Karmarkar-Karp multiway differencing.

Each task tokenises its own documents and packs them; nothing is shuffled.
Whole windows of a long document are sequences of their own. The rests of
documents gather in a group; a full group is split into as many near-equal
windows as its tokens need. One rest in four is halved again and again: the
small pieces even out what the large ones leave.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 1024
GROUP_WINDOWS = 64       # windows that one differencing run fills
SLACK = 4                # tokens per window left free for imbalance
FINE_EVERY = 4           # one rest in so many is cut finely
FINE = 8                 # halving stops at this length

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def differencing(sizes: list[int], windows: int) -> list[int]:
    """Window of each size, by multiway largest differencing.

    A partial partition is a vector of window sums. The two with the largest
    spread are merged, the larger sums of one on the smaller sums of the
    other, until one is left. Ties keep the order of the input.
    """
    import numpy as np

    n = len(sizes)
    if windows == 1 or n == 0:
        return [0] * n
    heap = []
    sums = {}
    merges = []   # (left id, right id, order): slot j of the merge is slot order[j] of left and its mirror of right
    for i, size in enumerate(sizes):
        v = np.zeros(windows, dtype=np.int64)
        v[0] = size
        sums[i] = v
        heap.append((-size, i))
    heapq.heapify(heap)
    fresh = n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        merged = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(-merged, kind="stable")
        merged = merged[order]
        sums[fresh] = merged
        merges.append((a, b, order))
        heapq.heappush(heap, (int(merged[-1] - merged[0]), fresh))
        fresh += 1
    place = {heap[0][1]: np.arange(windows)}   # final window of each slot
    out = [0] * n
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        slots = place.pop(n + k)
        of_left = np.empty(windows, dtype=np.int64)
        of_left[order] = slots
        place[a], place[b] = of_left, of_left[::-1]
    for i in range(n):
        out[i] = int(place[i][0])
    return out


def pack_group(sizes: list[int], capacity: int = CAPACITY) -> list[int]:
    """Window of each size so that no window exceeds the capacity; the window count rises until that holds.

    Sizes are at most the capacity, so one window per size always holds.
    """
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        place = differencing(sizes, windows)
        filled = [0] * windows
        for size, w in zip(sizes, place):
            filled[w] += size
        if max(filled, default=0) <= capacity:
            return place
        windows += 1


def _encoder(path: str, markers: bool):
    """Text to ids under the byte-level BPE of a ``tokenizers`` file, run by tiktoken: same ids, several times faster.

    With ``markers``, added tokens that stand in a text become their own ids, as ``tokenizers`` has it by default;
    without, they are plain text (its ``encode_special_tokens``). Added tokens that tiktoken has no like of are left to
    ``tokenizers``.
    """
    import json

    import tiktoken

    spec = json.load(open(path, encoding="utf-8"))
    added = spec.get("added_tokens", [])
    if any(not t["special"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = not markers
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}
    special = {t["content"]: t["id"] for t in added}
    ranks = {bytes(byte_of[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
    from public_tokenizers import PATTERN
    encoding = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return partial(encoding.encode, allowed_special="all") if markers else encoding.encode_ordinary


def _tokenised(batches, path: str, end_id: int, markers: bool):
    """(doc_id, ids) of each row, ids with the end id."""
    import numpy as np

    encode = _encoder(path, markers)
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = encode(text.as_py() or "")
            ids.append(end_id)
            yield doc_id, np.array(ids, dtype="<u4")


def _pack_task(batches, path: str, end_id: int, capacity: int, markers: bool):
    import zlib

    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    base = TaskContext.get().partitionId() << 36
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    next_id = rests = 0
    rows: list[tuple] = []
    group: list[tuple] = []
    room = full = GROUP_WINDOWS * (capacity - SLACK)

    def close():
        nonlocal next_id
        place = pack_group([p[2] for p in group], capacity)
        used: dict[int, int] = {}
        for (doc_id, start, length, crc, total), w in zip(group, place):
            rows.append((doc_id, start, length, crc, total, base + next_id + w, used.get(w, 0)))
            used[w] = used.get(w, 0) + length
        next_id += max(place, default=-1) + 1
        group.clear()

    def table():
        out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)
        rows.clear()
        return out

    for doc_id, ids in _tokenised(batches, path, end_id, markers):
        total = len(ids)
        whole = total // capacity * capacity
        for start in range(0, whole, capacity):
            rows.append((doc_id, start, capacity, zlib.crc32(ids[start:start + capacity].tobytes()), total, base + next_id, 0))
            next_id += 1
        start = whole
        rests += start < total
        fine = rests % FINE_EVERY == 0
        while start < total:
            left = total - start
            length = min(-(-left // 2) if fine and left > FINE else left, room)   # no piece spans two groups
            group.append((doc_id, start, length, zlib.crc32(ids[start:start + length].tobytes()), total))
            start += length
            room -= length
            if room == 0:
                close()
                room = full
        if len(rows) >= 20_000:
            yield table()
    close()
    if rows:
        yield table()


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY,
         doc_id: str = "doc_id", text: str = "text", markers: bool = False) -> DataFrame:
    """Pieces of every document and their places in sequences of at most ``capacity`` tokens.

    A document's ids are those of its text under ``tokenizer`` (the path of
    a byte-level BPE file, present on every executor) and then ``end_id``; a null or
    empty text has that one id. With ``markers``, a special token that stands in a text is that token's id (the default
    of ``tokenizers``), else it is text like any other. Each id lies in exactly one piece. Pieces
    of a sequence follow each other without gaps. Rows are packed as they
    come: repeated rows and repeated or null ids are packed like any others. An empty
    table gives an empty result. Only the two named columns are read. Memory of a task:
    one Arrow batch, one document's ids, and a group of GROUP_WINDOWS windows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def task(batches: Iterator) -> Iterator:
        return _pack_task(batches, tokenizer, end_id, capacity, markers)

    return rows.mapInArrow(task, SCHEMA)
