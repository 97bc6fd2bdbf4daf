"""Words of whole Arrow string columns as 64-bit hashes, worked out on UTF-8 bytes with numpy.

A byte is part of a word, a gap between words, or a break between pieces of a text. All bytes of characters
beyond ASCII are of one kind, so bytes settle the same words as code points do. A-Z count as a-z.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

WORD, GAP, BREAK = 0, 1, 2
PART_BYTES = 1 << 18         # bytes worked on at once; one longer text is a part of its own
_ODD = 0x9E3779B97F4A7C15    # base of the polynomial over a word's bytes


def mix(x):
    """64-bit finaliser (splitmix64), vectorised."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _byte_values():
    """A value for every byte, the same for both cases of a letter."""
    import numpy as np

    v = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
    v[65:91] = v[97:123]
    return v


_POWERS: dict = {}


def _powers(n: int):
    """Powers 0 to n of the base, and of its inverse, modulo 2^64."""
    import numpy as np

    if len(_POWERS.get("up", ())) <= n:
        for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
            steps = np.full(max(n, PART_BYTES) + 1, np.uint64(base))
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


@cache
def kinds(words: bytes = b"", breaks: bytes = b"", gaps: bytes = b""):
    """Kind of each byte. With ``words``, these and all bytes beyond ASCII are of words and others gaps; else all but ``gaps`` and ``breaks`` are."""
    import numpy as np

    out = np.full(256, GAP if words else WORD, dtype=np.uint8)
    out[list(words)] = WORD
    out[128:] = WORD
    out[list(gaps)] = GAP
    out[list(breaks)] = BREAK
    return out


def parts(column) -> Iterator[tuple[int, object, object]]:
    """(first row, bytes, offsets) of runs of rows of a string column; null rows are empty."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, at, data = column.buffers()
    at = np.frombuffer(at, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = max(first + 1, int(np.searchsorted(at, at[first] + PART_BYTES, "right")) - 1)
        yield first, data[at[first]:at[end]], at[first:end + 1] - at[first]
        first = end


def split_words(data, at, kind):
    """(hash, row, start, end, piece) of each word of a part, in order.

    ``piece`` numbers the pieces of all rows: it grows at every row and wherever a break lies between two words.
    """
    import numpy as np

    n = len(data)
    k = kind[data] if n else np.zeros(0, np.uint8)
    inside = k == WORD
    edge = np.zeros(n + 1, dtype=bool)
    edge[at] = True
    before = np.concatenate([[False], inside[:-1]]) if n else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate([inside[1:], [False]]) if n else inside
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    up, down = _powers(n)
    total = np.zeros(n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        if n:
            np.cumsum(_byte_values()[data] * up[:n], out=total[1:])
        h = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(_ODD))
    row = np.searchsorted(at, starts, "right") - 1
    cuts = np.zeros(n + 1, dtype=np.int64)
    if n:
        np.cumsum((k == BREAK) | edge[:-1], out=cuts[1:])
    return h, row, starts, ends, cuts[starts + 1] if n else cuts[:0]


def grams(h, k: int, seed: int = 0):
    """Hash of every k neighbouring words (those that cross rows included)."""
    import numpy as np

    n = max(0, len(h) - k + 1)
    out = np.full(n, np.uint64(k + (seed << 8)))
    with np.errstate(over="ignore"):
        for j in range(k):
            out = mix(out * np.uint64(_ODD) + h[j:j + n])
    return out
