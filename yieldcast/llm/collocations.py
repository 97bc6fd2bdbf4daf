"""Phrase collocations from an FM-index per shard.

A shard is a stretch of a language's words, about a quarter of a million, as a sequence of word ids with separators between pieces. Its
FM-index holds, for the sequence and for its reverse, the LF mapping of the Burrows-Wheeler transform sorted to the depth of the longest
phrase. A phrase is an interval in both; one step of LF extends all intervals by a word to the left (or, in the reverse, to the
right) and gives the counts of all longer phrases, without a sort. Counts of a length are summed over shards and phrases below the threshold
dropped; the next length is extended from the rest only, since a frequent phrase holds frequent phrases only. Tasks learn of the rest
by a filter of bounded size, whose false members the next sum drops.

Most phrases of a shard are rare, so a length is summed twice. First by a code of 40 bits of the phrase's hash, sent as packed sorted runs of
some three bytes a phrase: the sum of a code is at least that of each of its phrases. Then exactly, by whole hashes, for phrases whose code reaches the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from yieldcast.llm import bit_filter
from yieldcast.llm.byte_words import BREAK, kinds, mix, parts, split_words
from yieldcast.llm.common import release, remove, scratch, small_batches

LONGEST = 5                      # words of a phrase
LEAST_COUNT = 100
TOP = 2000                       # phrases of a language
SHARD_WORDS = 1 << 18
ROWS_AT_ONCE = 256               # rows whose texts are copied at once
SHARDS_AT_ONCE = 2               # shards sent to a task at once, some 2 MB each
CODE_BITS = 40                   # of a phrase's hash, in the first sum
LEAST_RUNS = 1 << 8              # runs of codes that a length is dealt into at least: 32 bits of a code are left in a run
RUN_WORDS = 1 << 20              # words of the input for each run
CODES_AT_ONCE = 1 << 21          # codes of neighbouring shards that are summed before they are sent
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
GAPS = b" \t"
_ODD = 0x9E3779B97F4A7C15


# -- words of a shard ---------------------------------------------------------

def _chain(h, w):
    """Hash of a phrase from that of all words but the last, and the last word's key."""
    import numpy as np

    with np.errstate(over="ignore"):
        return mix(h * np.uint64(_ODD) + w)


def _lang_key(lang: str) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _stretches(batches: Iterator) -> Iterator:
    """(lang, words) of stretches of about ``SHARD_WORDS`` words; words: (key, piece, start, end, bytes) arrays.

    Keys of words differ by language. All languages together are held to a few stretches.
    """
    import numpy as np

    kind, held, many = kinds(breaks=BREAKS, gaps=GAPS), {}, {}

    def flush(lang):
        key, piece, start, end, data = zip(*held.pop(lang))
        many.pop(lang)
        shift = np.cumsum([0, *map(len, data[:-1])])
        pieces = np.cumsum([0, *[p[-1] + 1 if len(p) else 0 for p in piece[:-1]]])

        def joined(arrays, by):
            return np.concatenate([x + s for x, s in zip(arrays, by)])

        return lang, (np.concatenate(key), joined(piece, pieces), joined(start, shift), joined(end, shift), np.concatenate(data))

    slices = (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE))
    for batch in slices:
        names = batch.column(0).dictionary_encode()
        which, names = np.asarray(names.indices), names.dictionary.to_pylist()
        for number, lang in enumerate(names):
            own = batch.column(1).filter(_mask(which == number))
            for _, data, at in parts(own):
                h, _, start, end, piece = split_words(data, at, kind)
                with np.errstate(over="ignore"):
                    key = mix(h ^ np.uint64(_lang_key(lang)))
                held.setdefault(lang, []).append((key, piece, start, end, data))
                many[lang] = many.get(lang, 0) + len(h)
                if many[lang] >= SHARD_WORDS:
                    yield flush(lang)
        if sum(many.values()) >= 2 * SHARD_WORDS:
            for lang in list(held):
                yield flush(lang)
    for lang in list(held):
        yield flush(lang)


def _mask(which):
    import pyarrow as pa

    return pa.array(which)


def _count_task(batches: Iterator) -> Iterator:
    """Distinct words of each stretch: (h, n)."""
    import numpy as np
    import pyarrow as pa

    for _, (key, *_rest) in _stretches(batches):
        h, n = np.unique(key, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], ["h", "n"])


# -- the index ----------------------------------------------------------------

def _lf(t, depth: int = LONGEST):
    """LF mapping of the transform of ``t`` (ids, 0 for separators, first and last 0), sorted by ``depth`` ids."""
    import numpy as np

    def ahead(x, k):
        return np.concatenate([x[k:], np.zeros(min(k, len(x)), x.dtype)])

    t = t.astype(np.int64)
    rank, width, base = t, 1, int(t.max(initial=0)) + 1
    words = base
    while 2 * width < depth:
        rank = np.unique(rank * base + ahead(rank, width), return_inverse=True)[1]
        width, base = 2 * width, len(t) + 1
    for k in range(width, depth):
        rank = rank * words + ahead(t, k)
        if k + 1 < depth:
            rank = np.unique(rank, return_inverse=True)[1]
    order = np.argsort(rank, kind="stable")
    before = t[order - 1]
    lf = np.empty(len(t), dtype=np.int32)
    lf[np.argsort(before, kind="stable")] = np.arange(len(t), dtype=np.int32)
    return lf


def to_bytes(lf) -> bytes:
    """An LF mapping for storage: its inverse rises within the rows of a word, so the differences, byte by place, compress well."""
    import numpy as np

    back = np.empty(len(lf), dtype=np.int32)
    back[lf] = np.arange(len(lf), dtype=np.int32)
    return np.diff(back, prepend=np.int32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def from_bytes(data):
    """The LF mapping that ``to_bytes`` stored."""
    import numpy as np

    step = np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T).view(np.int32).ravel()
    lf = np.empty(len(step), dtype=np.int32)
    lf[np.cumsum(step, dtype=np.int32)] = np.arange(len(step), dtype=np.int32)
    return lf


def _index_task(batches: Iterator, frequent) -> Iterator:
    """One row per stretch: lang, its words, keys and texts of the words that may be frequent, their counts, and both LF mappings.

    Other words are separators; neighbouring separators are one.
    """
    import numpy as np
    import pyarrow as pa

    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    for lang, (key, piece, start, end, data) in _stretches(batches):
        keep = np.flatnonzero(bit_filter.may_hold(frequent.value, key))
        total, key, piece, start, end = len(key), key[keep], piece[keep], start[keep], end[keep]
        vocab, first, ids = np.unique(key, return_index=True, return_inverse=True)
        new = np.ones(len(key), dtype=np.int64)
        new[1:] = (piece[1:] != piece[:-1]) | (keep[1:] != keep[:-1] + 1)
        t = np.zeros(len(key) + int(new.sum()) + 1, dtype=np.int32)
        t[np.arange(len(key)) + np.cumsum(new)] = ids + 1
        size = (end - start)[first]
        at = np.concatenate([[0], np.cumsum(size)])
        gather = np.repeat(start[first] - at[:-1], size) + np.arange(at[-1])
        texts = pa.LargeStringArray.from_buffers(len(vocab), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(lower[data[gather]])).cast(pa.string())
        one = pa.array([0, len(vocab)], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([total], pa.int64()),
             pa.ListArray.from_arrays(one, pa.array(vocab.view(np.int64))), pa.ListArray.from_arrays(one, texts),
             pa.ListArray.from_arrays(one, pa.array(np.bincount(ids, minlength=len(vocab)), pa.int32())),
             *[pa.array([to_bytes(_lf(x))], pa.binary()) for x in (t, t[::-1])]],
            ["lang", "words", "vocab", "texts", "counts", "left", "right"])


class _Side:
    """One direction of a shard's index: LF mapping and the first id of each row of the sorted sequence."""

    def __init__(self, lf, first):
        self.lf, self.first = lf, first

    def extend(self, lo, other, size):
        """All extensions of disjoint intervals by one id: (parent, id, lo, other, size).

        ``lo`` are starts in this direction, ``other`` in the opposite one, where the extensions of an interval lie in
        it, ordered by id after those that end at a separator.
        """
        import numpy as np

        n = len(self.lf)
        spot = np.repeat(lo - np.concatenate([[0], np.cumsum(size[:-1])]), size) + np.arange(size.sum())
        owner = np.repeat(np.arange(len(lo)), size)
        to = self.lf[spot]
        inner = self.first[to] > 0
        ended = np.bincount(owner[~inner], minlength=len(lo))
        old = np.full(n, -1, dtype=np.int64)
        old[to[inner]] = owner[inner]
        j = np.flatnonzero(old >= 0)
        parent, ident = old[j], self.first[j]
        new = np.ones(len(j), dtype=bool)
        new[1:] = (parent[1:] != parent[:-1]) | (ident[1:] != ident[:-1])
        at = np.flatnonzero(new)
        parent, ident, low, count = parent[at], ident[at], j[at], np.diff(np.append(at, len(j)))
        order = np.lexsort((ident, parent))
        run = np.cumsum(count[order]) - count[order]
        lead = np.searchsorted(parent[order], np.arange(len(lo)))
        beside = np.empty(len(at), dtype=np.int64)
        if len(at):
            beside[order] = other[parent[order]] + ended[parent[order]] + run - run[lead[parent[order]]]
        return parent, ident, low, beside, count


def _phrase_hash(keys):
    """Hash of each row of word keys."""
    h = keys[:, 0]
    for k in range(1, keys.shape[1]):
        h = _chain(h, keys[:, k])
    return h


def shard_phrases(vocab, counts, left, right, depth: int, filters: list):
    """(keys, counts) of a shard's phrases of ``depth`` words whose shorter phrases all pass their filter.

    Lengths are grown in turn to the left and to the right. ``filters`` are those of the lengths 1 to ``depth`` - 1.
    """
    import numpy as np

    first = np.concatenate([np.zeros(len(left) - int(counts.sum()), np.int64), np.repeat(np.arange(1, len(vocab) + 1), counts)])
    sides = _Side(left, first), _Side(right, first)
    size = counts.astype(np.int64)
    lo = np.concatenate([[0], np.cumsum(size)])[:-1] + len(left) - int(size.sum())
    at, words = [lo, lo.copy()], np.arange(len(vocab))[:, None]
    for length in range(1, depth):
        keep = bit_filter.may_hold(filters[length - 1], _phrase_hash(vocab[words]))
        at, size, words = [x[keep] for x in at], size[keep], words[keep]
        if not len(words):
            return np.zeros((0, depth), np.uint64), np.zeros(0, np.int64)
        side = (length - 1) % 2
        parent, ident, low, beside, size = sides[side].extend(at[side], at[1 - side], size)
        added, old = ident[:, None] - 1, words[parent]
        words = np.hstack([added, old]) if side == 0 else np.hstack([old, added])
        rest = words[:, :-1] if side == 0 else words[:, 1:]
        good = bit_filter.may_hold(filters[length - 1], _phrase_hash(vocab[rest]))
        at = [low[good], beside[good]] if side == 0 else [beside[good], low[good]]
        size, words = size[good], words[good]
    return vocab[words], size


def _phrases(batches: Iterator, depth: int, filters) -> Iterator:
    """(prefix, word, hash, n) of the phrases of ``depth`` words of each shard: hash of all words but the last, its key, and the hash of all."""
    import numpy as np

    held = [f.value for f in filters]
    for batch in batches:
        for k in range(batch.num_rows):
            vocab = np.asarray(batch.column(0)[k].values).view(np.uint64)
            counts = np.asarray(batch.column(1)[k].values)
            left, right = (from_bytes(batch.column(c)[k].as_buffer()) for c in (2, 3))
            keys, n = shard_phrases(vocab, counts, left, right, depth, held)
            prefix, word = _phrase_hash(keys[:, :-1]), np.ascontiguousarray(keys[:, -1])
            yield prefix, word, _chain(prefix, word), n


def _phrase_task(batches: Iterator, depth: int, filters, likely) -> Iterator:
    """(prefix, word, n) of the phrases of ``depth`` words of each shard whose code may have reached the threshold."""
    import numpy as np
    import pyarrow as pa

    for prefix, word, h, n in _phrases(batches, depth, filters):
        keep = bit_filter.may_hold(likely.value, _code(h))
        yield pa.RecordBatch.from_arrays([pa.array(x[keep].view(np.int64)) for x in (prefix, word)] + [pa.array(n[keep], pa.int64())], ["prefix", "word", "n"])


def _code(h):
    """The first bits of a hash."""
    import numpy as np

    return h >> np.uint64(64 - CODE_BITS)


def _summed(codes, n):
    """Distinct codes in order, and the sums of their counts."""
    import numpy as np

    order = np.argsort(codes)
    codes, n = codes[order], n[order]
    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(codes)), dtype=bool), codes[1:] != codes[:-1]]))
    return codes[new], np.add.reduceat(n, new) if len(new) else n


def pack(codes, n, runs: int, least: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(run, codes, counts) of sorted distinct codes: those of a run as differences, byte by place, compressed. Counts beyond ``least`` count as it."""
    import zlib

    import numpy as np

    low = CODE_BITS - (runs.bit_length() - 1)
    n = np.minimum(n, least).astype(np.uint32)
    run = (codes >> np.uint64(low)).astype(np.int64)
    rest = (codes & np.uint64((1 << low) - 1)).astype(np.uint32)
    edges = np.append(np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])), len(run)) if len(run) else np.zeros(1, np.int64)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        step = np.diff(rest[a:b], prepend=np.uint32(0))
        yield int(run[a]), *[zlib.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T).tobytes(), 1) for x in (step, n[a:b])]


def unpack(run: int, codes: bytes, counts: bytes, runs: int):
    """(codes, counts) of one row of ``pack``."""
    import zlib

    import numpy as np

    low = CODE_BITS - (runs.bit_length() - 1)
    step, n = (np.ascontiguousarray(np.frombuffer(zlib.decompress(x), np.uint8).reshape(4, -1).T).view(np.uint32).ravel() for x in (codes, counts))
    return np.cumsum(step, dtype=np.uint64) + np.uint64(run << low), n.astype(np.int64)


def _code_task(batches: Iterator, depth: int, filters, runs: int, least: int) -> Iterator:
    """(run, codes, counts): sums over neighbouring shards of a task by the codes of phrases, packed."""
    import numpy as np
    import pyarrow as pa

    held, many = [], 0

    def flush():
        rows = list(pack(*_summed(*[np.concatenate(x) for x in zip(*held)]), runs, least))
        held.clear()
        run, codes, counts = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(run, pa.int64()), pa.array(codes, pa.binary()), pa.array(counts, pa.binary())], ["run", "codes", "counts"])

    for _, _, h, n in _phrases(batches, depth, filters):
        held.append((_code(h), n))
        many += len(n)
        if many >= CODES_AT_ONCE:
            many = 0
            yield flush()
    if held:
        yield flush()


def _likely_codes(table, runs: int, least: int):
    """Codes of one run whose counts reach the threshold."""
    import numpy as np
    import pyarrow as pa

    rows = [unpack(r["run"], r["codes"], r["counts"], runs) for r in table.to_pylist()]
    codes, n = _summed(*[np.concatenate(x) for x in zip(*rows)])
    return pa.table({"code": pa.array(codes[n >= least].view(np.int64))})


def _likely(shards: DataFrame, depth: int, filters: list, runs: int, least: int):
    """Filter of the codes whose phrases may reach the threshold; other phrases of ``depth`` words do not."""
    task = partial(_code_task, depth=depth, filters=list(filters), runs=runs, least=least)

    def reach(table):
        return _likely_codes(table, runs, least)

    packed = shards.mapInArrow(task, "run long, codes binary, counts binary")
    paths: list[str] = []
    with small_batches(shards.sparkSession, 1):
        codes = scratch(packed.groupBy("run").applyInArrow(reach, "code long"), paths)
    bits = bit_filter.build(codes, "code")
    remove(shards.sparkSession, paths.pop())
    return bits


def _hash_task(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        prefix, word = (np.asarray(batch.column(c)).view(np.uint64) for c in (0, 1))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_chain(prefix, word).view(np.int64))], ["prefix", "word", "a", "h"])


# -- scores -------------------------------------------------------------------

def _score(k: Column) -> Column:
    wide = "decimal(38,0)"
    top = F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(17,0)") * F.col("n").cast("decimal(17,0)")
    return F.call_function("div", top.cast(wide), (F.col("before")[k].cast("decimal(19,0)") * F.col("after")[k].cast("decimal(19,0)")).cast(wide))


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST_COUNT, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of 2 to 5 words of each language: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased. Texts are cut into pieces at ``.,;:!?`` and line ends, pieces into words at spaces and tabs. a is the
    count of a phrase within pieces, overlaps included; n that of all words of the language. Phrases with a of ``least`` or more are candidates.
    Cut after k words, l and r are the counts of both parts and the score is floor(1000 * a * n / (l * r)); the cut with the
    lowest score counts, of equal ones the shortest first part. A candidate that lies in a longer one with the same count is dropped. Order: score and a
    descending, phrase by its UTF-8 bytes. Null texts are empty; a null language is ``und``; an empty table gives an empty
    result. Repeated rows count as often as they stand. Scores are exact up to counts of 17 digits. Only the two named columns are read.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    base = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    with small_batches(spark, ROWS_AT_ONCE):
        words = scratch(base.mapInArrow(_count_task, "h long, n long").groupBy("h").agg(F.sum("n").alias("a")).where(F.col("a") >= least))
    filters = [sc.broadcast(bit_filter.build(words, "h"))]
    with small_batches(spark, ROWS_AT_ONCE):
        shards = scratch(base.mapInArrow(partial(_index_task, frequent=filters[0]),
                                         "lang string, words long, vocab array<long>, texts array<string>, counts array<int>, left binary, right binary"),
                         None, "zstd")
    release(spark, [])
    sizes = shards.groupBy("lang").agg(F.sum("words").alias("n"))
    total = shards.agg(F.sum("words")).first()[0] or 0
    runs = min(1 << 20, max(LEAST_RUNS, 1 << (total // RUN_WORDS).bit_length()))
    spelt = shards.select("lang", F.explode(F.arrays_zip("vocab", "texts")).alias("v")).select("lang", F.col("v.vocab").alias("h"), F.col("v.texts").alias("word"))
    spelt = spelt.groupBy("h").agg(F.min(F.struct("lang", "word")).alias("v"))
    words = scratch(spelt.join(words, "h").select("h", "v.lang", F.col("v.word").alias("phrase"), "a"))

    levels = [words.withColumn("before", F.array("a")).withColumn("after", F.array("a"))]
    last = words.select(F.col("h").alias("word"), F.col("phrase").alias("spelt"))
    for depth in range(2, LONGEST + 1):
        index = shards.select("vocab", "counts", "left", "right")
        likely = sc.broadcast(_likely(index, depth, filters, runs, least))
        counted = index.mapInArrow(partial(_phrase_task, depth=depth, filters=list(filters), likely=likely), "prefix long, word long, n long")
        summed: list[str] = []
        with small_batches(spark, SHARDS_AT_ONCE):
            kept = scratch(counted.groupBy("prefix", "word").agg(F.sum("n").alias("a")).where(F.col("a") >= least), summed)
        found = scratch(kept.mapInArrow(_hash_task, "prefix long, word long, a long, h long"))
        remove(spark, summed.pop())
        del counted, kept
        release(spark, [])
        if depth < LONGEST:
            filters.append(sc.broadcast(bit_filter.build(found, "h")))
        shorter = levels[-1]
        begun = found.join(shorter.select(F.col("h").alias("prefix"), "lang", F.col("phrase").alias("start"), F.col("before").alias("first")), "prefix")
        whole = (begun.join(last, "word").select("h", "prefix", "lang", F.concat_ws(" ", "start", "spelt").alias("phrase"), "a", "first")
                 .withColumn("rest", F.expr("substr(phrase, locate(' ', phrase) + 1)")))
        ends = shorter.select("lang", F.col("phrase").alias("rest"), F.col("h").alias("suffix"), F.col("after").alias("second"))
        levels.append(scratch(whole.join(ends, ["lang", "rest"]).select(
            "h", "prefix", "suffix", "lang", "phrase", "a", F.concat("first", F.array("a")).alias("before"), F.concat(F.array("a"), "second").alias("after"))))

    scored = None
    for depth in range(2, LONGEST + 1):
        own = levels[depth - 1]
        if depth < LONGEST:
            longer = levels[depth]
            most = (longer.select(F.col("prefix").alias("h"), "a").unionAll(longer.select(F.col("suffix").alias("h"), "a"))
                    .groupBy("h").agg(F.max("a").alias("most")))
            own = own.join(most, "h", "left").where("most is null or most < a")
        cuts = F.array(*[F.struct(_score(k).alias("score"), F.lit(k).alias("k"), F.col("before")[k].alias("l"), F.col("after")[k].alias("r")) for k in range(depth - 1)])
        one = own.select("lang", "phrase", "a", "before", F.slice("after", 2, depth - 1).alias("after")).join(sizes, "lang")
        one = one.select("lang", "phrase", "a", "n", F.array_min(cuts).alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score")
        scored = one if scored is None else scored.unionAll(one)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    near = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    best = scored.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
