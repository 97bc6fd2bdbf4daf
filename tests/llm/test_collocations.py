import re
from collections import Counter

import numpy as np
import pytest

from yieldcast.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, h long, word string, n long"


def brute(rows, least, top):
    out, langs = [], {}
    for _, text, lang in rows:
        langs.setdefault("und" if lang is None else lang, []).append(text or "")
    for lang, texts in langs.items():
        count = Counter()
        for text in texts:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", text):
                w = re.findall(r"[^ \t]+", piece)
                for k in range(1, 6):
                    count.update(tuple(w[s:s + k]) for s in range(len(w) - k + 1))
        n = sum(c for p, c in count.items() if len(p) == 1)
        good = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        rank = []
        for p, a in good.items():
            if any(b >= a and len(q) > len(p) and any(q[s:s + len(p)] == p for s in range(len(q))) for q, b in good.items()):
                continue
            score, k = min((1000 * a * n // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
            rank.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(sorted(rank)[:top])]
    return sorted(out)


def got(spark, rows, least, top):
    df = spark.createDataFrame([(*r, 1, "w", 2) for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in C.collocations(df, least=least, top=top).collect())


@pytest.mark.parametrize("shard", [50, C.SHARD_WORDS])
def test_matches_brute_force(spark, rng, monkeypatch, shard):
    monkeypatch.setattr(C, "SHARD_WORDS", shard)
    vocab = ["the", "The", "a", "of", "new", "york", "city", "hall", "é", "x-y", "漢字"]
    rows = []
    for k in range(150):
        text = [rng.choice(vocab) for _ in range(rng.randint(0, 40))]
        text[rng.randint(0, len(text)):0] = ["new", "york", "city", "hall", "park"] * rng.choice([0, 1, 2])
        rows.append((k, rng.choice([" ", " ", "  ", "\t"]).join(text).replace("a", rng.choice(["a", "a.", "a\n"])), rng.choice(["en", "en", "en", "fr", None])))
    assert got(spark, rows, 5, 40) == brute(rows, 5, 40)


def test_nulls_repeats_ties_long_texts(spark):
    rows = [(1, None, "en"), (2, "", None), (3, " \t\n.,;", "en"), (None, "a b " * 3000, "en"), (5, "b a", "xx"), (5, "b a", "xx"), (6, "q " * 50, ""),
            (7, "c d. c e. f d. c d. c e. f d", "zz")]
    assert got(spark, rows, 2, 5) == brute(rows, 2, 5)


def test_nothing_frequent_and_empty_table(spark):
    assert got(spark, [(1, "a b c", "en")], 2, 5) == [] == got(spark, [], 2, 5)


def test_both_directions_of_the_index_agree_with_counts(rng):
    """Phrases grown to the left and right in a shard's index have their counts in the sequence."""
    t = np.array([0] + [rng.choice([0, 1, 2, 3, 3, 3]) for _ in range(400)] + [0], dtype=np.int32)
    t = t[np.append(True, (t[1:] > 0) | (t[:-1] > 0))]
    counts = np.bincount(t, minlength=4)[1:]
    vocab = np.array([11, 22, 33], dtype=np.uint64)
    every = np.full(1024, ~np.uint64(0))
    for depth in range(2, 6):
        keys, n = C.shard_phrases(vocab, counts, C._lf(t), C._lf(t[::-1]), depth, [every] * (depth - 1))
        real = Counter(tuple(int(x) * 11 for x in t[s:s + depth]) for s in range(len(t) - depth + 1) if (t[s:s + depth] > 0).all())
        assert {tuple(map(int, k)): int(c) for k, c in zip(keys, n)} == dict(real)


def test_tasks_get_few_rows_at_once(spark, monkeypatch):
    """Batches are held beside the executor's heap, so they stay small however many rows a partition has."""
    rows_of = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, met, plain = spark.conf.get(rows_of), [], C.scratch
    monkeypatch.setattr(C, "scratch", lambda *a: met.append(int(spark.conf.get(rows_of))) or plain(*a))
    rows = [(i, "alpha beta gamma delta epsilon zeta", "en") for i in range(8)]
    assert got(spark, rows, 5, 50) == brute(rows, 5, 50)
    assert C.ROWS_AT_ONCE in met and met.count(C.SHARDS_AT_ONCE) == C.LONGEST - 1
    assert spark.conf.get(rows_of) == before


def test_packed_codes_are_read_back():
    gen = np.random.default_rng(8)
    for runs in (C.LEAST_RUNS, 1 << 12):
        h = np.concatenate([gen.integers(0, 2 ** 64, 5000, dtype=np.uint64), np.array([0, 2 ** 64 - 1], np.uint64)])
        codes, n = C._summed(C._code(np.concatenate([h, h[:2500]])), np.ones(len(h) + 2500, np.int64))
        rows = list(C.pack(codes, n * 90, runs, 100))
        back, counts = (np.concatenate(x) for x in zip(*[C.unpack(*r, runs) for r in rows]))
        assert back.tolist() == codes.tolist() and counts.tolist() == np.minimum(n * 90, 100).tolist()
    assert list(C.pack(codes[:0], n[:0], runs, 100)) == []


def test_rare_phrases_are_not_sent_whole(spark, monkeypatch):
    sent, plain = spark.sparkContext.accumulator(0), C._phrase_task

    def counting(batches, **kw):
        for batch in plain(batches, **kw):
            sent.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(C, "_phrase_task", counting)
    gen = np.random.default_rng(9)
    rows = [(i, "new york " + " ".join(f"w{k}" for k in gen.integers(0, 300, 40)), "en") for i in range(200)]
    assert got(spark, rows, 12, 50) == brute(rows, 12, 50)
    # each of about 8,000 pairs stands in 200 texts of frequent words, but few come often enough
    assert 0 < sent.value < 2000


def test_stored_mappings_are_read_back_and_small():
    import zlib

    gen = np.random.default_rng(10)
    t = np.concatenate([[0], gen.zipf(1.3, 20000) % 3000, [0]]).astype(np.int32)
    lf = C._lf(t)
    assert C.from_bytes(C.to_bytes(lf)).tolist() == lf.tolist()
    assert len(zlib.compress(C.to_bytes(lf), 1)) < 0.75 * len(zlib.compress(lf.tobytes(), 1))
    assert C.from_bytes(C.to_bytes(C._lf(np.zeros(1, np.int32)))).tolist() == [0]
