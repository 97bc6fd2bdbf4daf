import re
from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldcast.llm import ngram_join as N
from yieldcast.llm.common import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}


def shingles(text, width):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def brute(rows, width, percent):
    """(id, size, component) of every row, by comparing all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None))
    return out


def edited(rng, words, text, edits):
    w = text.split()
    for _ in range(edits):
        k = rng.randrange(len(w))
        w[k:k + rng.randint(0, 1)] = [rng.choice(words)] * rng.randint(0, 2)
    return " ".join(w)


def family_rows(rng, words, families=14, copies=6, most=250):
    """Texts of all sizes with copies that lie on both sides of the threshold."""
    rows = []
    for _ in range(families):
        base = " ".join(rng.choices(words, k=rng.randint(1, most)))
        rows.append(base)
        for _ in range(copies):
            rows.append(edited(rng, words, rng.choice([base, rows[-1]]), rng.randint(0, 1 + len(base.split()) // 40)))
    rng.shuffle(rows)
    return list(enumerate(rows))


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))


def check(spark, rows, width, percent):
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, n string")
    got = [tuple(r) for r in N.jaccard_components(df, width=width, percent=percent).collect()]
    assert key(got) == key(brute(rows, width, percent))


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80), (2, 60)])
def test_components_match_brute_force(spark, rng, words, width, percent):
    check(spark, family_rows(rng, words), width, percent)


def test_nulls_repeats_short_and_long_texts(spark, rng, words):
    long_ = " ".join(rng.choices(words, k=8000))
    rows = [(1, None), (2, ""), (3, " \n "), (4, "A b"), (5, "a  B"), (6, "a"), (None, "a"), (None, None), (7, long_),
            (8, long_ + " more"), (9, "x y z"), (9, "x y z"), (9, "q r s t"), (10, "é b c"), (11, "é b  c")]
    check(spark, rows + [(20, "same text again")] * 40, 3, 90)


def test_empty_table(spark):
    assert N.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_large_family_in_several_blocks(spark, rng, words, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 8)
    base = rng.choices(words, k=120)
    rows = []
    for i in range(70):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i, " ".join(w)))
    check(spark, rows, 3, 90)


def test_linked_sets_share_a_signature(rng):
    """Sets at the threshold, of sizes around the borders of ranges."""
    gen = np.random.default_rng(5)
    for percent in (80, 90):
        for size in (*range(1, 60), 85, 86, 87, 129, 130, 300, 1000):
            for _ in range(6):
                both = gen.integers(0, 2 ** 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
                more = int(size * (100 - percent) / percent)
                cut = int(gen.integers(0, more + 1))
                extra = gen.integers(0, 2 ** 63, more, dtype=np.uint64)
                x, y = np.unique(np.concatenate([both, extra[:cut]])), np.unique(np.concatenate([both, extra[cut:]]))
                assert N.linked(x, y, percent)
                if not np.array_equal(x, y):
                    (sx, mx), (sy, my) = N.signatures(x, percent), N.signatures(y, percent)
                    shared = set(sx.tolist()) & set(sy.tolist())
                    # more signatures are shared than the set that may pass over most passes over
                    assert len(shared) > max(0, *(int(m) % (1 << 20) - 1 for m in (mx[np.isin(sx, list(shared))].min(), my[np.isin(sy, list(shared))].min())))


def test_dual_traversal_finds_every_link(rng):
    gen = np.random.default_rng(3)
    base = gen.integers(0, 2 ** 63, 300, dtype=np.uint64)
    sets = []
    for _ in range(60):
        part = base[gen.random(300) < 0.96] if gen.random() < 0.7 else gen.integers(0, 2 ** 63, int(gen.integers(1, 400)), dtype=np.uint64)
        sets.append(np.unique(part))
    never = lambda i, j: False
    one = N.Tree(sets)
    assert set(N.dual_traversal(one, one, 90, never)) == {(i, j) for i in range(60) for j in range(i + 1, 60) if N.linked(sets[i], sets[j], 90)}
    left, right = N.Tree(sets[:13]), N.Tree(sets[13:])
    assert set(N.dual_traversal(left, right, 90, never)) == {(i, j) for i in range(13) for j in range(47) if N.linked(sets[i], sets[13 + j], 90)}


def test_connected_components_of_paths_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(500, 499), (7, 7), (600, 600), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(tuple(r) for r in connected_components(df).collect())
    assert got == {i: 0 for i in range(41)} | {100 + k: 100 for k in range(30)} | {499: 499, 500: 499}
    assert connected_components(df.where(F.lit(False))).collect() == []


def test_copies_in_several_batches_give_signatures_once():
    import pyarrow as pa

    flat = np.arange(300, dtype=np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.ListArray.from_arrays(pa.array([0, 300], pa.int32()), pa.array(flat))], ["id", "w"])
    one, two = N._read_task(iter([batch, batch]), 3, 90)
    assert len(one.column(4)[0]) > 0 and len(two.column(4)[0]) == 0
    assert one.column(1) == two.column(1)


def test_tasks_get_few_rows_at_once(spark, monkeypatch):
    rows_of = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, met, plain = spark.conf.get(rows_of), [], N.scratch
    monkeypatch.setattr(N, "scratch", lambda *a: met.append(int(spark.conf.get(rows_of))) or plain(*a))
    rows = [(i, "one two three four five six seven eight " * 3) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in N.jaccard_components(docs, width=3, percent=90).collect()) == sorted(brute(rows, 3, 90))
    assert N.ROWS_AT_ONCE in met and spark.conf.get(rows_of) == before


def test_pairs_of_blocks_are_dealt_to_passes(spark):
    fields = ["sid"]
    left = spark.createDataFrame([(r, c, 4, f"{r}{c}") for r in (1, 2) for c in range(3)], "root long, chunk long, blocks long, sid string")
    right = spark.createDataFrame([(r, 3, b, f"{r}-{b}") for r in (1, 2) for b in range(4)], "root long, chunks long, block long, sid string")
    passes = N._passes(left, right, right)
    assert passes == 6                       # 24 copies of each side, 8 sets held
    dealt = [sorted(tuple(r) for r in N._crossed(left, right, k, passes, fields).collect()) for k in range(passes)]
    every = [row for part in dealt for row in part]
    assert sorted(every) == sorted([(r, c, y, 0, f"{r}{c}") for r in (1, 2) for c in range(3) for y in range(4)]
                                   + [(r, c, y, 1, f"{r}-{y}") for r in (1, 2) for c in range(3) for y in range(4)])
    assert all(len(part) < len(every) for part in dealt)
    for part in dealt:                       # both sides of a pair stand in one pass
        assert {x[:3] for x in part if x[3] == 0} == {x[:3] for x in part if x[3] == 1}


def test_shared_passages_do_not_chain_unlinked_texts(spark, rng, words):
    """Texts whose sets lie low in their size range and share some passages, few of them linked: candidate families stay small, links stay whole."""
    passages = [rng.choices(words, k=9) for _ in range(6)]
    texts = []
    for _ in range(300):
        text = rng.choices(words, k=rng.randint(126, 134))
        for p in rng.sample(passages, 1):
            text[10:10] = p
        texts.append(text)
    for i in range(0, 300, 10):
        copy = list(texts[i])
        copy[-1] = "other"
        texts.append(copy)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    hashed = N._word_hashes(df.select(F.col("doc_id").alias("id"), "text"), "text", True)
    schema = "id long, sid binary, fp long, n long, sigs array<struct<sig:long,mark:int>>"
    signed = hashed.select("id", "w").mapInArrow(partial(N._read_task, width=5, percent=80), schema)
    pairs = N._candidate_pairs(signed.select(F.explode("sigs").alias("s"), "fp").select("s.sig", "s.mark", "fp"), [])
    sizes = [r["count"] for r in connected_components(pairs).groupBy("root").count().collect()]
    assert sum(sizes) < 120 and max(sizes) < 30
    got = {r.doc_id: r.component_id for r in N.jaccard_components(df, width=5, percent=80).collect()}
    assert all(got[300 + i // 10] == got[i] == i for i in range(0, 300, 10)) and all(got[i] == i for i in range(300))
