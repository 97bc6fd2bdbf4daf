import math

from pyspark.sql import functions as F

from yieldcast.llm import topk_search as S


def brute(rows, every, k=5):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qi, q in ok:
        if qi is not None and qi % every == 0:
            scores = sorted(((-sum(a * b for a, b in zip(q, v)), (i is None, i or 0), i) for i, v in ok if i != qi), key=lambda t: t[:2])[:k]
            out += [(qi, r + 1, i, -s) for r, (s, _, i) in enumerate(scores)]
    return sorted(out)


def run(spark, rows, every):
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], "vec_id long, embedding array<float>, row string").repartition(3)
    return sorted(tuple(r) for r in S.top_k(df, F.col("vec_id") % every == 0).collect())


def vectors(rng, n, dim=12):
    import numpy as np
    return [(i, [float(np.float32(rng.gauss(0, 0.3))) for _ in range(dim)]) for i in range(n)]


def test_equals_brute_force_over_many_cells(spark, rng, monkeypatch):
    monkeypatch.setattr(S, "CELL", 40)
    monkeypatch.setattr(S, "QUERY_BLOCK", 16)
    rows = vectors(rng, 900)
    assert run(spark, rows, 9) == brute(rows, 9)


def test_many_annuli_of_several_cells_and_several_passes(spark, rng, monkeypatch):
    monkeypatch.setattr(S, "CELL", 1)
    monkeypatch.setattr(S, "PIVOTS", 40)
    monkeypatch.setattr(S, "RINGS", 40)
    monkeypatch.setattr(S, "PASS_BYTES", 4096, raising=False)
    rows = vectors(rng, 2500, 3)
    assert run(spark, rows, 100) == brute(rows, 100)


def test_clustered_vectors_and_bounds_that_stop(spark, rng, monkeypatch):
    monkeypatch.setattr(S, "CELL", 32)
    rows = [(i, [(5.0 * (i % 4 == k)) + rng.gauss(0, 0.01) for k in range(4)]) for i in range(600)]
    rows = [(i, [math.floor(x * 1024) / 1024 for x in v]) for i, v in rows]
    assert run(spark, rows, 50) == brute(rows, 50)


def test_ties_copies_and_unusable_vectors(spark, rng):
    rows = vectors(rng, 60, 4) + [(100 + i, [0.5, 0.5, 0.0, 0.0]) for i in range(400)]
    rows += [(1000, None), (1001, [None, 1.0, 0.0, 0.0]), (1010, [float("nan")] * 4), (1020, [float("inf"), 0.0, 0.0, 0.0])]
    assert run(spark, rows, 10) == brute(rows, 10)


def test_few_rows_and_empty_table(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [0.0, -1.0])]
    assert run(spark, rows, 1) == brute(rows, 1)
    assert run(spark, rows[:1], 1) == []
    assert run(spark, [], 1) == []


def test_different_lengths_are_filled_up(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0]), (2, [0.0, 1.0, 9.0]), (3, [])]
    assert run(spark, rows, 1) == brute(rows, 1)


def run_doubles(spark, rows, every):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    return sorted(tuple(r) for r in S.top_k(df, F.col("vec_id") % every == 0).collect())


def test_large_components_are_ranked(spark, rng, monkeypatch):
    monkeypatch.setattr(S, "CELL", 40)
    monkeypatch.setattr(S, "QUERY_BLOCK", 8)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)]) for i in range(200)]
    rows += [(200 + i, [rng.choice((5000.0, -5000.5, 1e6, 0.25, -1e6)) for _ in range(8)]) for i in range(100)]
    rows += [(301, [1e6 + i / 256 for i in range(8)]), (302, [1e6 + i / 256 for i in range(8)]), (310, [4096.0]), (320, None)]
    assert run_doubles(spark, rows, 10) == brute(rows, 10)
    assert run_doubles(spark, rows[200:], 10) == brute(rows[200:], 10)     # none for the index


def test_products_beyond_longs_are_ranked(spark):
    rows = [(i, [x, 1.0]) for i, x in enumerate((1e300, -1e300, 1e9, 3e38, 1e308, -1e308, 0.5, -2e12))]
    want = [(q, r, i, s if -2**63 <= s < 2**63 else None) for q, r, i, s in exact(rows)]
    assert run_doubles(spark, rows, 1) == sorted(want)


def exact(rows, k=5):
    from fractions import Fraction
    ok = [(i, [math.floor(256 * Fraction(x)) for x in v]) for i, v in rows]
    for q, a in ok:
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q)[:k]
        yield from ((q, r + 1, i, -s) for r, (s, i) in enumerate(scores))
