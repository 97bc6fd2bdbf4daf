import itertools

from pyspark.sql import functions as F

from yieldcast.llm import mixing


def test_share_targets_reshares_what_is_above_the_limit():
    target = mixing.share_targets({"a": 10, "b": 1000, None: 0}, {"a": 100, "b": 1, None: 5}, 1010)
    assert target == {"a": 30.0, "b": 980.0, None: 0.0}


def test_share_targets_cascade_and_stop_at_the_limit():
    target = mixing.share_targets({"a": 1, "b": 2, "c": 3}, {"a": 1, "b": 1, "c": 1}, 100)
    assert target == {"a": 3.0, "b": 6.0, "c": 9.0}


def brute_cost(supply, members, quota, passes):
    """Least cost of a maximum flow, by trying every integral flow of a tiny network."""
    arcs = [(p, s) for p, ss in enumerate(members) for s in ss]
    best = (-1, 0)
    for f in itertools.product(*[range(min(passes * supply[p], quota[s]) + 1) for p, s in arcs]):
        out = [sum(x for x, (p, _) in zip(f, arcs) if p == i) for i in range(len(supply))]
        into = [sum(x for x, (_, s) in zip(f, arcs) if s == i) for i in range(len(quota))]
        if any(o > passes * c for o, c in zip(out, supply)) or any(i > q for i, q in zip(into, quota)):
            continue
        cost = sum(r * max(0, min(c, o - r * c)) for o, c in zip(out, supply) for r in range(passes))
        best = max(best, (sum(f), -cost))
    return best


def test_min_cost_flow_matches_exhaustive_search(rng):
    for _ in range(25):
        n_p, n_s = rng.randint(1, 3), rng.randint(1, 2)
        supply = [rng.randint(0, 3) for _ in range(n_p)]
        members = [sorted(rng.sample(range(n_s), rng.randint(1, n_s))) for _ in range(n_p)]
        quota = [rng.randint(0, 7) for _ in range(n_s)]
        flow = mixing.min_cost_flow(supply, members, quota, 3)
        out = [sum(f) for f in flow]
        cost = sum(r * max(0, min(c, o - r * c)) for o, c in zip(out, supply) for r in range(3))
        assert (sum(out), -cost) == brute_cost(supply, members, quota, 3)
        assert all(flow[p][s] == 0 for p in range(n_p) for s in range(n_s) if s not in members[p])


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, words long, size string")


def test_mix_comes_near_targets_and_reruns_agree(spark, rng):
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), rng.randint(0, 60), "x") for i in range(2000)]
    run = lambda df: mixing.mix(df, F.array("source"), F.col("words"))
    got = run(table(spark, rows)).collect()
    again = run(table(spark, rows[::-1]).repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    assert all(r.taken == r.passes * r.size and 0 <= r.passes <= 3 for r in got)
    for s in ("a", "b", None):
        held = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in held) - held[0].target) <= 60
        assert {r.source_size for r in held} == {sum(r.size for r in held)}


def test_mix_repeated_rows_empty_table_and_clashing_names(spark):
    rows = [(1, "a", 5, "clash")] * 300 + [(2, "b", 100, "clash"), (None, None, 0, None)]
    got = mixing.mix(table(spark, rows), F.array("source"), F.col("words")).collect()
    assert len(got) == 302
    for s in ("a", "b"):
        held = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in held) - held[0].target) <= 50
    assert [r.taken for r in got if r.source is None] == [0]
    assert mixing.mix(table(spark, []), F.array("source"), F.col("words")).count() == 0


def test_mix_routes_overlapping_sources(spark):
    rows = [(i, "a", 10, "x") for i in range(30)] + [(100 + i, "b", 10, "x") for i in range(30)] + [(200 + i, "ab", 10, "x") for i in range(30)]
    members = F.when(F.col("source") == "ab", F.array(F.lit("a"), F.lit("b"))).otherwise(F.array("source"))
    got = mixing.mix(table(spark, rows), members, F.col("words"), weights=lambda names: [1] * len(names)).collect()
    # 900 words, 450 a source: every pattern once, and nothing is repeated
    assert sum(r.taken for r in got) == 900 and {r.passes for r in got} == {1}


def test_many_sources_and_many_linked_sets(spark):
    """No bound on patterns: 10,500 sources of their own, and 60 pairs of sources that share documents."""
    rows = [(k, [f"s{k:05d}"], 1 + k % 4) for k in range(10_500)]
    for k in range(60):
        rows += [(20_000 + 3 * k, [f"a{k}"], 6), (20_001 + 3 * k, [f"b{k}"], 6), (20_002 + 3 * k, [f"a{k}", f"b{k}"], 6)]
    df = spark.createDataFrame(rows, "doc_id long, members array<string>, words long").repartition(4)
    out = mixing.mix(df, F.col("members"), F.col("words"), weights=lambda names: [1] * len(names)).select("doc_id", "size", "taken", "target").collect()
    assert len(out) == len(rows) and all(0 <= r["taken"] <= 3 * r["size"] for r in out)
    linked = {r["doc_id"]: r for r in out if r["doc_id"] >= 20_000}
    assert sum(r["taken"] for r in linked.values()) > 0
    assert all(abs(r["taken"] - r["target"]) <= r["size"] for r in out if r["doc_id"] < 10_500)
