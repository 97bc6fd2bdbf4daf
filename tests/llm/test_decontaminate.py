import hashlib
import re

import numpy as np

from yieldcast.llm import bit_filter
from yieldcast.llm import decontaminate as D

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    found = {}
    for i, t in items:
        w = words(t)
        m = min(len(w), window)
        for s in range(len(w) - m + 1 if m else 0):
            found.setdefault(tuple(w[s:s + m]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, its = words(t), set(), set()
        for m in {len(k) for k in found}:
            for s in range(len(w) - m + 1):
                if tuple(w[s:s + m]) in found:
                    hit |= set(range(s, s + m))
                    its |= found[tuple(w[s:s + m])]
        out.append((d, len(w), len(hit), len(its), hashlib.sha256(",".join(sorted(its)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def got(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, line long, m long").repartition(3)
    b = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, f long").repartition(2)
    return sorted((tuple(r) for r in D.decontaminate(d, b).collect()), key=str)


def test_shared_passages_match_brute_force(spark, rng, words):
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([3, 8, 10, 11, 40])))) for k in range(30)]
    items += [(90, items[4][1]), (91, items[4][1] + " and more of it")]
    docs = []
    for k in range(120):
        text = [rng.choice(words) for _ in range(rng.randint(0, 80))]
        for _ in range(rng.choice([0, 0, 1, 3])):
            part = rng.choice(items)[1].split()
            a = rng.randint(0, max(0, len(part) - 9))
            text[rng.randint(0, len(text)):0] = part[a:a + rng.choice([9, 10, 25])]
        docs.append((k, rng.choice([" ", "\n", ", ", "--"]).join(text).title()))
    assert got(spark, docs, items) == brute(docs, items)


def test_nulls_short_items_overlaps_repeats_and_ties(spark):
    items = [(3, "One"), (10, "déjà vu"), (2, "déjà vu"), (None, "a b c"), (5, None), (6, " -- "), (7, "x " * 30), (7, "x " * 30)]
    docs = [(1, None), (1, None), (None, "one ONE one"), (2, "DÉJÀ vu"), (3, "déjà-vu, a.b.c"), (4, ""), (5, "x " * 4000), (6, "x " * 9), (7, "\x00one\x7f")]
    assert got(spark, docs, items) == brute(docs, items)


def test_no_window_crosses_documents(spark):
    item = [(1, "a b c d e f g h i j k l")]
    docs = [(k, t) for k, t in enumerate(["a b c d e", "f g h i j k l", "a b c d e f g h i j", "b c d e f g h i j k"])]
    assert got(spark, docs, item) == brute(docs, item)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a b c")]) == []
    docs = [(1, "a b"), (2, None)]
    assert got(spark, docs, []) == brute(docs, []) == got(spark, docs, [(1, None)])


def test_filter_lets_its_members_pass(spark):
    held = spark.range(-500, 500).selectExpr("xxhash64(id) as h")
    bits = bit_filter.build(held, "h")
    member = held.toPandas()["h"].to_numpy().view(np.uint64)
    assert bit_filter.may_hold(bits, member).all()
    assert bit_filter.may_hold(bits, member + np.uint64(1)).mean() < 0.2
