import math

import public_tokenizers

from yieldcast.llm import token_counts as T

MODEL = {"a": -1.0, "b": -1.5, "ab": -2.0, "abc": -2.2, "c": -3.0, "▁": -0.5, "▁a": -1.2, "bc": -1.9}


def brute(word, model, byte):
    """Fewest tokens among the segmentations of the best score."""
    best = [(0.0, 0)]
    for d in range(1, len(word) + 1):
        width = len(word[d - 1].encode())
        ways = [(best[d - 1][0] + width * byte, best[d - 1][1] + width)]
        ways += [(best[s][0] + model[word[s:d]], best[s][1] + 1) for s in range(d) if word[s:d] in model]
        top = max(w[0] for w in ways)
        best.append((top, min(n for s, n in ways if s == top)))
    return best[-1][1]


def test_trie_counts_match_one_by_one(rng):
    byte = T.byte_score(MODEL)
    pre = sorted({"▁" + "".join(rng.choices("abcdé", k=rng.randint(0, 9))) for _ in range(500)} | {""})
    assert T.trie_counts(pre, MODEL, 3, byte) == [brute(w, MODEL, byte) for w in pre]


def test_small_case_by_hand():
    byte = T.byte_score(MODEL)
    # "▁" + "abc" costs 2.7, "▁a" + "bc" 3.1
    assert T.trie_counts(["▁abc", "▁漢"], MODEL, 3, byte) == [2, 4]


def test_table(spark, rng, words):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = T.unigram_model(path)
    assert abs(sum(map(math.exp, model.values())) - 1) < 1e-9
    byte = T.byte_score(model)
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 80))), "x") for i in range(60)]
    rows += [(100, None, "x"), (101, "", None), (102, " \n", "x"), (None, "one", "x"), (103, "é" * 3000, "x")] + [(104, "again", "x")] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    got = sorted((tuple(r) for r in T.token_counts(df, path).collect()), key=key)
    want = [(i, len((t or "").split()), sum(brute("▁" + w, model, byte) for w in (t or "").split())) for i, t, _ in rows]
    assert got == sorted(want, key=key)
    assert T.token_counts(df.limit(0), path).collect() == []
