import numpy as np

from yieldcast.llm import quality_classifier as C
from yieldcast.llm.common import hold_out


def corpus(rng, words, n=900):
    rows, labels = [], []
    for i in range(n):
        text = " ".join(rng.choices(words, k=rng.randint(15, 200)))
        good = i % 7 != 0
        if not good:
            text = " ".join(w.upper() + rng.choice(["###", "!!", "$$$"]) for w in text.split())
        rows.append((i, text, "clash"))
        if i % 2:
            labels.append((i, int(good)))
    return rows, labels


def test_held_out_accuracy(spark, rng, words):
    rows, labels = corpus(rng, words)
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    model = C.train(docs, marks.where(~hold_out(marks.doc_id)))
    got = {r.doc_id: r for r in C.score(docs.withColumn("held", hold_out(docs.doc_id)), model).collect()}
    held = [r.doc_id for r in got.values() if r.held]
    right = sum((got[i].score >= 0.5) == (i % 7 != 0) for i in held)
    assert len(held) > 200 and right / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_score_depends_on_the_text_alone(spark, rng, words):
    rows, labels = corpus(rng, words, 300)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = C.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    odd = [(None, None, "x"), (5, "", None), (5, " \n", "y"), (-1, rows[1][1], "z"), (10 ** 12, rows[1][1], None), (6, "word " * 300_000, "")]
    got = [r.score for r in C.score(spark.createDataFrame(odd, "doc_id long, text string, lang string"), model).collect()]
    assert all(0 <= s <= 1 for s in got) and got[3] == got[4] and got[0] == got[1] == got[2]


def test_no_labels_no_documents(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    assert C.train(docs, none) is None
    assert [r.score for r in C.score(docs, None).collect()] == [0.5]
    marks = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert C.train(docs.limit(0), marks) is None and C.score(docs.limit(0), None).count() == 0


def test_risk_never_goes_below_zero_and_prior_moves_scores():
    gen = np.random.default_rng(1)
    p, neg = gen.normal(1.5, 1, (400, C._N_STATS)), gen.normal(-1.5, 1, (400, C._N_STATS))
    u = np.vstack([gen.normal(1.5, 1, (600, C._N_STATS)), neg])
    model = C.fit_nnpu(p, u, 0.6)
    assert C.score_statistics(p, model).mean() > 0.9 and C.score_statistics(neg, model).mean() < 0.1


def test_clashing_names_repeated_and_null_ids(spark, words, rng):
    """A column named id beside the key, one id on all rows, and ids that are null."""
    good = [" ".join(rng.choice(words) for _ in range(60)) + "." for _ in range(40)]
    bad = ["$$$ ### " * 30 for _ in range(40)]
    rows = [(k % 3 if k % 5 else None, t, 7, "x") for k, t in enumerate(good + bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id long, _key string")
    labels = spark.createDataFrame([(0, 1, 9), (1, 1, 9), (2, 0, 9), (None, 1, 9)], "doc_id long, quality int, id long")
    model = C.train(docs, labels)
    assert model is not None and C.score(docs.drop("_key"), model).count() == 80


def test_thinned_samples_spread_over_equal_rows(spark):
    rows = spark.createDataFrame([(1, "same")] * 20000, "_id long, _text string").repartition(4)
    assert abs(C._thinned(rows, 20000, 5000).count() - 5000) < 400
    assert C._thinned(rows, 20000, 50000).count() == 20000
