import re

import pytest

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """Rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in P.STAGES:
        done = stage(spark, out[-1], SF)
        out.append(spark.createDataFrame(done.collect(), done.schema))
    return out


def test_stages_return_documents(kept):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "quality_classifier", "near_duplicates", "mixing", "packing"]
    for df in kept[1:-1]:
        assert df.columns == kept[0].columns
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in kept]
    assert all(a >= b for a, b in zip(ids, ids[1:])) and len(ids[1]) < len(ids[0])


def test_near_duplicates_keep_one_of_each_component(kept):
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)}

    before = {r.doc_id: shingles(r.text) for r in kept[2].collect()}
    after = {r.doc_id for r in kept[3].collect()}
    up = {i: i for i in before}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(before)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(before[i] & before[j])
            if 100 * both >= 80 * (len(before[i]) + len(before[j]) - both):
                a, b = sorted((find(i), find(j)))
                up[b] = a
    assert after == {i for i in ids if find(i) == i}


def test_packed_documents_are_the_mixed_ones(kept):
    pieces, mixed = kept[5].collect(), [r.doc_id for r in kept[4].collect()]
    assert {p.doc_id for p in pieces} == set(mixed)
    for doc_id in set(mixed):
        mine = [p for p in pieces if p.doc_id == doc_id]
        assert sum(p.length for p in mine) == mixed.count(doc_id) * mine[0].doc_tokens


def test_stages_take_nulls_and_repeated_rows(spark):
    rows = [(1, None, None, None, None), (1, "a b c", "en", "s", 3), (None, "one two three four five six seven eight nine ten eleven", "en", None, 1)]
    df = spark.createDataFrame(rows * 2, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in P.STAGES:
        stage(spark, df, SF).collect()
        assert stage(spark, df.limit(0), SF).collect() == []
    assert len(P.near_duplicates_stage(spark, df, SF).collect()) == 4


def test_run(spark):
    assert P.run(spark, SF).count() > 0


def test_rows_keep_their_line_when_scans_order_them_anew(spark):
    def stir(batches):      # another order of rows in every scan
        import random

        import pyarrow as pa
        rows = [r for b in batches for r in b.to_pylist()]
        random.SystemRandom().shuffle(rows)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    import pyarrow as pa
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
    rows = [(i, " ".join(f"w{i % 40}x{k}" for k in range(12)), "en", f"s{i % 3}", 1) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    docs = df.mapInArrow(stir, df.schema)
    assert sorted(r.doc_id for r in P.near_duplicates_stage(spark, docs, SF).collect()) == list(range(40))
    want = sorted(r.doc_id for r in P.mixing_stage(spark, df, SF).collect())
    assert sorted(r.doc_id for r in P.mixing_stage(spark, docs, SF).collect()) == want
