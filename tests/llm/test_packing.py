import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from yieldcast.llm import packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_differencing_balances(rng):
    for windows in (2, 5, 16):
        sizes = [rng.randint(1, 100) for _ in range(windows * 8)]
        place = packing.differencing(sizes, windows)
        sums = [sum(s for s, w in zip(sizes, place) if w == k) for k in range(windows)]
        assert sum(sums) == sum(sizes) and max(sums) - min(sums) <= 30


def test_differencing_known_case():
    sizes = [8, 7, 6, 5, 4]
    place = packing.differencing(sizes, 2)
    sums = sorted(sum(s for s, w in zip(sizes, place) if w == k) for k in range(2))
    assert sums == [14, 16]     # the published result of largest differencing for these numbers


def test_group_window_count_rises_over_capacity():
    place = packing.pack_group([700, 700, 600], 1024)
    assert len(set(place)) == 3
    assert packing.pack_group([], 1024) == []


def check(spark, rows):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    df = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string")
    pieces = packing.pack(df.repartition(3), PATH).collect()
    want = defaultdict(list)
    for doc_id, text, _ in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        want[doc_id].append(ids)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    for doc_id, docs in want.items():
        assert sum(p.length for p in by_doc[doc_id]) == sum(map(len, docs))
        if len(docs) == 1:
            at = 0
            for p in sorted(by_doc[doc_id], key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(docs[0])
                assert p.ids_crc32 == zlib.crc32(docs[0][at:at + p.length].tobytes())
                at += p.length
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
    return pieces, by_seq


def test_pack_round_trip(spark, rng, words):
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 900))) + " <|endoftext|> é漢\n\n  x", "clash") for i in range(200)]
    rows += [(1000, None, None), (1001, "", ""), (1002, " ".join(rng.choices(words, k=40_000)), "long"), (None, "no id", "")]
    rows += [(2000, "again and again", "")] * 50
    pieces, by_seq = check(spark, rows)
    total = sum(p.length for p in pieces)
    padded = sum(1024 for _ in by_seq)
    assert total / padded > 0.97


def test_pack_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_queries_take_ids_of_tokenizers_defaults(spark, tmp_path):
    tokenizer = Tokenizer.from_file(PATH)
    assert tokenizer.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x  \n<|endoftext|><|endoftext|>  y", "<|endoftext| >", "<|endoftext|>" * 1500, "no marker", "é漢  <|endoftext|>\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    for pieces in (queries.op3_packing(spark, str(tmp_path)), corpus_pipeline.packing_stage(spark, df, "")):
        at = [0] * len(texts)
        for p in sorted(pieces.collect(), key=lambda p: (p.doc_id, p.start)):
            ids = np.array(tokenizer.encode(texts[p.doc_id], add_special_tokens=False).ids + [0], dtype="<u4")
            assert p.start == at[p.doc_id] and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())
            at[p.doc_id] += p.length
            assert p.start + p.length <= len(ids)
        assert at == [len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in texts]
