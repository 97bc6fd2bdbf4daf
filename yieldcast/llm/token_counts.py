"""Token counts under a unigram language model, by dynamic programming shared along a trie.

A text's pre-tokens are its words, each after a word mark. The distinct pre-tokens of a batch are put in
order, which is the depth-first order of their trie, and walked with one stack of forward
scores: a prefix that many pre-tokens share is scored once, and a pre-token's count is read at its terminal node.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
BATCH_WORDS = 1_000_000    # words whose distinct pre-tokens share a trie


def unigram_model(path: str) -> dict[str, float]:
    """Log probabilities of the pieces of a sentencepiece file: the r-th plain piece weighs 1 / (r + 2.7) (a Zipf-Mandelbrot law)."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [p.id_to_piece(i) for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i))]
    total = sum(1 / (r + 2.7) for r in range(len(plain)))
    return {piece: math.log(1 / (r + 2.7) / total) for r, piece in enumerate(plain)}


def byte_score(model: dict[str, float]) -> float:
    """Score of one byte of a character that no piece holds: below every piece."""
    return min(model.values(), default=0.0) - 1.0


def trie_counts(pre_tokens: list[str], model: dict[str, float], longest: int, byte: float) -> list[int]:
    """Tokens of each of the sorted, distinct ``pre_tokens`` in its best segmentation.

    Node d of the stack holds the best score of the prefix of d characters and the tokens of that segmentation; of
    equal scores the one with fewer tokens, then with the longer last piece, counts. A character may always be split into its
    UTF-8 bytes, one token each.
    """
    score, count = [0.0], [0]
    before, out = "", []
    for word in pre_tokens:
        shared, most = 0, min(len(before), len(word))
        while shared < most and before[shared] == word[shared]:
            shared += 1
        del score[shared + 1:], count[shared + 1:]
        for d in range(shared + 1, len(word) + 1):
            width = len(word[d - 1].encode("utf-8", "replace"))
            best, n = score[d - 1] + width * byte, count[d - 1] + width
            for start in range(max(0, d - longest), d):
                value = model.get(word[start:d])
                if value is not None:
                    value += score[start]
                    if value > best or (value == best and count[start] + 1 < n):
                        best, n = value, count[start] + 1
            score.append(best)
            count.append(n)
        before = word
        out.append(count[len(word)])
    return out


def _count_task(batches: Iterator, path: str) -> Iterator:
    import pyarrow as pa

    model = unigram_model(path)
    longest, byte = max(map(len, model), default=1), byte_score(model)

    def counted(ids, lists):
        distinct = sorted({w for words in lists for w in words})
        tokens = dict(zip(distinct, trie_counts(distinct, model, longest, byte)))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(w) for w in lists], pa.int64()),
             pa.array([sum(map(tokens.__getitem__, w)) for w in lists], pa.int64())], ["doc_id", "n_words", "n_tokens"])

    for batch in batches:
        ids, lists, held = [], [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = [MARK + w for w in (text.as_py() or "").split()]
            ids.append(doc_id)
            lists.append(words)
            held += len(words)
            if held >= BATCH_WORDS:
                yield counted(ids, lists)
                ids, lists, held = [], [], 0
        if ids:
            yield counted(ids, lists)


def token_counts(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens) of every row, over its whole text, in the task that reads it.

    ``tokenizer``: path of a sentencepiece file on every executor. Words are separated by Unicode white space. Null, empty and
    blank texts have 0 of both. Repeated rows and ids are counted each; null ids stay null. An empty table gives an empty
    result. Only the two named columns are read. A task holds one batch of about BATCH_WORDS words (or one longer text).
    """
    def task(batches: Iterator) -> Iterator:
        return _count_task(batches, tokenizer)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(task, "doc_id long, n_words long, n_tokens long")
