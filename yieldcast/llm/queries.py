"""Queries over the training-data tables, one for each operator, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldcast.llm import (
    chat_format, collocations, decontaminate, html_extract, mixing, ngram_join, packing, prefix_trie, quality_classifier, quality_rules,
    token_counts, topk_search, warc,
)
from yieldcast.llm.common import hold_out, word_count
from yieldcast.llm.oracles import ORACLES  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix of all documents: words taken of each, sources weighed 1, 2, 3, ... in code point order."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("words"))
    return mixing.mix(sized, F.array("source"), F.col("words")).select("doc_id", "size", "source_size", "target", "taken")


def raw_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in transcripts: each turn as raw lines in one of five notations, chosen per conversation.

    The role stays beside the raw text for training and for judging results only.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("seq"), "role", "text")
    style = F.crc32(F.concat(F.lit("style "), F.col("conv_id").cast("string")).cast("binary")) % 5
    plain = F.initcap("role")
    human = F.when(F.col("role") == "user", "Human").when(F.col("role") == "assistant", "AI").otherwise("Instructions")
    mark = (F.when(style == 0, F.concat(plain, F.lit(": "))).when(style == 1, F.concat(F.lit("### "), human, F.lit("\n")))
            .when(style == 2, F.concat(F.lit("["), F.col("role"), F.lit("] "))).when(style == 3, F.lit("Speaker: ")).otherwise(F.lit("")))
    return turns.select("conv_id", "seq", "role", F.concat(mark, F.coalesce("text", F.lit(""))).alias("text"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical turns of all transcripts; the model learns from conversations that are not held out."""
    raw = raw_transcripts(spark, sf_dir)
    model = chat_format.train(raw.where(~hold_out(F.col("conv_id"))), turn="seq")
    return chat_format.format_chats(raw.drop("role"), model)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, tokenised and packed into sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), markers=True)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; rows held out give no labels to the training."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~hold_out(F.col("doc_id")))
    scored = quality_classifier.score(docs, quality_classifier.train(docs, labels))
    return scored.select("doc_id", hold_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by a Jaccard similarity of 0.9 or more over 3-word shingles."""
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector with all others."""
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, base rule and robust outlier verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality_rules.quality_rules(docs).drop("lang", "source")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and unigram tokens of every document."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back from them."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, rebuilt with shared starts."""
    turns = prefix_trie.numbered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.with_shared_starts(turns))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand inside a benchmark window, and the items they come from."""
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of each language over all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_source_mixing, op2_chat_format, op3_packing, op4_quality_classifier, op5_ngram_jaccard, op6_topk_search,
    op7_quality_rules, op8_token_counts, op9_warc, op10_html_extract, op11_prefix_trie, op12_decontaminate, op13_collocations)}
