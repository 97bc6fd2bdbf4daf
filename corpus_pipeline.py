"""Corpus pipeline: quality rules, quality classifier, near duplicates, mixing, packing.

Each stage takes the documents its predecessor kept and returns documents again, but the last, which
returns the pieces of packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldcast.llm import mixing, ngram_join, packing, quality_classifier, quality_rules
from yieldcast.llm.common import hold_out, scratch, word_count

NEAR_WORDS = 5           # shingle width of the near-duplicate stage
NEAR_PERCENT = 80        # its similarity


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the outlier estimate keep."""
    return quality_rules.keep_good(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more by a model of the labels that are not held out and of these documents' texts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~hold_out(F.col("doc_id")))
    model = quality_classifier.train(docs, labels)
    scored = quality_classifier.score(docs.select(F.struct("*").alias("row"), "text"), model)
    return scored.where("score >= 0.5").select([F.col("row").getField(c).alias(c) for c in docs.columns])


def _placed(docs: DataFrame) -> DataFrame:
    """(row, line): line is a row's place, its file and number there, the same in every scan however files are split.

    A frame that is no scan of files is written first.
    """
    def places(df):
        return df.select(F.struct("*").alias("row"), F.struct("_metadata.file_path", "_metadata.row_index").alias("line"))

    try:
        return places(docs)
    except AnalysisException:
        return places(scratch(docs))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: that with the smallest doc_id, of equal ids the first row.

    Documents without words have no duplicates and all stay.
    """
    rows = _placed(docs)
    keyed = rows.select(F.struct("row.doc_id", "line").alias("key"), "row.text")
    part = ngram_join.jaccard_components(keyed, doc_id="key", width=NEAR_WORDS, percent=NEAR_PERCENT)
    gone = part.where("key != component_id").select("key.line")
    return rows.join(gone, "line", "left_anti").select([F.col("row").getField(c).alias(c) for c in docs.columns])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (0 to 3 times), sources weighed 1, 2, 3, ... in code point order."""
    rows = _placed(docs)
    keys = rows.select("row.doc_id", "row.source", word_count(F.col("row.text")).alias("words"), "line")
    taken = mixing.mix(keys, F.array("source"), F.col("words")).where("passes > 0").select("line", "passes")
    often = rows.join(taken, "line").withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("passes"))))
    return often.select([F.col("row").getField(c).alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), markers=True)


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("near_duplicates", near_duplicates_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Fitted models, seeded selection and tokenisation have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the result of each is written once and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
