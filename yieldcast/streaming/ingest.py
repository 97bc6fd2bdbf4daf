"""Incremental ingest of raw record files with Structured Streaming.

The batch pipeline reads whole yearly files. When files land over time
(a new week or year), the same cleaning and the level-1 aggregate run per
micro-batch: each batch's partial aggregate is written to
``{table}/batch_id=<n>`` (overwrite of that one folder, so a replayed batch
after a failure is idempotent -- exactly-once with the checkpointed source
offsets). Partials are folded by ``fold_partials``: sums and counts add up
exactly and attributes take ``min``, so the result equals aggregating all
files at once. No state is kept in the stream itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldcast import schema as S
from yieldcast.operators.aggregate import _measures
from yieldcast.operators.clean import clean_records
from yieldcast.operators.temporal import iso_week_monday_col
from yieldcast.sources.files import CSV_DELIMITER, header_groups, typed_columns


def raw_stream(spark: SparkSession, folder: str, sep: str = CSV_DELIMITER, max_files: int | None = None) -> DataFrame:
    """Streaming scan of delimited raw files, columns matched by header name.

    A stream needs its schema up front, so the column order is that of the
    landed files' headers, which must agree. Every file's header is held against it
    (``enforceSchema`` off): one with another order or other columns fails the batch.
    """
    headers = list(header_groups(spark, [folder], sep))
    if len(headers) != 1:
        raise ValueError(f"files under {folder} have {len(headers)} different headers; a stream needs one")
    header = headers[0]
    text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    reader = spark.readStream.schema(text).option("header", True).option("sep", sep).option("enforceSchema", False)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(folder).select(typed_columns(header, S.RAW_SCHEMA))


def partial_aggregate(batch: DataFrame) -> DataFrame:
    """Level-1 aggregate of one batch of cleaned records (key + week_date + site attributes)."""
    keyed = batch.select("*", iso_week_monday_col().alias(S.WEEK_DATE))
    return keyed.groupBy(*S.AGG_KEYS, S.WEEK_DATE, *S.SITE_ATTRIBUTES).agg(*_measures())


def start_ingest(spark: SparkSession, folder: str, table: str, checkpoint: str, once: bool = True,
                 sep: str = CSV_DELIMITER):
    """Run the ingest query; with ``once`` it processes what is there and stops."""
    stream = clean_records(raw_stream(spark, folder, sep))

    def write_batch(df: DataFrame, batch_id: int) -> None:
        partial_aggregate(df).write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()


def fold_partials(spark: SparkSession, table: str) -> DataFrame:
    """Fold all batch partials into the aggregate of A1 (before channel consolidation)."""
    parts = spark.read.parquet(table).drop("batch_id")
    sums = [c for c in parts.columns if c not in (*S.AGG_KEYS, S.WEEK_DATE, *S.SITE_ATTRIBUTES)]
    return parts.groupBy(*S.AGG_KEYS, S.WEEK_DATE).agg(
        *[F.sum(c).alias(c) for c in sums], *[F.min(c).alias(c) for c in S.SITE_ATTRIBUTES])
