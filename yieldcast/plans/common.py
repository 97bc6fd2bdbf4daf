"""Shared inputs for the registered queries: the raw fixture and derived stages."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import yieldcast
from yieldcast import schema as S
from yieldcast.functions.scalar import round_half_away
from yieldcast.operators import aggregate as A
from yieldcast.operators import clean as C
from yieldcast.plans.features import weekly_table
from yieldcast.session import checkpoint_dir
from yieldcast.sources.fixture import raw_records, with_carried_columns
from yieldcast.sources.stage import stage_table

# Year split of the fixture data: ISO years 1995-2001; 2001 is the test year
# and the last training year (2000) is the validation fold.
TRAIN_YEARS = [1995, 1996, 1997, 1998, 1999, 2000]
TEST_YEARS = [2001]
VALID_YEARS = [2000]


def finalize(df: DataFrame, decimals: int = 6) -> DataFrame:
    """Round doubles for comparison (and turn -0.0 into 0.0)."""
    return df.select([
        (round_half_away(F.col(f.name), decimals) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_records(spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_records(with_carried_columns(raw(spark, sf_dir)))


def aggregated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.consolidate_channels(A.aggregate_site_gl_week(cleaned(spark, sf_dir)))


def application_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Place of a stage table of this application and input folder, in the shared folder."""
    key = hashlib.sha1(f"{sf_dir}|{yieldcast.__version__}|{spark.sparkContext.applicationId}".encode()).hexdigest()[:16]
    return f"{checkpoint_dir(spark)}/{name}-{key}"


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly table as a stage table (S7): raw records are read once per application and input folder."""
    return stage_table(spark, application_path(spark, sf_dir, "weekly"),
                       lambda: weekly_table(with_carried_columns(raw(spark, sf_dir))))
