"""Physical-plan properties the design relies on (checked with explain)."""

import os
import re
import tempfile

from yieldcast.operators.clean import clean_records
from yieldcast.plans.features import feature_table, weekly_table
from yieldcast.sources.fixture import raw_records, with_carried_columns

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _raw_parquet(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="yc-plan-"), "raw")
    with_carried_columns(raw_records(spark, SF)).write.parquet(path)
    return spark.read.parquet(path)


def test_feature_plan_has_three_hash_exchanges(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(feature_table(_raw_parquet(spark)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = re.findall(r"Arguments: hashpartitioning\(([^)]*)", plan)
    # aggregate key, (site, week_date), (site, GL): nothing else re-shuffles
    assert len(exchanges) == 3, exchanges
    assert "SortMergeJoin" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "HashAggregate" in plan  # level 1 is a hash aggregate (partial + final)


def test_cleaning_filters_pushed_and_columns_pruned(spark):
    df = clean_records(_raw_parquet(spark)).select("hashed_fc", "units")
    plan = _plan(df)
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "IsNotNull(gl_product_group)" in pushed and "Not(EqualTo(gl_product_group,-1))" in pushed
    assert "Not(EqualTo(recovery_type,C-Returns))" in pushed
    read_schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(f.split(":")[0] for f in read_schema.split(",")) == {
        "hashed_fc", "units", "gl_product_group", "recovery_type"}


def test_weekly_plan_is_codegen_and_single_raw_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(weekly_table(_raw_parquet(spark)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(re.findall(r"Arguments: hashpartitioning", plan)) == 2
    assert "[codegen id" in plan
