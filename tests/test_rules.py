"""Hand-made frames for reader, stage-table, metric and report rules."""

import os

import pytest
from pyspark.sql import functions as F

from yieldcast import schema as S
from yieldcast.models import attribution as AT
from yieldcast.operators import baseline as B
from yieldcast.operators import explore as X
from yieldcast.operators import metrics as M
from yieldcast.operators import report as R
from yieldcast.sources import files, stage


def write(path, lines):
    path.write_text("\n".join("\t".join(x) for x in lines) + "\n")


def test_csv_columns_follow_each_files_header(spark, tmp_path):
    write(tmp_path / "a.csv", [("hashed_fc", "country", "units"), ("S1", "US", "3")])
    write(tmp_path / "b.csv", [("units", "country", "hashed_fc"), ("4", "CA", "S2")])
    write(tmp_path / "c.csv", [("hashed_fc", "units"), ("S3", "5")])
    (tmp_path / "d.csv").write_text("")
    with pytest.raises(ValueError, match="c.csv lacks columns .'country'"):
        files.read_raw_csv(spark, str(tmp_path))
    got = files.read_raw_csv(spark, str(tmp_path), allow_missing=True).select("hashed_fc", "country", "units", "cogs").collect()
    assert sorted(map(tuple, got)) == [("S1", "US", 3, None), ("S2", "CA", 4, None), ("S3", None, 5, None)]


def test_csv_malformed_number_fails(spark, tmp_path):
    write(tmp_path / "a.csv", [("hashed_fc", "units"), ("S1", "x")])
    with pytest.raises(Exception):
        files.read_raw_csv(spark, str(tmp_path)).collect()


def test_extensions_decide_the_reader(spark, tmp_path):
    assert [files.resolve_format(p) for p in ("a.csv", "b/c.PARQUET", "s3a://x/y.tsv/")] == ["csv", "parquet", "csv"]
    for bad, error in ((3, TypeError), ("plain", ValueError), ("a.xlsx", ValueError)):
        with pytest.raises(error):
            files.resolve_format(bad)
    with pytest.raises(ValueError):
        files.load(spark, [])


def test_formats_are_stacked_by_name(spark, tmp_path):
    write(tmp_path / "a.csv", [("hashed_fc", "units"), ("S1", "1")])
    part = files.read_raw_csv(spark, str(tmp_path / "a.csv"))
    part.select(*reversed(part.columns)).write.parquet(str(tmp_path / "b.parquet"))
    both = files.load(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.parquet")])
    assert sorted(map(tuple, both.select("hashed_fc", "units").collect())) == [("S1", 1), ("S1", 1)]


def test_many_headers_are_read_side_by_side(spark, tmp_path):
    for k in range(300):
        write(tmp_path / f"f{k:03d}.csv", [("hashed_fc", "units") if k % 2 else ("units", "hashed_fc"), ("S", "1") if k % 2 else ("1", "S")])
    groups = files.header_groups(spark, [str(tmp_path)])
    assert sorted(map(len, groups.values())) == [150, 150]
    assert files.read_raw_csv(spark, str(tmp_path)).where("hashed_fc = 'S' and units = 1").count() == 300


def test_required_columns_and_row_counts(spark):
    from yieldcast.operators import clean as C
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert C.require_columns(df, ["a"]) is df
    with pytest.raises(ValueError, match="'c', 'd'"):
        C.require_columns(df, ["d", "a", "c"])
    assert sorted(map(tuple, C.row_counts(x=df, y=df.limit(0)).collect())) == [("x", 1, False), ("y", 0, False)]


def test_names_follow_the_rule():
    assert S.RECOVERY_TYPES["Return to Vendor"] == "return_to_vendor" and S.MACRO_CATEGORIES == {"RETAIL": "RETAIL", "FBA": "FBA"}
    assert S.column_suffix("  Non  Food ") == "non_food"


def test_values_are_shown_as_in_the_narrative(spark):
    from yieldcast.functions.scalar import fmt_value
    rows = [("share_food", 0.1234), ("prob_recovered_lag_1w", 12.5), ("units_total", 1234567.5), ("site_weight_total_week", 2.5), ("avg_cogs_per_unit", 1234.5678),
            ("week", None), ("week", float("nan"))]
    got = [r[0] for r in spark.createDataFrame(rows, "f string, v double").select(fmt_value("f", "v")).collect()]
    assert got == ["12.3%", "1250.0%", "1,234,568", "2", "1234.568", "n/a", "n/a"]


def test_samples_without_a_wide_shuffle(spark):
    """Exact counts with repeated keys, strata with nulls, and the same rows as a full ranking."""
    df = spark.createDataFrame([(k % 400, "abc"[k % 3] if k % 7 else None, float(k)) for k in range(1000)], "id int, g string, x double").repartition(5)
    ranked = B.hash_rank(df, ["id", "x"], 9).where("_rank <= 37").select("id", "x")
    assert sorted(map(tuple, B.sample_rows(df, 37, ["id", "x"], 9).select("id", "x").collect())) == sorted(map(tuple, ranked.collect()))
    assert B.sample_rows(df, 5, ["id"], 1).count() == 5                          # ids repeat
    assert B.sample_rows(df, 5000, ["id"]).count() == 1000 and B.sample_rows(df, 0, ["id"]).count() == 0
    per = {r["g"]: r["count"] for r in B.stratified_sample(df, 40, "g", ["id", "x"]).groupBy("g").count().collect()}
    assert per == {"a": 10, "b": 10, "c": 10, None: 10}
    assert B.sample_rows(df.limit(0), 3, ["id"]).count() == 0


def test_load_wants_equal_columns(spark, tmp_path):
    write(tmp_path / "a.csv", [("hashed_fc", "units"), ("S1", "1")])
    spark.createDataFrame([("S2",)], "hashed_fc string").write.parquet(str(tmp_path / "b.parquet"))
    with pytest.raises(Exception):
        files.load(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.parquet")]).collect()


def test_stage_table_resumes_after_a_crashed_writer(spark, tmp_path):
    path = str(tmp_path / "stage")
    os.makedirs(path)                       # what a killed writer may have left behind
    (tmp_path / "stage" / "part-0").write_text("half")
    assert stage.stage_table(spark, path, lambda: spark.range(3), partition_by=None).count() == 3
    assert stage.stage_table(spark, path, lambda: 1 / 0, partition_by=None).count() == 3
    with pytest.raises(ZeroDivisionError):
        stage.stage_table(spark, str(tmp_path / "other"), lambda: 1 / 0)
    assert sorted(os.listdir(tmp_path)) == ["stage"]


def test_metrics_without_a_second_class(spark):
    df = spark.createDataFrame([(0.2, 0, 1.0), (0.9, 0, 1.0)], "p double, y int, c double")
    assert M.roc_auc(df, "p", "y").first()[0] is None
    assert M.average_precision(df, "p", "y").first()[0] is None
    assert M.regression_metrics(df, "p", "c").first()["r2"] is None
    empty = df.limit(0)
    assert M.roc_auc(empty, "p", "y").first()[0] is None and M.regression_metrics(empty, "p", "c").first()["n"] == 0
    assert M.classification_metrics(empty, "p", "y").first()["accuracy"] is None


def test_auc_of_piled_up_scores(spark):
    rows = [(1e-9 * i, int(i % 3 == 0)) for i in range(3000)] + [(0.5, 1), (0.5, 0)]
    df = spark.createDataFrame(rows, "p double, y int")
    neg = sorted(p for p, y in rows if not y)
    import bisect
    wins = sum(bisect.bisect_left(neg, p) + 0.5 * (bisect.bisect_right(neg, p) - bisect.bisect_left(neg, p)) for p, y in rows if y)
    assert abs(M.roc_auc(df, "p", "y").first()[0] - wins / (len(neg) * (len(rows) - len(neg)))) < 1e-12


def test_band_sample_leaves_out_the_upper_edge(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.6), (3, 0.59)], "k int, prob_recovered double")
    assert sorted(r.k for r in B.band_sample(df, 10, ["k"]).collect()) == [1, 3]


def weekly(spark, rows):
    cols = "hashed_fc string, gl_product_group int, month int, units_total long, units_recovered long"
    return spark.createDataFrame(rows, cols).withColumns({
        "site_type": F.lit("FC"), "site_category": F.lit("c"), "country": F.lit("US"), "share_hazmat": F.lit(0.0),
        "share_FBA": F.lit(0.6), "avg_cogs_per_unit": F.lit(2.0)})


def test_top_keys_rank_by_rate_above_the_floor(spark):
    df = weekly(spark, [("big", 1, 1, 100_000, 10_000), ("bad", 1, 1, 1_000, 900), ("tiny", 1, 1, 999, 999)])
    assert [r[0] for r in X.top_keys(df, S.SITE, 2).collect()] == ["bad", "big"]


def test_quadrants_use_recovered_units_of_pairs_above_the_floor(spark):
    df = weekly(spark, [("a", 1, 1, 10_000, 100), ("b", 1, 1, 500, 400), ("c", 1, 1, 1_000, 300), ("d", 1, 1, 499, 499)])
    got = {r.hashed_fc: r.quadrant for r in X.priority_quadrants(df).collect()}
    assert got == {"a": "low rate, low volume", "b": "high rate, high volume", "c": "low rate, low volume"}


def predictions(spark, rows):
    return spark.createDataFrame(rows, "hashed_fc string, gl_product_group int, year int, month int, week int, units_total long, "
                                       "prob_recovered double, combined_rate double, p_nonzero double, deviation double, baseline_rate double")


def test_trend_leaves_out_full_sites_and_full_gls(spark):
    rows = [("full", 1, 2001, 1, 1, 1, 1.0, 0.9, 1.0, 0.1, 0.5), ("s", 1, 2001, 1, 1, 1, 0.5, 0.4, 1.0, 0.1, 0.5),
            ("s", 1, 2002, 1, 1, 1, 0.7, 0.2, 1.0, 0.1, 0.5), ("s", 2, 2001, 1, 1, 1, 1.0, 0.8, 1.0, 0.1, 0.5)]
    got = R.weekly_trend(predictions(spark, rows), S.SITE).collect()
    assert [(r.hashed_fc, r.week, round(r.mean_pred_rate, 6), round(r.mean_actual_rate, 6)) for r in got] == [("s", 1, 0.3, 0.6)]


def test_monthly_means_are_plain_and_ranked_by_weighted_prediction(spark):
    rows = [("a", 1, 2001, 1, 1, 4_999, 0.5, 0.99, 1.0, 0.1, 0.5), ("b", 1, 2001, 1, 1, 4_000, 0.2, 0.1, 1.0, 0.1, 0.5),
            ("b", 1, 2002, 1, 1, 1_000, 0.4, 0.3, 1.0, 0.1, 0.5)]
    got = R.monthly_actual_vs_pred(predictions(spark, rows), S.SITE).collect()
    assert [(r.hashed_fc, r.month, round(r.mean_actual, 6), round(r.mean_pred, 6), r.n) for r in got] == [("b", 1, 0.3, 0.2, 2)]


def test_deviation_quantiles_take_likely_rows_only(spark):
    rows = [("a", 1, 2001, 1, w, 1, 0.5, 0.5, p, d, 0.5) for w, (p, d) in enumerate([(0.5, 9.0), (0.6, -1.0), (0.9, 3.0)])]
    got = R.deviation_quantiles(predictions(spark, rows)).first()
    assert (round(got.q05, 6), round(got.q95, 6), got.mean_abs, got.mean_signed) == (-0.8, 2.8, 2.0, 1.0)


def test_driver_text():
    available = {"units_total_rolling_12w", "units_total_lag_52w", "x_lag_12w"}
    assert AT.driver_text("units_total", available) == ("Total units", "units_total_rolling_12w", "12-week average")
    assert AT.driver_text("x_lag_1w", available) == ("x (last week)", "x_lag_12w", "12 weeks ago")
    assert AT.driver_text("y", available) == ("y", None, None)
    assert AT.horizon_text("lag", 52) == "same week last year"
