"""Raw recovery records derived from the driver's TPC-H style tables.

This only maps rows into the raw schema the pipeline expects (site, week,
product group, channel, units ...). It does none of the pipeline's work; the
mapping is the same SELECT the oracle runs in DuckDB (FIXTURES.md section 5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed mapping of (l_orderkey * 7 + l_linenumber * 3 + l_partkey) % 20 to a channel.
_CHANNEL_BY_CODE = [
    (0, "Return to Vendor"), (1, "Remove Return"), (2, "Donations"), (3, "Bintool Donations"),
    (4, "Liquidations"), (5, "Bintool Remove Liquidate"), (6, "Remove Liquidate"),
    (7, "Warehouse Deals and G&R"), (8, "Bintool Theft"), (9, "C-Returns"),
]


def _table(spark: SparkSession, sf_dir: str, name: str, cols: list[str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw record per lineitem, in the raw schema (plus ``vendor_name`` all null)."""
    l = _table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                          "l_quantity", "l_extendedprice", "l_discount",
                                          "l_linestatus", "l_shipdate"]).alias("l")
    p = _table(spark, sf_dir, "part", ["p_partkey", "p_type", "p_size"]).alias("p")
    s = _table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"]).alias("s")
    n = _table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"]).alias("n")
    r = _table(spark, sf_dir, "region", ["r_regionkey", "r_name"]).alias("r")

    # part is a dimension that grows with the data: leave the strategy to the
    # planner/AQE. nation and region are fixed 25- and 5-row tables.
    joined = (l.join(p, F.col("p.p_partkey") == F.col("l.l_partkey"))
              .join(s, F.col("s.s_suppkey") == F.col("l.l_suppkey"))
              .join(F.broadcast(n), F.col("n.n_nationkey") == F.col("s.s_nationkey"))
              .join(F.broadcast(r), F.col("r.r_regionkey") == F.col("n.n_regionkey")))

    ship = F.col("l_shipdate")
    code = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3 + F.col("l_partkey")) % 20
    channel = F.when(F.lit(False), F.lit(None).cast("string"))
    for k, name in _CHANNEL_BY_CODE:
        channel = channel.when(code == k, F.lit(name))
    channel = channel.otherwise(
        F.when(F.col("n_nationkey") == 0, F.lit("Liquidations")).otherwise(F.lit("Sales")))

    return joined.select(
        F.col("n_name").alias("hashed_fc"),
        F.year(F.date_add(F.to_date(F.date_trunc("week", ship)), 3)).alias("year"),
        F.month(ship).alias("month"),
        F.weekofyear(ship).alias("week"),
        F.when(F.col("p_size") == 50, F.lit(-1)).when(F.col("p_size") == 49, F.lit(None))
        .otherwise(F.col("p_size") % 4).cast("int").alias("gl_product_group"),
        F.when(F.col("p_type").isin("ECONOMY", "SMALL"), "Food")
        .when(F.col("p_type").isin("MEDIUM", "PROMO", "STANDARD"), "Non Food")
        .otherwise("Pet Food").alias("product_type"),
        F.when(F.col("l_linestatus") == "F", "FBA").otherwise("RETAIL").alias("macro_category"),
        F.when(F.col("l_discount") >= 0.08, "Y").otherwise("N").alias("is_hazmat"),
        F.col("l_quantity").cast("bigint").alias("units"),
        F.col("l_extendedprice").alias("cogs"),
        (F.col("l_quantity") * F.col("p_size")).alias("weight"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("country_state"),
        F.col("n_nationkey").cast("string").alias("zip_code"),
        F.when(F.col("n_nationkey") % 3 == 0, "SORT").otherwise("FC").alias("site_type"),
        F.col("r_name").alias("site_category"),
        channel.alias("recovery_type"),
        F.lit(None).cast("string").alias("vendor_name"),
        F.col("n_name").alias("marketplace_id"),
    )


def with_carried_columns(df: DataFrame) -> DataFrame:
    """Add the six carried string columns as constants (never computed on)."""
    from yieldcast import schema as S
    return df.select("*", *[F.lit("x").alias(c) for c in S.CARRIED_COLUMNS])


# DuckDB text of the same mapping, used by the SQL oracles.
RAW_SQL = """
SELECT n.n_name AS hashed_fc,
  CAST(year(CAST(date_trunc('week', l.l_shipdate) AS DATE) + INTERVAL '3' DAY) AS INTEGER) AS year,
  CAST(month(l.l_shipdate) AS INTEGER) AS month,
  CAST(extract(week FROM l.l_shipdate) AS INTEGER) AS week,
  CAST(CASE WHEN p.p_size = 50 THEN -1 WHEN p.p_size = 49 THEN NULL ELSE p.p_size % 4 END AS INTEGER) AS gl_product_group,
  CASE WHEN p.p_type IN ('ECONOMY','SMALL') THEN 'Food'
       WHEN p.p_type IN ('MEDIUM','PROMO','STANDARD') THEN 'Non Food' ELSE 'Pet Food' END AS product_type,
  CASE WHEN l.l_linestatus = 'F' THEN 'FBA' ELSE 'RETAIL' END AS macro_category,
  CASE WHEN l.l_discount >= 0.08 THEN 'Y' ELSE 'N' END AS is_hazmat,
  CAST(l.l_quantity AS BIGINT) AS units, l.l_extendedprice AS cogs, l.l_quantity * p.p_size AS weight,
  n.n_name AS country, r.r_name AS country_state, CAST(n.n_nationkey AS VARCHAR) AS zip_code,
  CASE WHEN n.n_nationkey % 3 = 0 THEN 'SORT' ELSE 'FC' END AS site_type, r.r_name AS site_category,
  CASE (l.l_orderkey * 7 + l.l_linenumber * 3 + l.l_partkey) % 20
    WHEN 0 THEN 'Return to Vendor' WHEN 1 THEN 'Remove Return' WHEN 2 THEN 'Donations'
    WHEN 3 THEN 'Bintool Donations' WHEN 4 THEN 'Liquidations' WHEN 5 THEN 'Bintool Remove Liquidate'
    WHEN 6 THEN 'Remove Liquidate' WHEN 7 THEN 'Warehouse Deals and G&R' WHEN 8 THEN 'Bintool Theft'
    WHEN 9 THEN 'C-Returns'
    ELSE CASE WHEN n.n_nationkey = 0 THEN 'Liquidations' ELSE 'Sales' END END AS recovery_type,
  CAST(NULL AS VARCHAR) AS vendor_name, n.n_name AS marketplace_id
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
JOIN supplier s ON s.s_suppkey = l.l_suppkey
JOIN nation n ON n.n_nationkey = s.s_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey
"""
