"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs on the driver's tables (region nation ... as views) and must
return the same columns and values as the Spark query of the same name.
Doubles are rounded to 6 places on both sides. The SQL is written out per
stage as CTE text; the fixed feature definitions (which numerator over which
denominator) are shared with the library, the computation is not.
"""

from __future__ import annotations

from yieldcast import schema as S
from yieldcast.operators.aggregate import RECOVERY_MIX, UNIT_AVERAGES, UNIT_SHARES
from yieldcast.operators.temporal import SITE_WEEK_RATIOS, SITE_WEEK_SUMS, ewma_suffix
from yieldcast.sources.fixture import RAW_SQL

CARRIED = ", ".join(f"'x' AS {c}" for c in S.CARRIED_COLUMNS)

CLEAN_SQL = f"""
SELECT hashed_fc, year, month, week, gl_product_group, product_type, macro_category,
  {CARRIED}, is_hazmat, units, cogs, weight, country, country_state, zip_code, site_type,
  site_category, CASE WHEN recovery_type = 'Sales' THEN 0 ELSE 1 END AS recovery, recovery_type
FROM raw
WHERE recovery_type <> 'C-Returns' AND gl_product_group IS NOT NULL AND gl_product_group <> -1
"""

WEEK_DATE_SQL = "CAST(date_trunc('week', make_date(year, 1, 4)) AS DATE) + (week - 1) * 7"


def _csum(cond: str, alias: str) -> str:
    return f"CAST(coalesce(sum(CASE WHEN {cond} THEN units ELSE 0 END), 0) AS BIGINT) AS {alias}"


def _agg_sql() -> str:
    sums = []
    for v, suf in S.MACRO_CATEGORIES.items():
        sums.append(_csum(f"macro_category = '{v}'", f"units_{suf}"))
    for v, suf in S.PRODUCT_TYPES.items():
        sums.append(_csum(f"product_type = '{v}'", f"units_{suf}"))
    sums.append(_csum("recovery_type <> 'Sales'", "units_recovered"))
    for v, suf in S.RECOVERY_TYPES.items():
        sums.append(_csum(f"recovery_type = '{v}'", f"units_{suf}"))
    sums.append(_csum("is_hazmat = 'Y'", "units_hazmat"))
    attrs = ", ".join(f"min({c}) AS {c}" for c in S.SITE_ATTRIBUTES)
    return f"""
SELECT hashed_fc, year, month, week, gl_product_group, {WEEK_DATE_SQL} AS week_date,
  count(*) AS num_records, CAST(coalesce(sum(units), 0) AS BIGINT) AS units_total,
  coalesce(CAST(sum(CAST(round(cogs * 1000000000.0) AS HUGEINT)) AS DOUBLE) / 1000000000.0, 0.0) AS cogs_total,
  coalesce(CAST(sum(CAST(round(weight * 1000000000.0) AS HUGEINT)) AS DOUBLE) / 1000000000.0, 0.0) AS weight_total,
  {attrs},
  {', '.join(sums)}
FROM clean GROUP BY hashed_fc, year, month, week, gl_product_group
"""


AGG_SQL = _agg_sql()

CONS_SQL = """
SELECT * EXCLUDE (units_remove_return, units_bintool_remove_liquidate, units_remove_liquidate,
                  units_donations, units_bintool_donations),
  coalesce(units_remove_return, 0) + coalesce(units_bintool_remove_liquidate, 0)
    + coalesce(units_remove_liquidate, 0) AS units_disposal,
  coalesce(units_donations, 0) + coalesce(units_bintool_donations, 0) AS units_donations
FROM agg
"""


def _ratio_list(spec, zero: bool = False) -> str:
    out = []
    for name, (num, den) in spec.items():
        e = f"CASE WHEN {den} <> 0 THEN CAST({num} AS DOUBLE) / {den} END"
        out.append(f"coalesce({e}, 0.0) AS {name}" if zero else f"{e} AS {name}")
    return ",\n  ".join(out)


SHARES_SQL = f"SELECT *, {_ratio_list(UNIT_SHARES)} FROM cons"
MIX_SQL = f"SELECT *, {_ratio_list(RECOVERY_MIX)} FROM shares"
SITE_SUMS_SQL = "SELECT *, " + ", ".join(
    (f"CAST(sum({src}) OVER (PARTITION BY hashed_fc, week_date) AS BIGINT) AS {name}"
     if src != "weight_total" else f"sum({src}) OVER (PARTITION BY hashed_fc, week_date) AS {name}")
    for name, src in SITE_WEEK_SUMS.items()) + " FROM mix"


def _site_ratios() -> str:
    out = []
    for name, (num, den) in SITE_WEEK_RATIOS.items():
        e = f"CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)"
        if name == "site_recovered_share_week":
            e = f"CASE WHEN isnan({e}) THEN 0.0 ELSE {e} END"
        out.append(f"{e} AS {name}")
    return ", ".join(out)


SITE_RATIOS_SQL = f"SELECT *, {_site_ratios()} FROM site_sums"
AVG_SQL = f"SELECT *, {_ratio_list(UNIT_AVERAGES)} FROM site_ratios"

_DOUBLE_COLS = (["cogs_total", "weight_total", "site_weight_total_week"] + list(UNIT_SHARES)
                + list(RECOVERY_MIX) + list(SITE_WEEK_RATIOS) + list(UNIT_AVERAGES))
WEEKLY_SQL = ("SELECT * REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in _DOUBLE_COLS)
              + ") FROM avgs")


def with_ctes(body: str, upto: str = "weekly") -> str:
    """Prefix ``body`` with the stage CTEs up to ``upto``."""
    stages = [("raw", RAW_SQL), ("clean", CLEAN_SQL), ("agg", AGG_SQL), ("cons", CONS_SQL),
              ("shares", SHARES_SQL), ("mix", MIX_SQL), ("site_sums", SITE_SUMS_SQL),
              ("site_ratios", SITE_RATIOS_SQL), ("avgs", AVG_SQL), ("weekly", WEEKLY_SQL)]
    names = [n for n, _ in stages]
    keep = stages[: names.index(upto) + 1]
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in keep) + "\n" + body


def r6(expr: str, alias: str) -> str:
    return f"round({expr}, 6) + 0.0 AS {alias}"


# Temporal features on the explicitly gridded series (gap rows materialised,
# ROWS frames), the straightforward definition the Spark positions must match.
GRID_CTES = """,
series AS (SELECT hashed_fc, gl_product_group, min(week_date) AS start, max(week_date) AS "end"
           FROM weekly GROUP BY hashed_fc, gl_product_group),
grid AS (SELECT hashed_fc, gl_product_group, start, "end",
                CAST(unnest(generate_series(CAST(start AS TIMESTAMP), CAST("end" AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS week_date
         FROM series),
g AS (SELECT grid.start, grid."end", grid.hashed_fc, grid.gl_product_group, grid.week_date,
             w.* EXCLUDE (hashed_fc, gl_product_group, week_date)
      FROM grid LEFT JOIN weekly w USING (hashed_fc, gl_product_group, week_date)),
gr AS (SELECT *, row_number() OVER (PARTITION BY hashed_fc, gl_product_group
                                    ORDER BY week_date, year, month) AS rn FROM g)
"""

WIN = "PARTITION BY hashed_fc, gl_product_group ORDER BY week_date, year, month"


def temporal_select(cols, lags=(), rolling=(), rolling_long=(), alphas=()) -> list[str]:
    out = []
    for c in cols:
        for n in lags:
            out.append(f"lag({c}, {n}) OVER (w) AS {c}_lag_{n}w")
        for n, m in [(n, max(1, n // 2)) for n in rolling] + [(n, S.LONG_MIN_PERIODS) for n in rolling_long]:
            fr = f"(w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
            out.append(f"CASE WHEN count({c}) OVER {fr} >= {m} THEN avg({c}) OVER {fr} END AS {c}_rolling_{n}w")
        for a in alphas:
            q = 1.0 / (1.0 - a)
            fr = "(w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
            out.append(
                f"CASE WHEN count({c}) OVER {fr} >= {S.EWMA_MIN_PERIODS} AND lag({c}, 1) OVER (w) IS NOT NULL "
                f"THEN sum({c} * pow({q!r}, rn)) OVER {fr} / "
                f"sum(CASE WHEN {c} IS NOT NULL THEN pow({q!r}, rn) END) OVER {fr} END AS {c}_ewma_{ewma_suffix(a)}")
    return out


def temporal_sql(cols, lags=(), rolling=(), rolling_long=(), alphas=(), extra=()) -> str:
    feats = temporal_select(cols, lags, rolling, rolling_long, alphas)
    names = [f.rsplit(" AS ", 1)[1] for f in feats]
    outer = ", ".join(["hashed_fc", "gl_product_group", "year", "month", "week", "week_date", *extra]
                      + [f"round({n}, 6) + 0.0 AS {n}" if ("rolling" in n or "ewma" in n) else n
                         for n in names])
    body = (f"SELECT {outer} FROM (SELECT *, {', '.join(feats)} FROM gr WINDOW w AS ({WIN})) t "
            f"WHERE week IS NOT NULL")
    return with_ctes(GRID_CTES + body)


def temporal_all_sql(cols, digits: int) -> str:
    """All lags, rolling means and EWMA of all columns on the gridded series.

    Rolling means are sums in whole units of 1e-12; a window's NaN and infinite values are counted in one packed sum.
    """
    real = set(_DOUBLE_COLS)
    prep, feats, names = [], [], []
    for c in cols:
        finite = f"CASE WHEN isfinite({c}) THEN {c} END" if c in real else c
        prep += [f"CAST(round({finite} * 1000000000000.0::DOUBLE) AS HUGEINT) AS m_{c}" if c in real else f"CAST({c} AS HUGEINT) * 1000000000000 AS m_{c}"]
        if c in real:
            prep.append(f"CASE WHEN {c} IS NULL THEN 0 WHEN isnan({c}) THEN 1 WHEN {c} = 'inf'::DOUBLE THEN 1000000 "
                        f"WHEN {c} = '-inf'::DOUBLE THEN 1000000000000 ELSE 0 END AS f_{c}")

    def settled(c, fr, value):
        if c not in real:
            return value
        f = f"(sum(f_{c}) OVER {fr})"
        nan, up, down = f"{f} % 1000000 > 0", f"({f} // 1000000) % 1000000 > 0", f"{f} // 1000000000000 > 0"
        return (f"CASE WHEN {nan} OR ({up} AND {down}) THEN 'nan'::DOUBLE WHEN {up} THEN 'inf'::DOUBLE WHEN {down} THEN '-inf'::DOUBLE ELSE {value} END")

    for c in cols:
        for n in S.LAG_WEEKS:
            feats.append(f"lag({c}, {n}) OVER (w) AS {c}_lag_{n}w")
            names.append(f"{c}_lag_{n}w")
        for n, m in [(n, max(1, n // 2)) for n in S.ROLLING_WEEKS] + [(n, S.LONG_MIN_PERIODS) for n in S.ROLLING_WEEKS_LONG]:
            fr = f"(w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
            mean = f"CAST(coalesce(sum(m_{c}) OVER {fr}, 0) AS DOUBLE) / CAST(count({c}) OVER {fr} AS DOUBLE) / 1000000000000.0::DOUBLE"
            feats.append(f"CASE WHEN count({c}) OVER {fr} >= {m} THEN {settled(c, fr, mean)} END AS {c}_rolling_{n}w")
            names.append(f"round({c}_rolling_{n}w, 6) + 0.0 AS {c}_rolling_{n}w")
        for a in S.EWMA_ALPHAS:
            q, fr, name = 1.0 / (1.0 - a), "(w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)", f"{c}_ewma_{ewma_suffix(a)}"
            finite = f"CASE WHEN isfinite({c}) THEN {c} END" if c in real else c
            value = f"sum({finite} * pow({q!r}, rn)) OVER {fr} / sum(CASE WHEN {c} IS NOT NULL THEN pow({q!r}, rn) END) OVER {fr}"
            feats.append(f"CASE WHEN count({c}) OVER {fr} >= {S.EWMA_MIN_PERIODS} AND lag({c}, 1) OVER (w) IS NOT NULL THEN {settled(c, fr, value)} END AS {name}")
            place = f"(floor(log10(abs({name}))) + 1 - {digits})"
            size = f"pow(10.0, abs({place}))"
            names.append(f"CASE WHEN {name} = 0 OR NOT isfinite({name}) THEN {name} WHEN {place} < 0 THEN round({name} * {size}) / {size} "
                         f"ELSE round({name} / {size}) * {size} END AS {name}")
    body = (f"{GRID_CTES}, gp AS (SELECT *, {', '.join(prep)} FROM gr), "
            f"t AS (SELECT hashed_fc, gl_product_group, year, month, week, week_date, {', '.join(feats)} FROM gp WINDOW w AS ({WIN})) "
            f"SELECT hashed_fc, gl_product_group, year, month, week, week_date, {', '.join(names)} FROM t WHERE week IS NOT NULL")
    return with_ctes(body)
