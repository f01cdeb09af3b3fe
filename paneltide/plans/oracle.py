"""Independent DuckDB SQL for every registered query (the correctness gate).

Written directly from the reference's semantics over the driver tables;
it shares no code path with the Spark plans except the fixed country
dimension and the run parameters.
"""
from __future__ import annotations

import re

from paneltide.functions import constants as K
from paneltide.params import TEST_PARAMS as P
from paneltide.sources.dimension import dimension_values_sql

DIM = dimension_values_sql()
LOAD = f"DATE '{P.load_date.isoformat()}'"
RELOAD = f"DATE '{P.reload_date.isoformat()}'"
DETECTED = f"TIMESTAMP '{P.detected_at.isoformat(sep=' ')}'"
PROCESSED = f"TIMESTAMP '{P.processed_at.isoformat(sep=' ')}'"
SCOPE = ", ".join(f"'{c}'" for c in P.countries)
TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"

BASE_CTES = f"""
dim AS {DIM},
order_facts AS (
  SELECT n.n_nationkey AS nation_key, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         o.o_orderpriority AS priority,
         SUM(CAST(round(o.o_totalprice * 100) AS BIGINT)) AS price_sum,
         COUNT(*) AS n_orders,
         COUNT(CASE WHEN o.o_orderstatus = 'F' THEN 1 END) AS n_final
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2, 3),
ofc AS (
  SELECT d.country_code, d.country_name, f.* FROM order_facts f JOIN dim d ON f.nation_key = d.dim_index),
nation_year AS (
  SELECT country_code, country_name, year, SUM(price_sum) AS price_sum,
         SUM(n_orders) AS n_orders, SUM(n_final) AS n_final
  FROM ofc GROUP BY 1, 2, 3),
line_facts AS (
  SELECT d.country_code, d.country_name, CAST(year(l.l_shipdate) AS INTEGER) AS year,
         SUM(CAST(round(l.l_quantity * 100) AS BIGINT)) AS qty_sum,
         SUM(CAST(round(l.l_extendedprice * 100) AS BIGINT)) AS price_sum,
         SUM(CAST(round(l.l_discount * 100) AS BIGINT)) AS disc_sum,
         COUNT(*) AS n_lines
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
       JOIN nation n ON s.s_nationkey = n.n_nationkey
       JOIN dim d ON n.n_nationkey = d.dim_index
  GROUP BY 1, 2, 3),
raw0 AS (
  SELECT n_orders AS n, 7 AS missing, 'gdp_annual' AS dataset, country_code, country_name, year, 'CP_MEUR' AS unit,
         'B1GQ' AS indicator, CAST(NULL AS VARCHAR) AS age_group, CAST(NULL AS VARCHAR) AS sex,
         CAST(price_sum AS DOUBLE) / CAST(100 AS DOUBLE) / CAST(1000 AS DOUBLE) AS value, {LOAD} AS loaded_at
  FROM nation_year
  UNION ALL
  SELECT n_orders, 5, 'unemployment_annual', country_code, country_name, year, 'PC_ACT', NULL, 'Y15-74', 'T',
         CAST(100 AS DOUBLE) * n_final / n_orders, {LOAD}
  FROM nation_year
  UNION ALL
  SELECT n_orders, 5, 'unemployment_annual', country_code, country_name, year, 'PC_ACT', NULL, priority, 'T',
         CAST(100 AS DOUBLE) * n_final / n_orders, {LOAD}
  FROM ofc
  UNION ALL
  SELECT n_lines, 6, 'energy_intensity', country_code, country_name, year, 'KGOE_TEUR', NULL, NULL, NULL,
         CAST(1000 AS DOUBLE) * (CAST(qty_sum AS DOUBLE) / 100) / (CAST(price_sum AS DOUBLE) / 100), {LOAD}
  FROM line_facts
  UNION ALL
  SELECT n_lines, 4, 'inflation_annual', country_code, country_name, year, 'RCH_A_AVG', NULL, NULL, NULL,
         CAST(100 AS DOUBLE) * (CAST(disc_sum AS DOUBLE) / 100) / n_lines, {LOAD}
  FROM line_facts),
raw1 AS (
  SELECT * EXCLUDE (n, missing) REPLACE (CASE WHEN n % missing <> 0 THEN value END AS value) FROM raw0),
raw2 AS (
  SELECT * FROM raw1
  UNION ALL
  SELECT dataset, country_code, country_name, year, unit, indicator, age_group, sex,
         value * CAST({P.reload_factor} AS DOUBLE), {RELOAD} FROM raw1),
sliced AS (
  SELECT * FROM raw1
  WHERE dataset <> 'unemployment_annual' OR (age_group = 'Y15-74' AND sex = 'T')),
staged_all AS (
  SELECT dataset, {TRIM.format('country_code')} AS country_code,
         {TRIM.format('country_name')} AS country_name,
         CAST(year AS INTEGER) AS reference_year, make_date(CAST(year AS INTEGER), 1, 1) AS reference_date,
         CAST(value AS DOUBLE) AS value, unit, indicator, age_group, sex, loaded_at
  FROM raw2
  WHERE value IS NOT NULL AND year IS NOT NULL AND country_code IS NOT NULL
    AND CAST(year AS INTEGER) BETWEEN {P.year_min} AND {P.year_max}
    AND (dataset <> 'unemployment_annual' OR (age_group = 'Y15-74' AND sex = 'T'))),
staged AS (
  SELECT * FROM staged_all
  QUALIFY row_number() OVER (PARTITION BY dataset, country_code, reference_year
                             ORDER BY loaded_at DESC NULLS LAST, value DESC NULLS LAST,
                                      unit ASC NULLS LAST) = 1),
wide AS (
  SELECT g.country_code, g.country_name, g.reference_year, g.reference_date,
         g.value AS gdp_meur, round(g.value / 1000, 3) AS gdp_beur,
         u.value AS unemployment_rate, e.value AS energy_intensity, i.value AS inflation_rate
  FROM staged g
  LEFT JOIN staged u ON u.dataset = 'unemployment_annual' AND u.country_code = g.country_code
                     AND u.reference_year = g.reference_year
  LEFT JOIN staged e ON e.dataset = 'energy_intensity' AND e.country_code = g.country_code
                     AND e.reference_year = g.reference_year
  LEFT JOIN staged i ON i.dataset = 'inflation_annual' AND i.country_code = g.country_code
                     AND i.reference_year = g.reference_year
  WHERE g.dataset = 'gdp_annual'),
-- previous available year of a country: a self-join on its year numbers
numbered AS (SELECT *, dense_rank() OVER (PARTITION BY country_code ORDER BY reference_year) AS nr FROM wide),
paired AS (
  SELECT now, earlier FROM numbered now
  LEFT JOIN numbered earlier ON earlier.country_code = now.country_code AND earlier.nr = now.nr - 1),
deltas AS (
  SELECT now.country_code, now.country_name, now.reference_year, now.reference_date, now.gdp_meur, now.gdp_beur,
         round(now.gdp_meur - earlier.gdp_meur, 2) AS gdp_yoy_change_meur,
         round(CASE WHEN earlier.gdp_meur <> 0
                    THEN (now.gdp_meur - earlier.gdp_meur) / earlier.gdp_meur * 100 END, 2) AS gdp_yoy_growth_pct,
         now.unemployment_rate, round(now.unemployment_rate - earlier.unemployment_rate, 2) AS unem_yoy_change,
         now.energy_intensity, round(now.energy_intensity - earlier.energy_intensity, 3) AS energy_yoy_change,
         round(CASE WHEN earlier.energy_intensity <> 0
                    THEN (earlier.energy_intensity - now.energy_intensity) / earlier.energy_intensity * 100 END, 2)
           AS energy_yoy_improvement_pct,
         now.inflation_rate, round(now.inflation_rate - earlier.inflation_rate, 2) AS inflation_yoy_change
  FROM paired),
-- scores: one long row per country, year and component, scaled by its year's grouped extremes
component AS (
  SELECT country_code, reference_year, 'g' AS part, gdp_yoy_growth_pct AS x, FALSE AS inverted FROM deltas
  UNION ALL SELECT country_code, reference_year, 'u', unemployment_rate, TRUE FROM deltas
  UNION ALL SELECT country_code, reference_year, 'e', energy_intensity, TRUE FROM deltas),
extremes AS (SELECT reference_year, part, min(x) AS low, max(x) AS high FROM component GROUP BY ALL),
points AS (
  SELECT country_code, reference_year, part,
         CASE WHEN x IS NULL OR high = low THEN 50.0
              WHEN inverted THEN round(100 * (1 - (x - low) / (high - low)), 1)
              ELSE round(100 * ((x - low) / (high - low)), 1) END AS score
  FROM component JOIN extremes USING (reference_year, part) WHERE reference_year >= {P.score_year_min}),
composite AS (
  SELECT d.country_code, d.country_name, d.reference_year, d.reference_date, g.score AS gdp_score,
         u.score AS unemployment_score, e.score AS energy_score,
         round((g.score + u.score + e.score) / 3, 1) AS composite_score
  FROM deltas d JOIN points g ON g.part = 'g' AND g.country_code = d.country_code AND g.reference_year = d.reference_year
       JOIN points u ON u.part = 'u' AND u.country_code = d.country_code AND u.reference_year = d.reference_year
       JOIN points e ON e.part = 'e' AND e.country_code = d.country_code AND e.reference_year = d.reference_year),
newest AS (SELECT country_code, arg_max(w, reference_year) AS w FROM wide w GROUP BY country_code),
mart_latest AS (
  SELECT n.country_code, n.w.country_name AS country_name, n.w.reference_year AS latest_year,
         round(n.w.gdp_beur, 2) AS gdp_beur, round(n.w.unemployment_rate, 2) AS unemployment_rate,
         round(n.w.energy_intensity, 3) AS energy_intensity, round(n.w.inflation_rate, 2) AS inflation_rate,
         round(d.gdp_yoy_growth_pct, 2) AS gdp_yoy_growth_pct, round(d.unem_yoy_change, 2) AS unem_yoy_change,
         round(c.composite_score, 1) AS composite_score, round(c.gdp_score, 1) AS gdp_score,
         round(c.unemployment_score, 1) AS unemployment_score, round(c.energy_score, 1) AS energy_score
  FROM newest n JOIN deltas d ON d.country_code = n.country_code AND d.reference_year = n.w.reference_year
       LEFT JOIN composite c ON c.country_code = n.country_code AND c.reference_year = n.w.reference_year),
mart_gdp AS (
  SELECT country_code, country_name, reference_year, reference_date,
         round(gdp_beur, 3) AS gdp_beur, round(gdp_meur, 0) AS gdp_meur,
         gdp_yoy_change_meur, gdp_yoy_growth_pct
  FROM deltas WHERE gdp_meur IS NOT NULL),
mart_unem AS (
  SELECT country_code, country_name, reference_year, reference_date,
         round(unemployment_rate, 2) AS unemployment_rate, round(unem_yoy_change, 2) AS unem_yoy_change
  FROM deltas WHERE unemployment_rate IS NOT NULL),
mart_energy AS (
  SELECT country_code, country_name, reference_year, reference_date,
         round(energy_intensity, 3) AS energy_intensity, round(energy_yoy_change, 3) AS energy_yoy_change,
         round(energy_yoy_improvement_pct, 2) AS energy_yoy_improvement_pct
  FROM deltas WHERE energy_intensity IS NOT NULL),
series AS (
  SELECT dataset, country_code, avg(value ORDER BY year) AS s_mean, stddev_samp(value ORDER BY year) AS s_std
  FROM sliced GROUP BY ALL),
series_stats AS (SELECT sliced.*, s_mean, s_std FROM sliced JOIN series USING (dataset, country_code)),
enriched AS (
  SELECT * EXCLUDE (s_mean, s_std), value - lag(value) OVER w AS yoy_change,
         round(CASE WHEN lag(value) OVER w <> 0
                    THEN (value - lag(value) OVER w) / lag(value) OVER w * 100 END, 2) AS yoy_growth_pct,
         round(CASE WHEN s_std <> 0 THEN (value - s_mean) / s_std ELSE 0 END, 3) AS z_score,
         make_date(year, 1, 1) AS reference_date
  FROM series_stats
  WINDOW w AS (PARTITION BY dataset, country_code ORDER BY year)),
processed AS (SELECT * FROM enriched WHERE value IS NOT NULL),
panel_scored AS (
  SELECT dataset, country_code, year, value, s_mean AS mean, s_std AS std_dev,
         (value - s_mean) / NULLIF(s_std, 0) AS z_score
  FROM series_stats),
panel_alerts AS (
  SELECT dataset, country_code, year, value, z_score, mean, std_dev,
         CASE WHEN abs(COALESCE(z_score, 0)) >= 4 THEN 'HIGH'
              WHEN abs(COALESCE(z_score, 0)) >= 3 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
         CAST({DETECTED} AS TIMESTAMP) AS detected_at
  FROM panel_scored WHERE abs(z_score) > {P.z_threshold}
  QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY abs(z_score) DESC, country_code, year)
          <= {P.top_k}),
ev_stats AS (
  SELECT event_type, avg(value) AS mean, stddev_samp(value) AS std_dev FROM events GROUP BY 1),
event_alerts AS (
  SELECT e.event_type AS dataset, d.country_code, CAST(year(e.ts) AS INTEGER) AS year, e.value,
         (e.value - s.mean) / NULLIF(s.std_dev, 0) AS z_score, s.mean, s.std_dev,
         CASE WHEN abs((e.value - s.mean) / NULLIF(s.std_dev, 0)) >= 4 THEN 'HIGH'
              WHEN abs((e.value - s.mean) / NULLIF(s.std_dev, 0)) >= 3 THEN 'MEDIUM'
              ELSE 'LOW' END AS severity,
         CAST(e.ts AS TIMESTAMP) AS detected_at
  FROM events e JOIN ev_stats s ON e.event_type = s.event_type
       JOIN dim d ON d.dim_index = e.user_id % 25
  WHERE abs((e.value - s.mean) / NULLIF(s.std_dev, 0)) > {P.z_threshold}),
api_gdp AS (
  SELECT country_code, country_name, reference_year, reference_date, gdp_beur, gdp_yoy_growth_pct,
         CASE WHEN country_code = 'EL' THEN 'GR' ELSE country_code END AS iso2
  FROM mart_gdp WHERE reference_year BETWEEN {P.api_start} AND {P.api_end}
   AND country_code IN ({SCOPE})),
api_unem AS (
  SELECT country_code, country_name, reference_year, reference_date, unemployment_rate,
         unem_yoy_change AS unemp_yoy_change,
         CASE WHEN country_code = 'EL' THEN 'GR' ELSE country_code END AS iso2
  FROM mart_unem WHERE reference_year BETWEEN {P.api_start} AND {P.api_end}
   AND country_code IN ({SCOPE})),
api_energy AS (
  SELECT country_code, country_name, reference_year, reference_date, energy_intensity,
         energy_yoy_improvement_pct AS energy_yoy_improvement,
         CASE WHEN country_code = 'EL' THEN 'GR' ELSE country_code END AS iso2
  FROM mart_energy WHERE reference_year BETWEEN {P.api_start} AND {P.api_end}
   AND country_code IN ({SCOPE})),
api_comp AS (
  SELECT country_code, country_name, reference_year, reference_date, gdp_score,
         unemployment_score, energy_score, composite_score,
         CASE WHEN country_code = 'EL' THEN 'GR' ELSE country_code END AS iso2
  FROM composite WHERE reference_year BETWEEN {P.api_start} AND {P.api_end}
   AND country_code IN ({SCOPE})),
sel_latest AS (SELECT * FROM mart_latest WHERE country_code IN ({SCOPE}))
"""


def half_up_rounding(sql: str) -> str:
    """Rewrite every ``round(x, n)`` as rounding of the decimal value of x.

    Spark rounds a double half-up on its shortest decimal representation
    (17.365 -> 17.37, 40.62499999999999 -> 40.62); DuckDB rounds the binary
    value. Going through DuckDB's shortest-representation text and DECIMAL
    makes it round the same decimal value Spark does.
    """
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 0, j + 6, -1
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = k
            k += 1
        out.append(sql[i:j])
        if comma < 0:  # round(x): nearest integer, left to the engine
            out.append(f"round({half_up_rounding(sql[j + 6:k])})")
            i = k + 1
            continue
        arg, digits = sql[j + 6:comma], sql[comma + 1:k]
        out.append(f"CAST(round(CAST(CAST(({half_up_rounding(arg)}) AS VARCHAR) AS DECIMAL(38,17)),"
                   f" {digits.strip()}) AS DOUBLE)")
        i = k + 1


def q(body: str) -> str:
    b = body.strip()
    if b.upper().startswith("WITH "):
        return half_up_rounding(f"WITH {BASE_CTES.strip()},\n{b[5:]}")
    return half_up_rounding(f"WITH {BASE_CTES.strip()}\n{b}")


def _ranking(src: str, metrics: list[str]) -> str:
    parts = []
    for m in metrics:
        parts.append(
            f"SELECT '{m}' AS metric, CAST(row_number() OVER (ORDER BY {m} ASC, country_code) AS INTEGER)"
            f" AS position, country_code, country_name, CAST({m} AS DOUBLE) AS value "
            f"FROM {src} WHERE reference_year = (SELECT max(reference_year) FROM {src}) "
            f"AND {m} IS NOT NULL")
    return " UNION ALL ".join(parts)


def _heatmap(src: str, col: str) -> str:
    years = ", ".join(str(y) for y in range(P.api_start, P.api_end + 1))
    return (f"PIVOT (SELECT country_name, reference_year, {col} FROM {src}) "
            f"ON reference_year IN ({years}) USING avg({col}) GROUP BY country_name")


def _best(name: str, value: str, src: str, largest: bool = True) -> str:
    order = "DESC" if largest else "ASC"
    return (f"(SELECT {name} FROM {src} WHERE {value} IS NOT NULL "
            f"ORDER BY {value} {order}, country_code LIMIT 1)")


PROC_COLS = {
    K.GDP: "country_code, country_name, year, unit, indicator, value AS gdp_meur, loaded_at, "
           "round(value / 1000, 3) AS gdp_beur",
    K.UNEMPLOYMENT: "country_code, country_name, year, unit, age_group, sex, "
                    "value AS unemployment_rate, loaded_at",
    K.ENERGY: "country_code, country_name, year, unit, value AS energy_intensity, loaded_at",
    K.INFLATION: "country_code, country_name, year, unit, value AS inflation_rate, loaded_at",
}

STG_COLS = {
    K.GDP: "country_code, country_name, reference_year, reference_date, value AS gdp_meur, "
           "round(value / 1000, 3) AS gdp_beur, unit, loaded_at",
    K.UNEMPLOYMENT: "country_code, country_name, reference_year, reference_date, "
                    "value AS unemployment_rate, unit, age_group, sex, loaded_at",
    K.ENERGY: "country_code, country_name, reference_year, reference_date, "
              "value AS energy_intensity, unit, loaded_at",
    K.INFLATION: "country_code, country_name, reference_year, reference_date, "
                 "value AS inflation_rate, unit, loaded_at",
}


def _wide_cells(ds: str = K.GDP) -> str:
    """The landed cells of a dataset that survive coercion (see landing.build_wide)."""
    return f"""
  SELECT 'CP_MEUR' AS unit, 'B1GQ' AS na_item,
         CASE WHEN d.dim_index % 2 = 0 THEN ' ' || r.country_code || ' ' ELSE r.country_code END
           AS "geo\\TIME_PERIOD",
         r.year, r.value, {LOAD} AS loaded_at
  FROM raw1 r JOIN dim d ON r.country_code = d.country_code
  WHERE r.dataset = '{ds}' AND r.value IS NOT NULL AND (r.year + d.dim_index) % 5 <> 0
    AND (r.year + d.dim_index) % 7 <> 0
  UNION ALL
  SELECT 'CP_MEUR', 'B1GQ', 'EU27_2020', r.year,
         CAST(CAST(SUM(CAST(r.value AS DECIMAL(38,6))) AS VARCHAR) AS DOUBLE), {LOAD}
  FROM raw1 r JOIN dim d ON r.country_code = d.country_code
  WHERE r.dataset = '{ds}' GROUP BY r.year HAVING SUM(r.value) IS NOT NULL"""


ORACLE: dict[str, str] = {
    "land_unpivot": q(_wide_cells()),
    "land_geo_filter": q(f"""
  SELECT d.country_code, d.country_name, w.year, w.unit, 'B1GQ' AS indicator, w.value, w.loaded_at
  FROM ({_wide_cells()}) w JOIN dim d ON {TRIM.format('w."geo\\TIME_PERIOD"')} = d.country_code"""),
    "stg_gdp": q(f"SELECT {STG_COLS[K.GDP]} FROM staged WHERE dataset = 'gdp_annual'"),
    "stg_unemployment": q(f"SELECT {STG_COLS[K.UNEMPLOYMENT]} FROM staged "
                          "WHERE dataset = 'unemployment_annual'"),
    "stg_energy": q(f"SELECT {STG_COLS[K.ENERGY]} FROM staged WHERE dataset = 'energy_intensity'"),
    "stg_inflation": q(f"SELECT {STG_COLS[K.INFLATION]} FROM staged "
                       "WHERE dataset = 'inflation_annual'"),
    "stg_inflation_raw": q(f"SELECT {STG_COLS[K.INFLATION]} FROM staged_all "
                           "WHERE dataset = 'inflation_annual'"),
    "dedupe_latest": q("SELECT * FROM staged"),
    "panel_union": q("SELECT * FROM raw1"),
    "process_panel": q("SELECT * FROM processed"),
    "combined_indicators": q("""
  SELECT g.country_code, g.year, g.country_name, g.reference_date,
         round(g.value / 1000, 3) AS gdp_beur, g.yoy_growth_pct AS gdp_yoy_pct,
         u.value AS unemployment_rate, u.yoy_growth_pct AS unem_yoy_pct,
         e.value AS energy_intensity, e.yoy_growth_pct AS energy_yoy_pct,
         i.value AS inflation_rate
  FROM processed g
  LEFT JOIN processed u ON u.dataset = 'unemployment_annual' AND u.country_code = g.country_code
                        AND u.year = g.year
  LEFT JOIN processed e ON e.dataset = 'energy_intensity' AND e.country_code = g.country_code
                        AND e.year = g.year
  LEFT JOIN processed i ON i.dataset = 'inflation_annual' AND i.country_code = g.country_code
                        AND i.year = g.year
  WHERE g.dataset = 'gdp_annual'"""),
    "int_country_indicators": q("SELECT * FROM wide"),
    "int_yoy_deltas": q("SELECT * FROM deltas"),
    "composite_index": q("SELECT * FROM composite"),
    "mart_gdp_trends": q("SELECT * FROM mart_gdp"),
    "mart_unemployment": q("SELECT * FROM mart_unem"),
    "mart_energy": q("SELECT * FROM mart_energy"),
    "mart_country_latest": q("SELECT * FROM mart_latest"),
    "anomaly_alerts": q("SELECT * FROM panel_alerts"),
    "event_alerts": q("SELECT * FROM event_alerts"),
    "alert_messages_json": q("""
  SELECT dataset, country_code, year, COALESCE(value, 0.0) AS value,
         COALESCE(z_score, 0.0) AS z_score, severity, detected_at FROM panel_alerts"""),
    "ingestion_event_json": q(f"""
  SELECT dataset, COUNT(*) AS record_count,
         string_agg(DISTINCT country_code, ',' ORDER BY country_code) AS countries,
         min(year) AS year_start, max(year) AS year_end,
         '{P.load_date.isoformat()}T00:00:00' AS timestamp, 'completed' AS status
  FROM raw1 GROUP BY dataset
  UNION ALL
  SELECT '{K.FULL_PIPELINE_EVENT}', COUNT(*),
         string_agg(DISTINCT country_code, ',' ORDER BY country_code), min(year), max(year),
         '{P.load_date.isoformat()}T00:00:00', 'completed'
  FROM raw1"""),
    "api_gdp_trends": q("SELECT * FROM api_gdp"),
    "api_unemployment": q("SELECT * FROM api_unem"),
    "api_energy": q("SELECT * FROM api_energy"),
    "api_composite": q("SELECT * FROM api_comp"),
    "api_country_latest": q(f"""
  SELECT country_code, country_name, latest_year, gdp_beur, unemployment_rate, energy_intensity,
         inflation_rate, gdp_yoy_growth_pct, unem_yoy_change AS unemp_yoy_change, composite_score,
         gdp_score, unemployment_score, energy_score,
         CASE WHEN country_code = 'EL' THEN 'GR' ELSE country_code END AS iso2
  FROM mart_latest WHERE country_code IN ({SCOPE})"""),
    "api_recent_alerts": q(f"""
  SELECT dataset, country_code, year, z_score, upper(COALESCE(severity, 'LOW')) AS severity,
         detected_at
  FROM (SELECT * FROM panel_alerts UNION ALL SELECT * FROM event_alerts)
  ORDER BY detected_at DESC NULLS LAST, dataset, country_code, year, z_score DESC NULLS LAST
  LIMIT {P.recent_alerts}"""),
    "home_kpis": q(f"""
  SELECT COALESCE((CAST(SUM(CAST(round(gdp_yoy_growth_pct * 100) AS BIGINT)) AS DOUBLE) / (CAST(100 AS DOUBLE) * COUNT(gdp_yoy_growth_pct))), 0.0) AS avg_gdp_growth,
         COALESCE((CAST(SUM(CAST(round(unemployment_rate * 100) AS BIGINT)) AS DOUBLE) / (CAST(100 AS DOUBLE) * COUNT(unemployment_rate))), 0.0) AS avg_unemployment,
         COALESCE((CAST(SUM(CAST(round(energy_intensity * 1000) AS BIGINT)) AS DOUBLE) / (CAST(1000 AS DOUBLE) * COUNT(energy_intensity))), 0.0) AS avg_energy,
         COALESCE((CAST(SUM(CAST(round(composite_score * 10) AS BIGINT)) AS DOUBLE) / (CAST(10 AS DOUBLE) * COUNT(composite_score))), 0.0) AS avg_composite,
         COALESCE({_best('country_name', 'composite_score', 'sel_latest')}, '') AS top_country,
         COALESCE({_best('composite_score', 'composite_score', 'sel_latest')}, 0.0) AS top_score
  FROM sel_latest"""),
    "home_map": q(f"""
  SELECT c.country_code, c.country_name, c.reference_year, c.composite_score,
         CASE WHEN c.country_code = 'EL' THEN 'GR' ELSE c.country_code END AS iso2, d.iso3
  FROM composite c LEFT JOIN dim d ON c.country_code = d.country_code
  WHERE c.reference_year BETWEEN {P.api_start} AND {P.api_end} AND c.country_code IN ({SCOPE})
    AND c.reference_year = (SELECT max(reference_year) FROM composite
                            WHERE reference_year BETWEEN {P.api_start} AND {P.api_end})"""),
    "home_ranking": q("""
  SELECT CAST(row_number() OVER (ORDER BY composite_score DESC, country_code) AS INTEGER) AS rank,
         country_code, country_name, composite_score, gdp_yoy_growth_pct, unemployment_rate,
         CAST(trunc(composite_score / (CASE WHEN max(composite_score) OVER () IS NULL
                                              OR max(composite_score) OVER () = 0 THEN 100.0
                                            ELSE max(composite_score) OVER () END) * 100)
              AS INTEGER) AS bar_pct
  FROM sel_latest WHERE composite_score IS NOT NULL"""),
    "gdp_kpis": q(f"""
  WITH l AS (SELECT * FROM api_gdp WHERE reference_year = (SELECT max(reference_year) FROM api_gdp))
  SELECT max(reference_year) AS latest_year, (CAST(SUM(CAST(round(gdp_yoy_growth_pct * 100) AS BIGINT)) AS DOUBLE) / (CAST(100 AS DOUBLE) * COUNT(gdp_yoy_growth_pct))) AS avg_growth,
         {_best('country_name', 'gdp_beur', 'l')} AS largest_country,
         {_best('gdp_beur', 'gdp_beur', 'l')} AS largest_gdp_beur,
         {_best('country_name', 'gdp_yoy_growth_pct', 'l')} AS fastest_country,
         {_best('gdp_yoy_growth_pct', 'gdp_yoy_growth_pct', 'l')} AS fastest_growth_pct
  FROM l"""),
    "rank_gdp": q(_ranking("api_gdp", ["gdp_beur", "gdp_yoy_growth_pct"])),
    "heatmap_gdp": q(_heatmap("api_gdp", "gdp_yoy_growth_pct")),
    "unemployment_kpis": q(f"""
  WITH l AS (SELECT * FROM api_unem WHERE reference_year = (SELECT max(reference_year) FROM api_unem))
  SELECT max(reference_year) AS latest_year, (CAST(SUM(CAST(round(unemployment_rate * 100) AS BIGINT)) AS DOUBLE) / (CAST(100 AS DOUBLE) * COUNT(unemployment_rate))) AS avg_rate,
         {_best('country_name', 'unemployment_rate', 'l', False)} AS lowest_country,
         {_best('unemployment_rate', 'unemployment_rate', 'l', False)} AS lowest_rate,
         {_best('country_name', 'unemployment_rate', 'l')} AS highest_country,
         {_best('unemployment_rate', 'unemployment_rate', 'l')} AS highest_rate,
         (CAST(SUM(CAST(round(unemp_yoy_change * 100) AS BIGINT)) AS DOUBLE) / (CAST(100 AS DOUBLE) * COUNT(unemp_yoy_change))) AS avg_yoy_change,
         (SELECT (CAST(SUM(CAST(round(unemployment_rate * 100) AS BIGINT)) AS DOUBLE) / (CAST(100 AS DOUBLE) * COUNT(unemployment_rate))) FROM api_unem) AS overall_mean
  FROM l"""),
    "heatmap_unemployment": q(_heatmap("api_unem", "unemployment_rate")),
    "rank_unemployment": q(_ranking("api_unem", ["unemployment_rate", "unemp_yoy_change"])),
    "energy_kpis": q(f"""
  WITH l AS (SELECT * FROM api_energy
             WHERE reference_year = (SELECT max(reference_year) FROM api_energy)),
  by_year AS (SELECT reference_year, (CAST(SUM(CAST(round(energy_intensity * 1000) AS BIGINT)) AS DOUBLE) / (CAST(1000 AS DOUBLE) * COUNT(energy_intensity))) AS a FROM api_energy GROUP BY 1),
  ends AS (SELECT min(reference_year) AS y0, max(reference_year) AS y1,
                  (SELECT a FROM by_year ORDER BY reference_year ASC LIMIT 1) AS a0,
                  (SELECT a FROM by_year ORDER BY reference_year DESC LIMIT 1) AS a1
           FROM by_year)
  SELECT (SELECT max(reference_year) FROM l) AS latest_year,
         (SELECT (CAST(SUM(CAST(round(energy_intensity * 1000) AS BIGINT)) AS DOUBLE) / (CAST(1000 AS DOUBLE) * COUNT(energy_intensity))) FROM l) AS avg_intensity,
         {_best('country_name', 'energy_intensity', 'l', False)} AS most_efficient,
         {_best('energy_intensity', 'energy_intensity', 'l', False)} AS most_efficient_value,
         {_best('country_name', 'energy_intensity', 'l')} AS least_efficient,
         {_best('energy_intensity', 'energy_intensity', 'l')} AS least_efficient_value,
         y0 AS first_year,
         CASE WHEN y0 < y1 AND a0 IS NOT NULL AND a0 <> 0 THEN (a0 - a1) / a0 * 100
              ELSE 0.0 END AS improvement_pct
  FROM ends"""),
    "energy_gdp_scatter": q("""
  SELECT e.country_code, e.country_name, e.energy_intensity, e.reference_year,
         COALESCE(g.gdp_beur, 0.0) AS gdp_beur
  FROM api_energy e JOIN api_gdp g ON e.country_code = g.country_code
                                   AND e.reference_year = g.reference_year
  WHERE e.reference_year = (SELECT max(reference_year) FROM api_energy)"""),
    "heatmap_energy": q(_heatmap("api_energy", "energy_intensity")),
    "rank_energy": q(_ranking("api_energy", ["energy_intensity", "energy_yoy_improvement"])),
    "composite_kpis": q(f"""
  WITH l AS (SELECT * FROM api_comp
             WHERE reference_year = (SELECT max(reference_year) FROM api_comp)
             QUALIFY row_number() OVER (PARTITION BY country_name
                                        ORDER BY composite_score DESC NULLS LAST, country_code) = 1)
  SELECT max(reference_year) AS latest_year, (CAST(SUM(CAST(round(composite_score * 10) AS BIGINT)) AS DOUBLE) / (CAST(10 AS DOUBLE) * COUNT(composite_score))) AS avg_score,
         {_best('country_name', 'composite_score', 'l')} AS top_country,
         {_best('composite_score', 'composite_score', 'l')} AS top_score,
         {_best('country_name', 'composite_score', 'l', False)} AS bottom_country,
         {_best('composite_score', 'composite_score', 'l', False)} AS bottom_score,
         median(composite_score) AS median_score
  FROM l"""),
    "composite_ranking": q(f"""
  WITH l AS (SELECT * FROM api_comp
             WHERE reference_year = (SELECT max(reference_year) FROM api_comp)
             QUALIFY row_number() OVER (PARTITION BY country_name
                                        ORDER BY composite_score DESC NULLS LAST, country_code) = 1)
  SELECT CAST(row_number() OVER (ORDER BY composite_score DESC, country_code) AS INTEGER) AS rank,
         country_code, country_name, composite_score, gdp_score, unemployment_score, energy_score,
         CASE WHEN composite_score >= {K.BAND_HIGH} THEN 'top'
              WHEN composite_score >= {K.BAND_MID} THEN 'middle' ELSE 'bottom' END AS band
  FROM l WHERE composite_score IS NOT NULL"""),
    "composite_tiers": q(f"""
  WITH l AS (SELECT * FROM api_comp
             WHERE reference_year = (SELECT max(reference_year) FROM api_comp)),
  u AS (UNPIVOT (SELECT country_code, country_name, reference_year, composite_score, gdp_score,
                        unemployment_score, energy_score FROM l)
        ON composite_score, gdp_score, unemployment_score, energy_score
        INTO NAME component VALUE score)
  SELECT country_code, country_name, reference_year, component, score,
         CASE WHEN score > {K.TIER_HIGH} THEN 'Strong' WHEN score > {K.TIER_MID} THEN 'Moderate'
              ELSE 'Weak' END AS tier
  FROM u"""),
    "composite_components": q("""
  SELECT country_code, reference_year, composite_score, component, contribution
  FROM (UNPIVOT (SELECT country_code, reference_year, composite_score, gdp_score / 3 AS gdp_score,
                        unemployment_score / 3 AS unemployment_score,
                        energy_score / 3 AS energy_score FROM api_comp)
        ON gdp_score, unemployment_score, energy_score INTO NAME component VALUE contribution)"""),
    "dq_report": q("""
  SELECT 'gdp_annual' AS table_name, 'country_code' AS column_name, 'not_null' AS check_name,
         (SELECT COUNT(*) FROM raw1 WHERE dataset = 'gdp_annual' AND country_code IS NULL) AS failures
  UNION ALL SELECT 'gdp_annual', 'year', 'not_null',
         (SELECT COUNT(*) FROM raw1 WHERE dataset = 'gdp_annual' AND year IS NULL)
  UNION ALL SELECT 'unemployment_annual', 'country_code', 'not_null',
         (SELECT COUNT(*) FROM raw1 WHERE dataset = 'unemployment_annual' AND country_code IS NULL)
  UNION ALL SELECT 'unemployment_annual', 'year', 'not_null',
         (SELECT COUNT(*) FROM raw1 WHERE dataset = 'unemployment_annual' AND year IS NULL)
  UNION ALL SELECT 'energy_intensity', 'country_code', 'not_null',
         (SELECT COUNT(*) FROM raw1 WHERE dataset = 'energy_intensity' AND country_code IS NULL)
  UNION ALL SELECT 'energy_intensity', 'year', 'not_null',
         (SELECT COUNT(*) FROM raw1 WHERE dataset = 'energy_intensity' AND year IS NULL)
  UNION ALL SELECT 'inflation_annual', 'country_code', 'not_null',
         (SELECT COUNT(*) FROM raw1 WHERE dataset = 'inflation_annual' AND country_code IS NULL)
  UNION ALL SELECT 'inflation_annual', 'year', 'not_null',
         (SELECT COUNT(*) FROM raw1 WHERE dataset = 'inflation_annual' AND year IS NULL)
  UNION ALL SELECT 'stg_gdp', 'country_code', 'not_null',
         (SELECT COUNT(*) FROM staged WHERE dataset = 'gdp_annual' AND country_code IS NULL)
  UNION ALL SELECT 'stg_gdp', 'reference_year', 'not_null',
         (SELECT COUNT(*) FROM staged WHERE dataset = 'gdp_annual' AND reference_year IS NULL)
  UNION ALL SELECT 'stg_gdp', 'gdp_meur', 'not_null',
         (SELECT COUNT(*) FROM staged WHERE dataset = 'gdp_annual' AND value IS NULL)
  UNION ALL SELECT 'stg_unemployment', 'country_code', 'not_null',
         (SELECT COUNT(*) FROM staged WHERE dataset = 'unemployment_annual' AND country_code IS NULL)
  UNION ALL SELECT 'stg_unemployment', 'reference_year', 'not_null',
         (SELECT COUNT(*) FROM staged WHERE dataset = 'unemployment_annual' AND reference_year IS NULL)
  UNION ALL SELECT 'stg_unemployment', 'unemployment_rate', 'not_null',
         (SELECT COUNT(*) FROM staged WHERE dataset = 'unemployment_annual' AND value IS NULL)
  UNION ALL SELECT 'stg_unemployment', 'unemployment_rate', 'accepted_range',
         (SELECT COUNT(*) FROM staged WHERE dataset = 'unemployment_annual'
                                          AND (value < 0 OR value > 100))
  UNION ALL SELECT 'stg_energy', 'country_code', 'not_null',
         (SELECT COUNT(*) FROM staged WHERE dataset = 'energy_intensity' AND country_code IS NULL)
  UNION ALL SELECT 'stg_energy', 'reference_year', 'not_null',
         (SELECT COUNT(*) FROM staged WHERE dataset = 'energy_intensity' AND reference_year IS NULL)
  UNION ALL SELECT 'stg_inflation', 'country_code', 'not_null',
         (SELECT COUNT(*) FROM staged WHERE dataset = 'inflation_annual' AND country_code IS NULL)
  UNION ALL SELECT 'stg_inflation', 'reference_year', 'not_null',
         (SELECT COUNT(*) FROM staged WHERE dataset = 'inflation_annual' AND reference_year IS NULL)
  UNION ALL SELECT 'stg_gdp', 'country_code', 'relationships',
         (SELECT COUNT(*) FROM staged s WHERE s.dataset = 'gdp_annual' AND s.country_code IS NOT NULL
            AND s.country_code NOT IN (SELECT country_code FROM raw1 WHERE dataset = 'gdp_annual'
                                         AND country_code IS NOT NULL))
  UNION ALL SELECT 'mart_gdp_trends', 'country_code', 'not_null',
         (SELECT COUNT(*) FROM mart_gdp WHERE country_code IS NULL)
  UNION ALL SELECT 'mart_gdp_trends', 'reference_year', 'not_null',
         (SELECT COUNT(*) FROM mart_gdp WHERE reference_year IS NULL)
  UNION ALL SELECT 'mart_gdp_trends', 'gdp_beur', 'not_null',
         (SELECT COUNT(*) FROM mart_gdp WHERE gdp_beur IS NULL)
  UNION ALL SELECT 'mart_unemployment_comparison', 'country_code', 'not_null',
         (SELECT COUNT(*) FROM mart_unem WHERE country_code IS NULL)
  UNION ALL SELECT 'mart_unemployment_comparison', 'reference_year', 'not_null',
         (SELECT COUNT(*) FROM mart_unem WHERE reference_year IS NULL)
  UNION ALL SELECT 'mart_unemployment_comparison', 'unemployment_rate', 'accepted_range',
         (SELECT COUNT(*) FROM mart_unem WHERE unemployment_rate < 0 OR unemployment_rate > 100)
  UNION ALL SELECT 'mart_energy_intensity', 'country_code', 'not_null',
         (SELECT COUNT(*) FROM mart_energy WHERE country_code IS NULL)
  UNION ALL SELECT 'mart_energy_intensity', 'reference_year', 'not_null',
         (SELECT COUNT(*) FROM mart_energy WHERE reference_year IS NULL)
  UNION ALL SELECT 'mart_composite_economic_index', 'composite_score', 'accepted_range',
         (SELECT COUNT(*) FROM composite WHERE composite_score < 0 OR composite_score > 100)
  UNION ALL SELECT 'mart_country_latest', 'country_code', 'not_null',
         (SELECT COUNT(*) FROM mart_latest WHERE country_code IS NULL)
  UNION ALL SELECT 'mart_country_latest', 'country_code', 'unique',
         (SELECT COUNT(*) FROM (SELECT country_code FROM mart_latest WHERE country_code IS NOT NULL
                                GROUP BY 1 HAVING COUNT(*) > 1))"""),
    "stream_window_summary": q("""
  SELECT country_code, dataset, severity, COUNT(*) AS alert_count, avg(z_score) AS avg_z_score,
         max(abs(z_score)) AS max_abs_z,
         time_bucket(INTERVAL '10 days', detected_at, TIMESTAMP '1970-01-01') AS window_start,
         time_bucket(INTERVAL '10 days', detected_at, TIMESTAMP '1970-01-01') + INTERVAL '10 days' AS window_end
  FROM event_alerts GROUP BY ALL"""),
    "stream_alert_records": q(f"""
  SELECT dataset, country_code, year, value, z_score, severity, detected_at,
         CASE WHEN minute(detected_at) % 2 = 0 THEN detected_at + INTERVAL 1 SECOND
              ELSE CAST({PROCESSED} AS TIMESTAMP) END AS processed_at
  FROM event_alerts"""),
    "event_driven_anomalies": q("""
  SELECT r.request, a.* FROM (VALUES {reqs}) r(request)
  JOIN panel_alerts a ON (r.request LIKE '%full_pipeline%' OR r.request = a.dataset)""".replace(
        "{reqs}", ", ".join(f"('{n}')" for n in P.ingestion_events))),
    "sink_overwrite": None,
    "layout_partitioned": q("SELECT * FROM composite WHERE reference_year >= 1998"),
    "snapshot_clustered": q("SELECT * FROM mart_latest"),
    "csv_export": q("SELECT * FROM api_gdp"),
}
ORACLE["sink_overwrite"] = ORACLE["combined_indicators"]
for _ds, _key in ((K.GDP, "process_gdp"), (K.UNEMPLOYMENT, "process_unemployment"),
                  (K.ENERGY, "process_energy"), (K.INFLATION, "process_inflation")):
    ORACLE[_key] = q(f"SELECT {PROC_COLS[_ds]}, yoy_change, yoy_growth_pct, z_score, reference_date "
                     f"FROM processed WHERE dataset = '{_ds}'")

EVENT_DRIVEN = "SELECT a.* FROM (VALUES {reqs}) r(request) " \
    "JOIN panel_alerts a ON (r.request LIKE '%full_pipeline%' OR r.request = a.dataset)".replace(
        "{reqs}", ", ".join(f"('{n}')" for n in P.ingestion_events))
ORACLE |= {
    "event_driven_messages": q(f"""
  SELECT dataset, country_code, year, COALESCE(value, 0.0) AS value, COALESCE(z_score, 0.0) AS z_score,
         severity, detected_at FROM ({EVENT_DRIVEN})"""),
    "alerts_appended": q("SELECT * FROM panel_alerts UNION ALL SELECT * FROM panel_alerts WHERE dataset = 'gdp_annual'"),
    "anomaly_alerts_top3": q(f"""
  SELECT dataset, country_code, year, value, z_score, mean, std_dev,
         CASE WHEN abs(z_score) >= 4 THEN 'HIGH' WHEN abs(z_score) >= 3 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
         CAST({DETECTED} AS TIMESTAMP) AS detected_at
  FROM panel_scored WHERE abs(z_score) > 1.2
  QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY abs(z_score) DESC, country_code, year) <= 3"""),
    "raw_layout": q("""
  SELECT country_code, country_name, year, unit, indicator, value, loaded_at FROM raw1
  WHERE dataset = 'gdp_annual'"""),
    "land_file_slice": q(f"""
  SELECT d.country_code, d.country_name, w.year, 'RCH_A_AVG' AS unit, w.value, w.loaded_at
  FROM ({_wide_cells(K.INFLATION)}) w JOIN dim d ON {TRIM.format('w."geo\\TIME_PERIOD"')} = d.country_code"""),
    "country_indicators_fanout": q("""
  SELECT w.* REPLACE (i.value AS inflation_rate) FROM wide w
  LEFT JOIN staged_all i ON i.dataset = 'inflation_annual' AND i.country_code = w.country_code
                         AND i.reference_year = w.reference_year"""),
}
# the record stream: four batches by time, with copies and late rows; what a batch sees as late
# is at or before the latest time (whole milliseconds) of the earlier batches less 30 seconds
_SENT = """
WITH span AS (SELECT min(epoch_us(detected_at)) AS a, max(epoch_us(detected_at)) AS b FROM event_alerts),
placed AS (
  SELECT e.*, minute(detected_at) % 7 AS kind, epoch_us(detected_at) AS t,
         CASE WHEN t >= a + (b - a) // 4 * 3 THEN 3 WHEN t >= a + (b - a) // 4 * 2 THEN 2
              WHEN t >= a + (b - a) // 4 THEN 1 ELSE 0 END AS n
  FROM event_alerts e, span),
sent AS (
  SELECT * EXCLUDE (kind, n), unnest(CASE WHEN kind = 0 AND n = 0 THEN [2] WHEN kind = 1 AND n < 3 THEN [n, n + 1]
                                          WHEN kind = 2 THEN [n, n] ELSE [n] END) AS nr
  FROM placed),
marks AS (
  SELECT x.nr, (SELECT max(y.t) // 1000 - 30000 FROM sent y WHERE y.nr < x.nr) AS mark
  FROM (SELECT unnest(range(4)) AS nr) x),
judged AS (SELECT s.*, coalesce(s.t <= m.mark * 1000, FALSE) AS late FROM sent s JOIN marks m USING (nr)),
kept AS (
  SELECT dataset, country_code, year, value, z_score, severity, detected_at, min(nr) AS nr
  FROM judged WHERE NOT late GROUP BY ALL)
"""
ORACLE["stream_unique_records"] = q(f"""{_SENT}
  SELECT * EXCLUDE (nr), CAST({PROCESSED} AS TIMESTAMP) AS processed_at FROM kept""")
ORACLE["stream_restart"] = ORACLE["stream_unique_records"]
ORACLE["stream_late_rows"] = q(f"""{_SENT}
  SELECT m.nr::BIGINT AS batch_id, (SELECT count(*) FROM judged j WHERE j.nr = m.nr) AS rows_in,
         (SELECT count(*) FROM judged j WHERE j.nr = m.nr AND late) AS rows_late,
         (SELECT count(*) FROM kept k WHERE k.nr = m.nr) AS rows_kept
  FROM marks m""")
ORACLE["completion_events"] = ORACLE["ingestion_event_json"]
ORACLE["yoy_gap_years"] = q("""
  WITH have AS (SELECT dataset, country_code, year, value FROM sliced WHERE value IS NOT NULL),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY dataset, country_code ORDER BY year) AS nr FROM have)
  SELECT n.dataset, n.country_code, n.year, n.value, n.value - p.value AS yoy_change,
         round(CASE WHEN p.value <> 0 THEN (n.value - p.value) / p.value * 100 END, 2) AS yoy_growth_pct,
         n.value - s.value AS strict_change,
         round(CASE WHEN s.value <> 0 THEN (n.value - s.value) / s.value * 100 END, 2) AS strict_growth_pct
  FROM ranked n
  LEFT JOIN ranked p ON p.dataset = n.dataset AND p.country_code = n.country_code AND p.nr = n.nr - 1
  LEFT JOIN have s ON s.dataset = n.dataset AND s.country_code = n.country_code AND s.year = n.year - 1""")
for _key, _same in (("stored_gdp_trends", "api_gdp_trends"), ("stored_unemployment", "api_unemployment"),
                    ("stored_energy", "api_energy"), ("stored_composite", "api_composite"),
                    ("stored_country_latest", "api_country_latest"), ("stored_rank_gdp", "rank_gdp"),
                    ("bucketed_deltas", "int_yoy_deltas"), ("bucketed_join", "int_country_indicators")):
    ORACLE[_key] = ORACLE[_same]
ORACLE["catalog_views_tables"] = q(f"""
  SELECT 'stg_inflation' AS name, loaded_at, count(*) AS n_rows, min(value) AS low, max(value) AS high
  FROM raw2 WHERE dataset = 'inflation_annual' AND value IS NOT NULL GROUP BY loaded_at
  UNION ALL
  SELECT 'mart_inflation', loaded_at, count(*), min(value), max(value) FROM raw2
  WHERE dataset = 'inflation_annual' AND value IS NOT NULL AND year > 1995 AND loaded_at = {LOAD} GROUP BY loaded_at""")
ORACLE["land_file_headers"] = ORACLE["land_file_slice"]
ORACLE["land_rejects"] = q("""
  SELECT r.country_code, r.year, CAST(r.value AS VARCHAR) || ' p' AS cell
  FROM raw1 r JOIN dim d ON r.country_code = d.country_code
  WHERE r.dataset = 'inflation_annual' AND r.value IS NOT NULL AND (r.year + d.dim_index) % 5 <> 0
    AND (r.year + d.dim_index) % 7 = 0""")
ORACLE["running_alerts"] = q("""
  SELECT * REPLACE (round(z_score, 6) AS z_score, round(mean, 6) AS mean, round(std_dev, 6) AS std_dev) FROM panel_alerts""")
# events in three loads by time; statistics over all loads up to each
_LOADS = """
WITH span AS (SELECT min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b FROM events),
loaded AS (
  SELECT event_id, event_type, ts, value, CAST(CASE WHEN epoch_us(ts) >= a + (b - a) // 3 * 2 THEN 2
         WHEN epoch_us(ts) >= a + (b - a) // 3 THEN 1 ELSE 0 END AS BIGINT) AS load
  FROM events, span),
through AS (
  SELECT l.load, e.event_type, count(e.value) AS n, avg(e.value) AS mean, stddev_samp(e.value) AS std_dev,
         min(e.value) AS low, max(e.value) AS high
  FROM (SELECT unnest([0, 1, 2]) AS load) l JOIN loaded e ON e.load <= l.load
  GROUP BY ALL HAVING count(e.value) > 0)
"""
ORACLE["running_moments"] = q(f"""{_LOADS}
  SELECT load::BIGINT AS load, event_type, n, round(mean, 6) AS mean, round(std_dev, 6) AS std_dev, low, high FROM through""")
ORACLE["running_alerts_by_load"] = q(f"""{_LOADS}
  SELECT e.event_id, e.event_type, e.ts, e.value, e.load, round((e.value - t.mean) / nullif(t.std_dev, 0), 6) AS z_score,
         round(t.mean, 6) AS mean, round(t.std_dev, 6) AS std_dev
  FROM loaded e JOIN through t ON t.load = e.load AND t.event_type IS NOT DISTINCT FROM e.event_type
  WHERE abs((e.value - t.mean) / nullif(t.std_dev, 0)) > {P.z_threshold}""")
_FAULTY = {
    "raw1": "SELECT * REPLACE (CASE WHEN NOT (value IS NULL AND dataset IN ('gdp_annual', 'energy_intensity')) "
            "THEN country_code END AS country_code, CASE WHEN NOT (value IS NULL AND dataset IN "
            "('unemployment_annual', 'inflation_annual')) THEN year END AS year) FROM raw1",
    "staged": "SELECT * REPLACE (CASE WHEN dataset = 'unemployment_annual' THEN value + 60 ELSE value END AS value, "
              "CASE WHEN dataset = 'gdp_annual' AND reference_year % 2 = 1 THEN country_code || '?' "
              "WHEN dataset = 'gdp_annual' OR reference_year % 2 = 1 THEN country_code END AS country_code) FROM staged",
    "deltas_f": "SELECT * REPLACE (CASE WHEN inflation_rate IS NOT NULL THEN country_code END AS country_code, "
                "unemployment_rate - 48 AS unemployment_rate) FROM deltas",
    "mart_gdp": "SELECT * FROM deltas_f_f WHERE gdp_meur IS NOT NULL",
    "mart_unem": "SELECT * REPLACE (round(unemployment_rate, 2) AS unemployment_rate) FROM deltas_f_f "
                 "WHERE unemployment_rate IS NOT NULL",
    "mart_energy": "SELECT * FROM deltas_f_f WHERE energy_intensity IS NOT NULL",
    "composite": "SELECT * REPLACE (composite_score + 45 AS composite_score) FROM composite",
    "mart_latest": "SELECT * FROM mart_latest UNION ALL SELECT * FROM mart_latest WHERE composite_score > 50",
}
_checks = ORACLE["dq_report"][ORACLE["dq_report"].index("SELECT 'gdp_annual' AS table_name"):]
for _t in ("raw1", "staged", "mart_gdp", "mart_unem", "mart_energy", "composite", "mart_latest"):
    _checks = re.sub(rf"\bFROM {_t}\b", f"FROM {_t}_f", _checks)
ORACLE["dq_report_faulty"] = q("WITH " + ",\n".join(f"{n}_f AS ({b})" for n, b in _FAULTY.items()) + "\n" + _checks)
