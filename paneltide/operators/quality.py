"""Data-quality report: the reference's 31 declarative checks as one
DataFrame of (table_name, column_name, check_name, failures) (QC1-QC4).

The checks of all tables derived from one long panel are evaluated in a
single aggregate pass over that panel (a conditional count per check), so
the report costs one pass over the landed panel, one over the staged panel,
one over the scored wide table and one over the latest snapshot, plus the
``unique`` grouped count and the ``relationships`` left-anti join.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneltide.functions import constants as K

NOT_NULL = "not_null"
RANGE = "accepted_range"


def _failing(c: Column, kind: str, lo=None, hi=None) -> Column:
    if kind == NOT_NULL:
        return c.isNull()
    return c.isNotNull() & ((c < lo) | (c > hi))


def checks_pass(df: DataFrame, checks: list[tuple]) -> DataFrame:
    """checks: (table, column, kind, row_filter, failing_condition); one
    aggregate computes every count, ``stack`` turns the row into rows."""
    aggs = [F.count(F.when(flt & bad, 1)).alias(f"c{i}")
            for i, (_, _, _, flt, bad) in enumerate(checks)]
    row = df.agg(*aggs)
    stack = ", ".join(f"'{t}', '{c}', '{k}', c{i}" for i, (t, c, k, _, _) in enumerate(checks))
    return row.selectExpr(
        f"stack({len(checks)}, {stack}) AS (table_name, column_name, check_name, failures)")


def unique_check(df: DataFrame, table: str, column: str) -> DataFrame:
    dup = df.filter(F.col(column).isNotNull()).groupBy(column).count().filter("count > 1")
    return dup.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
        F.lit("unique").alias("check_name"), "failures")


def relationship_check(child: DataFrame, parent: DataFrame, table: str, column: str,
                       parent_column: str) -> DataFrame:
    c = child.select(F.col(column).alias("_k")).filter(F.col("_k").isNotNull())
    p = parent.select(F.col(parent_column).alias("_k")).distinct()
    orphans = c.join(p, "_k", "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
        F.lit("relationships").alias("check_name"), "failures")


def dq_report(raw: DataFrame, staged: DataFrame, scored: DataFrame, latest: DataFrame,
              score_year_min: int) -> DataFrame:
    """raw: landed long panel; staged: staged long panel; scored: wide
    deltas + scores (all years); latest: the latest-year snapshot."""
    ds = F.col("dataset")
    nn = lambda c: _failing(F.col(c), NOT_NULL)
    raw_checks = [(t, c, NOT_NULL, ds == t, nn(c)) for t in K.DATASETS
                  for c in ("country_code", "year")]
    stg = {K.GDP: "stg_gdp", K.UNEMPLOYMENT: "stg_unemployment", K.ENERGY: "stg_energy",
           K.INFLATION: "stg_inflation"}
    stg_checks = [
        (stg[K.GDP], "country_code", NOT_NULL, ds == K.GDP, nn("country_code")),
        (stg[K.GDP], "reference_year", NOT_NULL, ds == K.GDP, nn("reference_year")),
        (stg[K.GDP], "gdp_meur", NOT_NULL, ds == K.GDP, nn("value")),
        (stg[K.UNEMPLOYMENT], "country_code", NOT_NULL, ds == K.UNEMPLOYMENT, nn("country_code")),
        (stg[K.UNEMPLOYMENT], "reference_year", NOT_NULL, ds == K.UNEMPLOYMENT,
         nn("reference_year")),
        (stg[K.UNEMPLOYMENT], "unemployment_rate", NOT_NULL, ds == K.UNEMPLOYMENT, nn("value")),
        (stg[K.UNEMPLOYMENT], "unemployment_rate", RANGE, ds == K.UNEMPLOYMENT,
         _failing(F.col("value"), RANGE, 0, 100)),
        (stg[K.ENERGY], "country_code", NOT_NULL, ds == K.ENERGY, nn("country_code")),
        (stg[K.ENERGY], "reference_year", NOT_NULL, ds == K.ENERGY, nn("reference_year")),
        (stg[K.INFLATION], "country_code", NOT_NULL, ds == K.INFLATION, nn("country_code")),
        (stg[K.INFLATION], "reference_year", NOT_NULL, ds == K.INFLATION, nn("reference_year")),
    ]
    in_gdp = F.col("gdp_meur").isNotNull()
    in_unem = F.col("unemployment_rate").isNotNull()
    in_energy = F.col("energy_intensity").isNotNull()
    in_comp = F.col("reference_year") >= score_year_min
    unem2 = F.round("unemployment_rate", 2)
    mart_checks = [
        ("mart_gdp_trends", "country_code", NOT_NULL, in_gdp, nn("country_code")),
        ("mart_gdp_trends", "reference_year", NOT_NULL, in_gdp, nn("reference_year")),
        ("mart_gdp_trends", "gdp_beur", NOT_NULL, in_gdp, nn("gdp_beur")),
        ("mart_unemployment_comparison", "country_code", NOT_NULL, in_unem, nn("country_code")),
        ("mart_unemployment_comparison", "reference_year", NOT_NULL, in_unem,
         nn("reference_year")),
        ("mart_unemployment_comparison", "unemployment_rate", RANGE, in_unem,
         _failing(unem2, RANGE, 0, 100)),
        ("mart_energy_intensity", "country_code", NOT_NULL, in_energy, nn("country_code")),
        ("mart_energy_intensity", "reference_year", NOT_NULL, in_energy, nn("reference_year")),
        ("mart_composite_economic_index", "composite_score", RANGE, in_comp,
         _failing(F.col("composite_score"), RANGE, 0, 100)),
    ]
    gdp_stg = staged.filter(ds == K.GDP)
    gdp_raw = raw.filter(ds == K.GDP)
    parts = [
        checks_pass(raw, raw_checks),
        checks_pass(staged, stg_checks),
        relationship_check(gdp_stg, gdp_raw, stg[K.GDP], "country_code", "country_code"),
        checks_pass(scored, mart_checks),
        checks_pass(latest, [("mart_country_latest", "country_code", NOT_NULL, F.lit(True),
                              nn("country_code"))]),
        unique_check(latest, "mart_country_latest", "country_code"),
    ]
    return reduce(DataFrame.unionByName, parts)
