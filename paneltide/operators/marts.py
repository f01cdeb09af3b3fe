"""Rounded mart projections and the latest-year snapshot."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_KEYS = ["country_code", "country_name", "reference_year", "reference_date"]


def gdp_trends(deltas: DataFrame) -> DataFrame:
    return deltas.filter(F.col("gdp_meur").isNotNull()).select(
        *_KEYS, F.round("gdp_beur", 3).alias("gdp_beur"), F.round("gdp_meur", 0).alias("gdp_meur"),
        "gdp_yoy_change_meur", "gdp_yoy_growth_pct")


def unemployment_comparison(deltas: DataFrame) -> DataFrame:
    return deltas.filter(F.col("unemployment_rate").isNotNull()).select(
        *_KEYS, F.round("unemployment_rate", 2).alias("unemployment_rate"),
        F.round("unem_yoy_change", 2).alias("unem_yoy_change"))


def energy_intensity(deltas: DataFrame) -> DataFrame:
    return deltas.filter(F.col("energy_intensity").isNotNull()).select(
        *_KEYS, F.round("energy_intensity", 3).alias("energy_intensity"),
        F.round("energy_yoy_change", 3).alias("energy_yoy_change"),
        F.round("energy_yoy_improvement_pct", 2).alias("energy_yoy_improvement_pct"))


def country_latest(scored: DataFrame) -> DataFrame:
    """Latest year with GDP per country with its deltas and scores.

    ``scored`` (int_yoy_deltas plus the composite columns, NULL before the
    score range) carries every column of the reference's three-way join for
    the same (country, year) key, so the join collapses into a top-1 per
    country (planned as a WindowGroupLimit).
    """
    w = Window.partitionBy("country_code").orderBy(F.col("reference_year").desc())
    latest = (scored.filter(F.col("gdp_meur").isNotNull())
              .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1))
    return latest.select(
        "country_code", "country_name", F.col("reference_year").alias("latest_year"),
        F.round("gdp_beur", 2).alias("gdp_beur"),
        F.round("unemployment_rate", 2).alias("unemployment_rate"),
        F.round("energy_intensity", 3).alias("energy_intensity"),
        F.round("inflation_rate", 2).alias("inflation_rate"),
        F.round("gdp_yoy_growth_pct", 2).alias("gdp_yoy_growth_pct"),
        F.round("unem_yoy_change", 2).alias("unem_yoy_change"),
        F.round("composite_score", 1).alias("composite_score"),
        F.round("gdp_score", 1).alias("gdp_score"),
        F.round("unemployment_score", 1).alias("unemployment_score"),
        F.round("energy_score", 1).alias("energy_score"))
