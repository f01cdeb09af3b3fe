"""Wide fact tables from the long panel.

The reference builds them with three chained LEFT joins from GDP. On a
deduplicated panel (at most one row per dataset x country x year) a
conditional aggregation gives the same rows with a single shuffle; the
literal join chain is kept for inputs that are not deduplicated.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneltide.functions import constants as K


def _pick(dataset: str, c: str) -> F.Column:
    return F.max(F.when(F.col("dataset") == dataset, F.col(c)))


def union_panel(tables: dict[str, DataFrame], columns: list[str] | None = None) -> DataFrame:
    """Collect per-dataset tables into one long panel with a dataset column, which
    is a literal on each branch: a filter on it removes branches from the plan.
    With ``columns`` the panel has exactly those; a table without one gives NULL."""
    def branch(name: str, df: DataFrame) -> DataFrame:
        df = df.withColumn("dataset", F.lit(name))
        return df if columns is None else df.select(*[
            F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [branch(n, d) for n, d in tables.items()])


def country_indicators(staged: DataFrame) -> DataFrame:
    """int_country_indicators: one row per (country, year) that has GDP."""
    wide = (staged.groupBy("country_code", "reference_year")
            .agg(F.count(F.when(F.col("dataset") == K.GDP, 1)).alias("_has_gdp"),
                 _pick(K.GDP, "country_name").alias("country_name"),
                 _pick(K.GDP, "reference_date").alias("reference_date"),
                 _pick(K.GDP, "value").alias("gdp_meur"),
                 _pick(K.UNEMPLOYMENT, "value").alias("unemployment_rate"),
                 _pick(K.ENERGY, "value").alias("energy_intensity"),
                 _pick(K.INFLATION, "value").alias("inflation_rate")))
    return (wide.filter(F.col("_has_gdp") > 0)
            .select("country_code", "country_name", "reference_year", "reference_date",
                    "gdp_meur", F.round(F.col("gdp_meur") / F.lit(1000), 3).alias("gdp_beur"),
                    "unemployment_rate", "energy_intensity", "inflation_rate"))


def country_indicators_by_join(staged: DataFrame) -> DataFrame:
    """The literal LEFT-join chain (fans out when a side is not deduplicated)."""
    return join_sides({ds: staged.filter(F.col("dataset") == ds) for ds in K.DATASETS})


def join_sides(tables: dict[str, DataFrame]) -> DataFrame:
    """The same over one staged table per dataset, such as stored ones."""
    keys = ["country_code", "reference_year"]

    def side(ds: str, name: str) -> DataFrame:
        return tables[ds].select(*keys, F.col("value").alias(name))

    g = tables[K.GDP].select(*keys, "country_name", "reference_date", F.col("value").alias("gdp_meur"))
    out = (g.join(side(K.UNEMPLOYMENT, "unemployment_rate"), keys, "left")
           .join(side(K.ENERGY, "energy_intensity"), keys, "left")
           .join(side(K.INFLATION, "inflation_rate"), keys, "left"))
    return out.select("country_code", "country_name", "reference_year", "reference_date",
                      "gdp_meur", F.round(F.col("gdp_meur") / F.lit(1000), 3).alias("gdp_beur"),
                      "unemployment_rate", "energy_intensity", "inflation_rate")


def combined_indicators(enriched: DataFrame) -> DataFrame:
    """The batch job's wide table from the enriched long panel (keys first)."""
    wide = (enriched.groupBy("country_code", "year")
            .agg(F.count(F.when(F.col("dataset") == K.GDP, 1)).alias("_has_gdp"),
                 _pick(K.GDP, "country_name").alias("country_name"),
                 _pick(K.GDP, "reference_date").alias("reference_date"),
                 _pick(K.GDP, "value").alias("_gdp_meur"),
                 _pick(K.GDP, "yoy_growth_pct").alias("gdp_yoy_pct"),
                 _pick(K.UNEMPLOYMENT, "value").alias("unemployment_rate"),
                 _pick(K.UNEMPLOYMENT, "yoy_growth_pct").alias("unem_yoy_pct"),
                 _pick(K.ENERGY, "value").alias("energy_intensity"),
                 _pick(K.ENERGY, "yoy_growth_pct").alias("energy_yoy_pct"),
                 _pick(K.INFLATION, "value").alias("inflation_rate")))
    return (wide.filter(F.col("_has_gdp") > 0)
            .select("country_code", "year", "country_name", "reference_date",
                    F.round(F.col("_gdp_meur") / F.lit(1000), 3).alias("gdp_beur"),
                    "gdp_yoy_pct", "unemployment_rate", "unem_yoy_pct",
                    "energy_intensity", "energy_yoy_pct", "inflation_rate"))
