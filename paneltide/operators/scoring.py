"""YoY deltas on the wide table and the 0-100 composite index."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneltide.functions.columns import growth_pct, minmax_score


def yoy_deltas(wide: DataFrame) -> DataFrame:
    """int_yoy_deltas: four LAGs over one shared window per country."""
    w = Window.partitionBy("country_code").orderBy("reference_year")
    prev = {c: F.lag(c).over(w) for c in
            ("gdp_meur", "unemployment_rate", "energy_intensity", "inflation_rate")}
    df = wide.select("*", *[p.alias(f"_prev_{c}") for c, p in prev.items()])

    def p(c: str) -> F.Column:
        return F.col(f"_prev_{c}")

    return df.select(
        "country_code", "country_name", "reference_year", "reference_date",
        "gdp_meur", "gdp_beur",
        F.round(F.col("gdp_meur") - p("gdp_meur"), 2).alias("gdp_yoy_change_meur"),
        growth_pct(F.col("gdp_meur"), p("gdp_meur")).alias("gdp_yoy_growth_pct"),
        "unemployment_rate",
        F.round(F.col("unemployment_rate") - p("unemployment_rate"), 2).alias("unem_yoy_change"),
        "energy_intensity",
        F.round(F.col("energy_intensity") - p("energy_intensity"), 3).alias("energy_yoy_change"),
        growth_pct(F.col("energy_intensity"), p("energy_intensity"), invert=True)
        .alias("energy_yoy_improvement_pct"),
        "inflation_rate",
        F.round(F.col("inflation_rate") - p("inflation_rate"), 2).alias("inflation_yoy_change"),
    )


def score_columns(deltas: DataFrame, year_min: int) -> DataFrame:
    """Add the min-max scores (GDP growth direct; unemployment and energy
    inverted; 50 when undefined) and the composite (mean of three, 1 dp).

    MIN/MAX per year come from an unordered window partitioned by year. A
    year holds at most one row per country of the dimension, so the window
    buffer is bounded, and the chain is not planned twice (as an aggregate
    joined back would be). Years before ``year_min`` form their own window
    partitions, so they cannot influence the scored years; their score
    columns are NULL.
    """
    w = Window.partitionBy("reference_year")
    in_range = F.col("reference_year") >= year_min

    def mm(c: str, invert: bool) -> F.Column:
        return minmax_score(F.col(c), F.min(c).over(w), F.max(c).over(w), invert=invert)

    scores = {"gdp_score": mm("gdp_yoy_growth_pct", False),
              "unemployment_score": mm("unemployment_rate", True),
              "energy_score": mm("energy_intensity", True)}
    df = deltas.select("*", *[F.when(in_range, e).alias(n) for n, e in scores.items()])
    return df.withColumn(
        "composite_score",
        F.round((F.col("gdp_score") + F.col("unemployment_score") + F.col("energy_score"))
                / F.lit(3), 1))


COMPOSITE_COLUMNS = ["country_code", "country_name", "reference_year", "reference_date",
                     "gdp_score", "unemployment_score", "energy_score", "composite_score"]


def composite_index(scored: DataFrame, year_min: int) -> DataFrame:
    """mart_composite_economic_index: the scored rows from ``year_min`` on."""
    return scored.filter(F.col("reference_year") >= year_min).select(*COMPOSITE_COLUMNS)
