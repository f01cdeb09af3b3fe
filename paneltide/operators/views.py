"""Read API and dashboard datasets.

Inputs are the marts; all results are DataFrames. Statistics are plain
aggregates (partial + final); ``max_by``/``min_by`` over a (score, code)
key give a deterministic best/worst row with ties going to the lower
country code. Global row numbers are only taken after the frame has been
reduced to one row per country (bounded by the country dimension).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneltide.sources.dimension import iso3_of_code
from paneltide.functions.columns import (fixed_mean, score_band, score_tier, to_iso2,
                                        upper_or_low)

_BASE = ["country_code", "country_name", "reference_year", "reference_date"]


# --- read API --------------------------------------------------------------
def _range(df: DataFrame, start: int, end: int, countries) -> DataFrame:
    cond = F.col("reference_year").between(start, end)
    if countries:
        cond = cond & F.col("country_code").isin(list(countries))
    return df.filter(cond)


def api_gdp_trends(mart: DataFrame, start: int, end: int, countries=None) -> DataFrame:
    return (_range(mart, start, end, countries)
            .select(*_BASE, "gdp_beur", "gdp_yoy_growth_pct",
                    to_iso2("country_code").alias("iso2")))


def api_unemployment(mart: DataFrame, start: int, end: int, countries=None) -> DataFrame:
    return (_range(mart, start, end, countries)
            .select(*_BASE, "unemployment_rate",
                    F.col("unem_yoy_change").alias("unemp_yoy_change"),
                    to_iso2("country_code").alias("iso2")))


def api_energy(mart: DataFrame, start: int, end: int, countries=None) -> DataFrame:
    return (_range(mart, start, end, countries)
            .select(*_BASE, "energy_intensity",
                    F.col("energy_yoy_improvement_pct").alias("energy_yoy_improvement"),
                    to_iso2("country_code").alias("iso2")))


def api_composite(composite: DataFrame, start: int, end: int, countries=None) -> DataFrame:
    return (_range(composite, start, end, countries)
            .select(*_BASE, "gdp_score", "unemployment_score", "energy_score",
                    "composite_score", to_iso2("country_code").alias("iso2")))


def in_api_order(df: DataFrame, composite: bool = False) -> DataFrame:
    """The order of an API answer; page datasets build on the unsorted frames."""
    if composite:
        return df.orderBy(F.col("reference_year").desc(), F.col("composite_score").desc_nulls_last(),
                          F.col("country_code"))
    return df.orderBy("country_code", "reference_year")


def api_country_latest(latest: DataFrame, countries=None) -> DataFrame:
    df = latest.withColumnRenamed("unem_yoy_change", "unemp_yoy_change")
    if countries:
        df = df.filter(F.col("country_code").isin(list(countries)))
    return (df.withColumn("iso2", to_iso2("country_code"))
            .orderBy(F.col("composite_score").desc_nulls_last(), F.col("country_code")))


def api_recent_alerts(alerts: DataFrame, limit: int) -> DataFrame:
    """Most recent alerts (a top-k report: TakeOrderedAndProject)."""
    return (alerts.select("dataset", "country_code", "year", "z_score",
                          upper_or_low("severity").alias("severity"), "detected_at")
            .orderBy(F.col("detected_at").desc_nulls_last(), "dataset", "country_code", "year",
                     F.col("z_score").desc_nulls_last())
            .limit(limit))


# --- shared page helpers ---------------------------------------------------
def latest_rows(df: DataFrame, year_col: str = "reference_year") -> DataFrame:
    """Rows of the latest year: ``rank() = 1`` by year, planned as a
    WindowGroupLimit, so each task passes on the rows of its latest year only."""
    newest = F.rank().over(Window.orderBy(F.col(year_col).desc_nulls_last()))
    return df.withColumn("_newest", newest).filter(
        (F.col("_newest") == 1) & F.col(year_col).isNotNull()).drop("_newest")


def _latest_of(df: DataFrame, measures: dict[str, F.Column], parts: dict[str, F.Column] | None = None,
               overall: dict[str, F.Column] | None = None) -> DataFrame:
    """One aggregate by year (``measures`` and ``parts``), then the latest year's
    measures beside ``overall`` aggregates of the yearly rows; one row."""
    named = lambda d: [c.alias(n) for n, c in (d or {}).items()]
    by_year = df.groupBy("reference_year").agg(F.struct(*named(measures)).alias("_m"), *named(parts))
    return by_year.agg(F.max("reference_year").alias("latest_year"),
                       F.max_by("_m", "reference_year").alias("_m"), *named(overall)) \
        .select("latest_year", "_m.*", *(overall or {}))


def _best(name: str, value: str, largest: bool = True) -> F.Column:
    key = F.struct((-F.col(value)) if largest else F.col(value), F.col("country_code"))
    return F.min_by(F.col(name), F.when(F.col(value).isNotNull(), key))


# decimals carried by the mart columns the pages average (see operators/marts.py)
SCALES = {"gdp_yoy_growth_pct": 2, "unemployment_rate": 2, "unemp_yoy_change": 2,
          "energy_intensity": 3, "composite_score": 1}


def _mean(c: str) -> F.Column:
    return fixed_mean(c, SCALES[c])


def _mean0(c: str) -> F.Column:
    return F.coalesce(_mean(c), F.lit(0.0))


# --- home page -------------------------------------------------------------
def home_kpis(latest: DataFrame) -> DataFrame:
    return latest.agg(
        _mean0("gdp_yoy_growth_pct").alias("avg_gdp_growth"),
        _mean0("unemployment_rate").alias("avg_unemployment"),
        _mean0("energy_intensity").alias("avg_energy"),
        _mean0("composite_score").alias("avg_composite"),
        F.coalesce(_best("country_name", "composite_score"), F.lit("")).alias("top_country"),
        F.coalesce(_best("composite_score", "composite_score"), F.lit(0.0)).alias("top_score"))


def home_map(composite: DataFrame, countries=None) -> DataFrame:
    """Latest year of the (unfiltered) composite frame, then the selection."""
    rows = latest_rows(composite)
    if countries:
        rows = rows.filter(F.col("country_code").isin(list(countries)))
    return rows.select("country_code", "country_name", "reference_year", "composite_score",
                       to_iso2("country_code").alias("iso2"),
                       iso3_of_code(F.col("country_code")).alias("iso3"))


def home_ranking(latest: DataFrame) -> DataFrame:
    """Ranked one-row-per-country snapshot (the global window runs on at most
    one row per country)."""
    rows = latest.filter(F.col("composite_score").isNotNull())
    w = Window.orderBy(F.col("composite_score").desc(), F.col("country_code"))
    mx = F.max("composite_score").over(Window.partitionBy())
    denom = F.when(mx.isNull() | (mx == 0), F.lit(100.0)).otherwise(mx)
    return (rows
            .select(F.row_number().over(w).alias("rank"), "country_code", "country_name",
                    "composite_score", "gdp_yoy_growth_pct", "unemployment_rate",
                    (F.col("composite_score") / denom * 100).cast("int").alias("bar_pct")))


# --- indicator pages -------------------------------------------------------
def ranking(latest: DataFrame, metrics: list[str]) -> DataFrame:
    """Ascending bar rankings of the latest year, one block per metric."""
    names = ["country_code", "country_name"]
    long = latest.select(*names, *[F.col(m).cast("double").alias(m) for m in metrics]) \
        .unpivot(names, metrics, "metric", "value").filter(F.col("value").isNotNull())
    place = F.row_number().over(Window.partitionBy("metric").orderBy("value", "country_code"))
    return long.select("metric", place.alias("position"), *names, "value")


def heatmap(df: DataFrame, value_col: str, years: list[int]) -> DataFrame:
    """country_name x year pivot of the mean value; the year columns are
    given explicitly (the requested range), so no distinct-values job runs."""
    return df.groupBy("country_name").pivot("reference_year", years).agg(F.avg(value_col))


def gdp_kpis(gdp: DataFrame) -> DataFrame:
    return _latest_of(gdp, {
        "avg_growth": _mean("gdp_yoy_growth_pct"),
        "largest_country": _best("country_name", "gdp_beur"),
        "largest_gdp_beur": _best("gdp_beur", "gdp_beur"),
        "fastest_country": _best("country_name", "gdp_yoy_growth_pct"),
        "fastest_growth_pct": _best("gdp_yoy_growth_pct", "gdp_yoy_growth_pct")})


def unemployment_kpis(unem: DataFrame) -> DataFrame:
    rate, scale = "unemployment_rate", 10 ** SCALES["unemployment_rate"]
    return _latest_of(unem, {
        "avg_rate": _mean(rate),
        "lowest_country": _best("country_name", rate, largest=False),
        "lowest_rate": _best(rate, rate, largest=False),
        "highest_country": _best("country_name", rate),
        "highest_rate": _best(rate, rate),
        "avg_yoy_change": _mean("unemp_yoy_change"),
    }, {"_sum": F.sum(F.round(F.col(rate) * scale).cast("long")), "_n": F.count(rate)},
        {"overall_mean": F.sum("_sum").cast("double") / (F.lit(float(scale)) * F.sum("_n"))})


def energy_kpis(energy: DataFrame) -> DataFrame:
    e = "energy_intensity"
    out = _latest_of(energy, {
        "avg_intensity": _mean(e),
        "most_efficient": _best("country_name", e, largest=False),
        "most_efficient_value": _best(e, e, largest=False),
        "least_efficient": _best("country_name", e),
        "least_efficient_value": _best(e, e),
    }, {"_a": _mean(e)}, {"first_year": F.min("reference_year"), "_a0": F.min_by("_a", "reference_year"),
                          "_a1": F.max_by("_a", "reference_year")})
    several = (F.col("first_year") < F.col("latest_year")) & F.col("_a0").isNotNull() & (F.col("_a0") != 0)
    gain = F.when(several, (F.col("_a0") - F.col("_a1")) / F.col("_a0") * 100).otherwise(F.lit(0.0))
    return out.withColumn("improvement_pct", gain).drop("_a0", "_a1")


def energy_gdp_scatter(energy: DataFrame, gdp: DataFrame, year: int | None = None) -> DataFrame:
    """Energy x GDP for one year (default: the latest energy year)."""
    if year is None:
        e = latest_rows(energy)
    else:
        e = energy.filter(F.col("reference_year") == year)
    e = e.select("country_code", "country_name", "energy_intensity", "reference_year")
    g = gdp.select("country_code", F.col("reference_year").alias("_gy"), "gdp_beur")
    return (e.join(g, (e.country_code == g.country_code) & (e.reference_year == g._gy))
            .select(e.country_code, "country_name", "energy_intensity", "reference_year",
                    F.coalesce(F.col("gdp_beur"), F.lit(0.0)).alias("gdp_beur")))


# --- composite page --------------------------------------------------------
def composite_latest(comp: DataFrame) -> DataFrame:
    """Latest-year rows, one per country name (the first in API order)."""
    latest = latest_rows(comp)
    w = Window.partitionBy("country_name").orderBy(F.col("composite_score").desc_nulls_last(),
                                                   F.col("country_code"))
    return latest.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def composite_kpis(comp: DataFrame) -> DataFrame:
    latest = composite_latest(comp)
    return latest.agg(
        F.max("reference_year").alias("latest_year"),
        _mean("composite_score").alias("avg_score"),
        _best("country_name", "composite_score").alias("top_country"),
        _best("composite_score", "composite_score").alias("top_score"),
        _best("country_name", "composite_score", largest=False).alias("bottom_country"),
        _best("composite_score", "composite_score", largest=False).alias("bottom_score"),
        F.median("composite_score").alias("median_score"))


def composite_ranking(comp: DataFrame) -> DataFrame:
    latest = composite_latest(comp).filter(F.col("composite_score").isNotNull())
    w = Window.orderBy(F.col("composite_score").desc(), F.col("country_code"))
    return latest.select(F.row_number().over(w).alias("rank"), "country_code", "country_name",
                         "composite_score", "gdp_score", "unemployment_score", "energy_score",
                         score_band("composite_score").alias("band"))


_COMPONENTS = ["composite_score", "gdp_score", "unemployment_score", "energy_score"]


def composite_tiers(comp: DataFrame, country: str | None = None) -> DataFrame:
    latest = latest_rows(comp)
    if country:
        latest = latest.filter(F.col("country_code") == country)
    long = latest.unpivot(["country_code", "country_name", "reference_year"], _COMPONENTS,
                          "component", "score")
    return long.withColumn("tier", score_tier("score"))


def composite_components(comp: DataFrame, country: str | None = None) -> DataFrame:
    df = comp if not country else comp.filter(F.col("country_code") == country)
    parts = df.select("country_code", "reference_year", "composite_score",
                      *[(F.col(c) / 3).alias(c) for c in _COMPONENTS[1:]])
    return (parts.unpivot(["country_code", "reference_year", "composite_score"], _COMPONENTS[1:],
                          "component", "contribution")
            .orderBy("country_code", "reference_year", "component"))
