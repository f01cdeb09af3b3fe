"""Per-series metrics: year-over-year deltas and z-scores.

A series is one (dataset, country) time line. All measures of a row come from
one partitioning and sort of its series: the previous row for the deltas, and
mean and deviation over the whole series in ascending order, a constant state
per series (no array of its values is built).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneltide.functions import constants as K
from paneltide.functions.columns import growth_pct, safe_div, year_start

SERIES = ("dataset", "country_code")


def _ordered(keys):
    return Window.partitionBy(*keys).orderBy("year", "value")


def _whole(keys):
    """The whole series in a fixed order, so that floating-point statistics do
    not depend on how rows arrive."""
    return _ordered(keys).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def yoy(keys=SERIES, value: str = "value") -> dict[str, Column]:
    """Change (unrounded) and growth in percent (2 dp, NULL when the previous
    value is 0 or NULL) against the previous row of the series; a gap year
    compares with the row before the gap."""
    now, before = F.col(value), F.lag(value).over(Window.partitionBy(*keys).orderBy("year"))
    return {"yoy_change": now - before, "yoy_growth_pct": growth_pct(now, before)}


def yoy_strict(keys=SERIES, value: str = "value") -> dict[str, Column]:
    """Change and growth against the calendar year before, NULL where that year is missing:
    a RANGE frame one year back, in the same partitioning and order as ``yoy``."""
    year_before = Window.partitionBy(*keys).orderBy("year").rangeBetween(-1, -1)
    now, before = F.col(value), F.max(value).over(year_before)
    return {"strict_change": now - before, "strict_growth_pct": growth_pct(now, before)}


def series_stats(keys=SERIES, value: str = "value") -> dict[str, Column]:
    """Mean and sample standard deviation over the series' non-NULL values: NULL
    mean for an all-NULL series, NULL deviation below two values."""
    w = _whole(keys)
    return {"mean": F.avg(value).over(w), "std_dev": F.when(
        F.count(value).over(w) > 1, F.stddev_samp(value).over(w))}


def z_score(value: Column, mean: Column, std_dev: Column) -> Column:
    """NULL for a zero or undefined deviation."""
    return safe_div(value - mean, F.nullif(std_dev, F.lit(0.0)))


def enrich_panel(raw: DataFrame, keys=SERIES) -> DataFrame:
    """The batch enrichment for all datasets in one pass: deltas, z-score (3 dp,
    0 when undefined), reference date, then the NOT NULL filter (after the
    windows, so NULL values still occupy their row for the deltas)."""
    stats = series_stats(keys)
    z = z_score(F.col("value"), stats["mean"], stats["std_dev"])
    defined = F.coalesce(stats["std_dev"], F.lit(0.0)) != 0
    return raw.select("*", *[c.alias(n) for n, c in yoy(keys).items()],
                      F.round(F.when(defined, z).otherwise(F.lit(0.0)), 3).alias("z_score"),
                      year_start("year").alias("reference_date")) \
        .filter(F.col("value").isNotNull())


PROCESSED_NAMES = {
    K.GDP: "gdp_meur",
    K.UNEMPLOYMENT: "unemployment_rate",
    K.ENERGY: "energy_intensity",
    K.INFLATION: "inflation_rate",
}


def processed_table(enriched: DataFrame, dataset: str) -> DataFrame:
    """One ``*_processed`` table in the reference's column layout."""
    from paneltide.sources.testdata import RAW_COLUMNS
    vname = PROCESSED_NAMES[dataset]
    cols = [F.col("value").alias(vname) if c == "value" else F.col(c)
            for c in RAW_COLUMNS[dataset]]
    if dataset == K.GDP:
        cols.append(F.round(F.col("value") / F.lit(1000), 3).alias("gdp_beur"))
    cols += [F.col("yoy_change"), F.col("yoy_growth_pct"), F.col("z_score"),
             F.col("reference_date")]
    return enriched.filter(F.col("dataset") == dataset).select(*cols)
