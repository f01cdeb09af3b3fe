"""Composite index, bands and tiers."""
from pyspark.sql import functions as F

from paneltide.functions.columns import score_band, score_tier, severity, to_iso2
from paneltide.operators import scoring

DELTAS = ("country_code string, country_name string, reference_year int, reference_date date, "
          "gdp_yoy_growth_pct double, unemployment_rate double, energy_intensity double")


def _score(spark, rows, year_min=2000):
    df = spark.createDataFrame(rows, DELTAS)
    return {r["country_code"]: r for r in
            scoring.composite_index(scoring.score_columns(df, year_min), year_min).collect()}


def test_one_country_in_a_year_scores_50(spark):
    r = _score(spark, [("DE", "Germany", 2010, None, None, 5.0, 0.2)])["DE"]
    assert (r["gdp_score"], r["unemployment_score"], r["energy_score"], r["composite_score"]) \
        == (50.0, 50.0, 50.0, 50.0)


def test_missing_measure_scores_50_others_computed(spark):
    s = _score(spark, [("DE", "Germany", 2010, None, 2.0, None, 0.1),
                       ("FR", "France", 2010, None, 4.0, 6.0, 0.3)])
    assert s["DE"]["unemployment_score"] == 50.0
    assert (s["DE"]["gdp_score"], s["FR"]["gdp_score"]) == (0.0, 100.0)
    assert (s["DE"]["energy_score"], s["FR"]["energy_score"]) == (100.0, 0.0)  # inverted
    assert s["DE"]["composite_score"] == round((0 + 50 + 100) / 3, 1)


def test_year_lower_bound(spark):
    s = _score(spark, [("DE", "Germany", 1999, None, 1.0, 1.0, 1.0)], year_min=2000)
    assert s == {}


def test_bands_and_tiers_edges(spark):
    df = spark.createDataFrame([(70.0,), (40.0,), (39.9,), (70.1,)], "s double")
    out = {r["s"]: (r["band"], r["tier"]) for r in
           df.select("s", score_band("s").alias("band"), score_tier("s").alias("tier")).collect()}
    assert out[70.0] == ("top", "Moderate")
    assert out[40.0] == ("middle", "Weak")
    assert out[39.9] == ("bottom", "Weak")
    assert out[70.1] == ("top", "Strong")


def test_severity_and_iso2(spark):
    df = spark.createDataFrame([(2.01,), (3.0,), (-4.0,), (None,)], "z double")
    sev = [r[0] for r in df.select(severity("z")).collect()]
    assert sev == ["LOW", "MEDIUM", "HIGH", "LOW"]
    codes = spark.createDataFrame([("EL",), ("DE",)], "c string")
    assert [r[0] for r in codes.select(to_iso2("c")).collect()] == ["GR", "DE"]
