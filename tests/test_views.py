"""Dashboard dataset edge rows: ties, truncation, defaults, dedupe by name."""
from paneltide.operators import views

LATEST = ("country_code string, country_name string, composite_score double, "
          "gdp_yoy_growth_pct double, unemployment_rate double, energy_intensity double")


def test_best_worst_ties_go_to_lower_code(spark):
    df = spark.createDataFrame([("FR", "France", 60.0, 1.0, 5.0, 0.2),
                                ("DE", "Germany", 60.0, 2.0, 6.0, 0.3),
                                ("IT", "Italy", None, None, None, None)], LATEST)
    k = views.home_kpis(df).first()
    assert (k["top_country"], k["top_score"]) == ("Germany", 60.0)
    assert k["avg_composite"] == 60.0 and k["avg_unemployment"] == 5.5


def test_empty_selection_defaults(spark):
    k = views.home_kpis(spark.createDataFrame([], LATEST)).first()
    assert (k["avg_gdp_growth"], k["top_country"], k["top_score"]) == (0.0, "", 0.0)


def test_ranking_bar_percent_truncates_and_zero_max_uses_100(spark):
    df = spark.createDataFrame([("DE", "Germany", 66.7, None, None, None),
                                ("FR", "France", 33.3, None, None, None)], LATEST)
    out = {r["country_code"]: (r["rank"], r["bar_pct"]) for r in views.home_ranking(df).collect()}
    assert out == {"DE": (1, 100), "FR": (2, 49)}  # 33.3 / 66.7 * 100 = 49.9 -> 49
    zero = spark.createDataFrame([("DE", "Germany", 0.0, None, None, None)], LATEST)
    assert views.home_ranking(zero).first()["bar_pct"] == 0


def test_composite_latest_dedupes_by_name_and_bands(spark):
    comp = spark.createDataFrame(
        [("DE", "Germany", 2001, 70.0, 1.0, 1.0, 1.0), ("DX", "Germany", 2001, 40.0, 1.0, 1.0, 1.0),
         ("FR", "France", 2001, 39.9, 1.0, 1.0, 1.0), ("FR", "France", 2000, 99.0, 1.0, 1.0, 1.0)],
        "country_code string, country_name string, reference_year int, composite_score double, "
        "gdp_score double, unemployment_score double, energy_score double")
    out = {r["country_name"]: (r["rank"], r["band"]) for r in views.composite_ranking(comp).collect()}
    assert out == {"Germany": (1, "top"), "France": (2, "bottom")}
    k = views.composite_kpis(comp).first()
    assert (k["latest_year"], k["top_country"], k["bottom_country"]) == (2001, "Germany", "France")
    assert k["median_score"] == (70.0 + 39.9) / 2
