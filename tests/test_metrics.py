"""YoY and z-score edge rows (batch enrichment semantics)."""
import datetime as dt

from pyspark.sql import functions as F

from paneltide.operators import metrics

SCHEMA = "dataset string, country_code string, year int, value double"


def _panel(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _yoy(df):
    return df.select("*", *[c.alias(n) for n, c in metrics.yoy().items()])


def _stats(df):
    return df.select("*", *[c.alias(n) for n, c in metrics.series_stats().items()])


def _by_year(df):
    return {r["year"]: r for r in df.collect()}


def test_gap_year_compares_with_previous_row(spark):
    df = _yoy(_panel(spark, [("g", "DE", 2001, 100.0), ("g", "DE", 2003, 110.0)]))
    assert _by_year(df)[2003]["yoy_growth_pct"] == 10.0


def test_previous_zero_gives_change_but_no_growth(spark):
    r = _by_year(_yoy(_panel(spark, [("g", "DE", 1, 0.0), ("g", "DE", 2, 5.0)])))[2]
    assert r["yoy_change"] == 5.0 and r["yoy_growth_pct"] is None


def test_negative_previous(spark):
    r = _by_year(_yoy(_panel(spark, [("g", "DE", 1, -2.0), ("g", "DE", 2, 1.0)])))[2]
    assert r["yoy_growth_pct"] == -150.0


def test_first_year_and_single_observation(spark):
    df = metrics.enrich_panel(_panel(spark, [("g", "DE", 2000, 7.0)]))
    r = df.collect()[0]
    assert r["yoy_change"] is None and r["yoy_growth_pct"] is None and r["z_score"] == 0.0
    assert r["reference_date"] == dt.date(2000, 1, 1)


def test_constant_series_has_zero_z(spark):
    df = metrics.enrich_panel(_panel(spark, [("g", "DE", y, 5.0) for y in (1, 2, 3)]))
    assert {r["z_score"] for r in df.collect()} == {0.0}


def test_null_inside_series_blocks_growth_and_is_dropped_after(spark):
    df = metrics.enrich_panel(_panel(spark, [("g", "DE", 1, 1.0), ("g", "DE", 2, None),
                                             ("g", "DE", 3, 3.0)]))
    rows = _by_year(df)
    assert set(rows) == {1, 3}
    assert rows[3]["yoy_growth_pct"] is None  # lag saw the NULL row


def test_series_are_independent(spark):
    df = _yoy(_panel(spark, [("a", "DE", 1, 1.0), ("b", "DE", 2, 2.0)]))
    assert all(r["yoy_change"] is None for r in df.collect())


def test_zscore_rounding_and_values(spark):
    df = metrics.enrich_panel(_panel(spark, [("g", "DE", 1, 1.0), ("g", "DE", 2, 2.0),
                                           ("g", "DE", 3, 3.0)]))
    assert sorted(r["z_score"] for r in df.collect()) == [-1.0, 0.0, 1.0]


def test_processed_table_layout(spark):
    df = metrics.enrich_panel(spark.createDataFrame(
        [("gdp_annual", "DE", "Germany", 2000, "CP_MEUR", "B1GQ", None, None, 1500.0,
          dt.date(2024, 1, 2))],
        "dataset string, country_code string, country_name string, year int, unit string, "
        "indicator string, age_group string, sex string, value double, loaded_at date"))
    out = metrics.processed_table(df, "gdp_annual")
    assert out.columns == ["country_code", "country_name", "year", "unit", "indicator",
                           "gdp_meur", "loaded_at", "gdp_beur", "yoy_change", "yoy_growth_pct",
                           "z_score", "reference_date"]
    assert out.select(F.col("gdp_beur")).first()[0] == 1.5


def test_series_stats_match_sample_statistics_and_ignore_order(spark):
    import statistics
    vals = [3.1, 0.7, 12.25, 5.5, 8.0, 1.05, 9.9]
    rows = [("g", "DE", 2000 + i, v) for i, v in enumerate(vals)] + [("g", "FR", 2000, 4.0)]
    a = {r["country_code"]: (r["mean"], r["std_dev"]) for r in
         _stats(_panel(spark, rows)).collect()}
    b = {r["country_code"]: (r["mean"], r["std_dev"]) for r in
         _stats(_panel(spark, list(reversed(rows))).repartition(3)).collect()}
    assert a == b  # bit-identical whatever the row order / partitioning
    assert abs(a["DE"][0] - statistics.mean(vals)) < 1e-12
    assert abs(a["DE"][1] - statistics.stdev(vals)) < 1e-12
    assert a["FR"] == (4.0, None)  # one value: no sample stddev


def test_fixed_mean_is_exact_for_fixed_point_values(spark):
    from paneltide.functions.columns import fixed_mean
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,), (None,)], "x double")
    assert df.agg(fixed_mean("x", 1)).first()[0] == 0.2
    assert df.repartition(3).agg(fixed_mean("x", 1)).first()[0] == 0.2


def test_strict_year_differs_from_the_row_before_in_gap_years(spark):
    from paneltide.operators.metrics import yoy, yoy_strict
    rows = [("d", "DE", 2000, 10.0), ("d", "DE", 2001, 15.0), ("d", "DE", 2004, 30.0), ("d", "DE", 2005, 0.0), ("d", "DE", 2006, 4.0),
            ("d", "FR", 2001, 1.0)]
    df = spark.createDataFrame(rows, "dataset string, country_code string, year int, value double")
    out = df.select("country_code", "year", *[c.alias(n) for n, c in {**yoy(), **yoy_strict()}.items()]).collect()
    got = {(r["country_code"], r["year"]): (r["yoy_change"], r["strict_change"], r["strict_growth_pct"]) for r in out}
    assert got == {("DE", 2000): (None, None, None), ("DE", 2001): (5.0, 5.0, 50.0), ("DE", 2004): (15.0, None, None),
                   ("DE", 2005): (-30.0, -30.0, -100.0), ("DE", 2006): (4.0, 4.0, None), ("FR", 2001): (None, None, None)}
