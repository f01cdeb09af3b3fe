"""Staging filters and dedupe edge rows."""
import datetime as dt

from paneltide.operators import panel, staging
from paneltide.params import Params

COLS = ("dataset string, country_code string, country_name string, year int, unit string, "
        "indicator string, age_group string, sex string, value double, loaded_at date")
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
P = Params(year_min=2000, year_max=2030)


def row(ds="gdp_annual", code="DE", year=2010, value=1.0, loaded=D2, unit="U", age=None, sex=None):
    return (ds, code, "Germany", year, unit, None, age, sex, value, loaded)


def stage(spark, rows, params=P, **kw):
    return staging.stage_panel(spark.createDataFrame(rows, COLS), params, **kw)


def test_newest_load_wins(spark):
    out = stage(spark, [row(value=1.0, loaded=D1), row(value=2.0, loaded=D2)]).collect()
    assert [r["value"] for r in out] == [2.0]


def test_same_day_tie_breaks_on_value_then_unit(spark):
    out = stage(spark, [row(value=1.0), row(value=3.0), row(value=3.0, unit="A")]).collect()
    assert [(r["value"], r["unit"]) for r in out] == [(3.0, "A")]


def test_inflation_dedupe_default_and_fan_out(spark):
    rows = [row("gdp_annual"), row("inflation_annual", value=1.0, loaded=D1),
            row("inflation_annual", value=2.0, loaded=D2)]
    staged = stage(spark, rows)
    assert staged.filter("dataset = 'inflation_annual'").count() == 1
    raw = stage(spark, rows, params=P.with_(dedupe_inflation=False))
    assert raw.filter("dataset = 'inflation_annual'").count() == 2
    wide = panel.country_indicators_by_join(raw)
    assert wide.count() == 2  # the reference's fan-out


def test_padded_code_is_trimmed_before_dedupe(spark):
    out = stage(spark, [row(code=" DE ", loaded=D1, value=1.0),
                        row(code="DE\t", loaded=D2, value=2.0)]).collect()
    assert [(r["country_code"], r["value"]) for r in out] == [("DE", 2.0)]


def test_year_bounds_inclusive(spark):
    out = stage(spark, [row(year=y) for y in (1999, 2000, 2030, 2031)]).collect()
    assert sorted(r["reference_year"] for r in out) == [2000, 2030]


def test_unemployment_slice(spark):
    rows = [row("unemployment_annual", age="Y15-74", sex="T", value=5.0),
            row("unemployment_annual", age="TOTAL", sex="T", year=2011),
            row("unemployment_annual", age="Y15-74", sex="M", year=2012)]
    out = stage(spark, rows).collect()
    assert [r["value"] for r in out] == [5.0]


def test_null_value_dropped(spark):
    assert stage(spark, [row(value=None)]).count() == 0


def test_right_table_only_not_in_wide(spark):
    staged = stage(spark, [row("gdp_annual", year=2010), row("energy_intensity", year=2011)])
    wide = panel.country_indicators(staged).collect()
    assert [(r["reference_year"], r["energy_intensity"]) for r in wide] == [(2010, None)]


def test_conditional_aggregation_equals_join_chain(spark):
    rows = [row(ds, year=y, value=float(i * 10 + y))
            for i, ds in enumerate(["gdp_annual", "unemployment_annual", "energy_intensity",
                                    "inflation_annual"]) for y in (2010, 2011)]
    rows = [r if r[0] != "unemployment_annual" else r[:6] + ("Y15-74", "T") + r[8:] for r in rows]
    staged = stage(spark, rows)
    a = sorted(tuple(r) for r in panel.country_indicators(staged).collect())
    b = sorted(tuple(r) for r in panel.country_indicators_by_join(staged).collect())
    assert a == b and len(a) == 2
