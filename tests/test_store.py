"""Stored marts, bucketed tables and names of the catalog: plans and contents."""
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from paneltide.sources import sinks
from paneltide.sources.adapters import SourceSpec
from paneltide.sources.store import Catalog, MartStore, at_latest_year


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["stored_gdp_trends", "stored_unemployment", "stored_energy", "stored_composite"])
def test_api_over_a_stored_mart_prunes_years_and_reads_no_facts(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    plan = _plan(df)
    assert re.search(r"PartitionFilters: \[[^\]]*reference_year#\d+ >= 1995", plan)
    assert re.search(r"PushedFilters: \[[^\]]*country_code", plan)
    assert plan.count("FileScan") == 1 and "Join" not in plan
    assert all("/mart_" in f for f in df.inputFiles())


def _years(spark, tmp_path):
    df = spark.createDataFrame([(y, c, float(y)) for y in (2000, 2001, 2002) for c in ("DE", "FR")],
                               "reference_year int, country_code string, v double")
    return MartStore(spark, str(tmp_path)).write("mart_gdp_trends", df).read("mart_gdp_trends", df.schema)


def test_the_latest_year_is_a_partition_filter(spark, tmp_path):
    latest = at_latest_year(_years(spark, tmp_path))
    assert re.search(r"PartitionFilters: \[[^\]]*reference_year#\d+ = [^\]]*[Ss]ubquery", _plan(latest))
    assert sorted((r["country_code"], r["v"]) for r in latest.collect()) == [("DE", 2002.0), ("FR", 2002.0)]


def test_a_mart_without_rows(spark, tmp_path):
    none = _years(spark, tmp_path).limit(0)
    store = MartStore(spark, str(tmp_path / "none")).write("mart_gdp_trends", none)
    assert at_latest_year(store.read("mart_gdp_trends", none.schema)).count() == 0


@pytest.mark.parametrize("key", ["bucketed_deltas", "bucketed_join"])
def test_no_exchange_over_bucketed_tables(spark, key):
    """Broadcasts are off, as the small test tables would be broadcast otherwise."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()[key](spark, SF_SMALL)
        assert "Exchange" not in _plan(df) and "Bucketed: true" in _plan(df)
        same = {"bucketed_deltas": "int_yoy_deltas", "bucketed_join": "int_country_indicators"}[key]
        want = E.queries()[same](spark, SF_SMALL)
        assert df.columns == want.columns
        assert sorted(map(str, df.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_views_follow_their_source_and_tables_do_not(spark, tmp_path):
    catalog, landed = Catalog(spark, str(tmp_path / "tables"), "t_views_"), str(tmp_path / "landed")
    load = lambda n: spark.range(n).select(F.col("id"), (F.col("id") % 2).alias("odd"))
    sinks.append(load(4), landed)
    src = catalog.source("src", SourceSpec("parquet", landed))
    catalog.view("odd", f"SELECT id FROM {src} WHERE odd = 1")
    catalog.table("kept", f"SELECT * FROM {catalog.name('odd')}")
    sinks.append(load(6), landed)
    assert catalog.refreshed("odd").count() == 5 and catalog.refreshed("kept").count() == 2
    earlier = spark.table("t_views_kept")
    catalog.table("kept", f"SELECT * FROM {catalog.name('odd')}", version=1)
    assert catalog.refreshed("kept").count() == 5
    assert earlier.count() == 2          # a reader of the version before goes on
