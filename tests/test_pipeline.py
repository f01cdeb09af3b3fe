"""The full batch DAG writes every table and the data tests pass."""
import datetime as dt
import os
import tempfile

from conftest import SF_SMALL
from paneltide.params import TEST_PARAMS, Params
from paneltide.plans.pipeline import landed_registry, run_batch
from paneltide.sources.adapters import SourceRegistry, SourceSpec


def test_run_batch_writes_all_tables(spark):
    out = tempfile.mkdtemp(prefix="pt-pipe-")
    counts = {}
    written = run_batch(spark, SF_SMALL, out, TEST_PARAMS, counts=counts)
    assert counts["dq_report"] == 31 and counts["mart_country_latest"] == 25
    assert "mart_composite_economic_index" in written and len(written) == 18
    reg = SourceRegistry(spark, {n: SourceSpec("parquet", f"{out}/{n}") for n in written})
    dq = reg.load("dq_report")
    assert dq.count() == 31
    assert dq.filter("failures > 0").count() == 0
    marts = reg.load("mart_composite_economic_index")
    assert "reference_year" in marts.columns and marts.count() > 0
    assert os.path.isdir(f"{out}/gdp_annual/loaded_at=2024-01-02")
    # a second run from the landed tables: the same marts, and alerts are appended
    alerts = reg.load("anomaly_alerts").count()
    again = tempfile.mkdtemp(prefix="pt-pipe-")
    run_batch(spark, SF_SMALL, again, TEST_PARAMS, counts=counts, landed=landed_registry(spark, out))
    run_batch(spark, SF_SMALL, out, TEST_PARAMS)
    assert reg.load("anomaly_alerts").count() == 2 * alerts
    for name in ("mart_composite_economic_index", "mart_country_latest", "mart_energy_intensity"):
        a, b = (spark.read.parquet(f"{d}/{name}") for d in (out, again))
        assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_a_run_stamps_its_own_time_and_follows_its_parameters(spark):
    today = dt.datetime.now(dt.timezone.utc).date()
    out = tempfile.mkdtemp(prefix="pt-pipe-")
    run_batch(spark, SF_SMALL, out, Params(year_min=1996, year_max=1998, score_year_min=1996))
    raw = spark.read.parquet(f"{out}/gdp_annual")
    assert raw.agg({"loaded_at": "max"}).first()[0] >= today
    years = spark.read.parquet(f"{out}/mart_gdp_trends").selectExpr("min(reference_year)", "max(reference_year)").first()
    assert tuple(years) == (1996, 1998)


def test_partitioned_full_refresh_drops_stale_partitions(spark, tmp_path):
    from paneltide.sources import sinks
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(2000, "DE", 1.0), (2001, "DE", 2.0)],
                              "reference_year int, country_code string, v double")
    sinks.write_partitioned(a, path, "reference_year", ["country_code"])
    sinks.write_partitioned(a.filter("reference_year = 2001"), path, "reference_year",
                            ["country_code"])
    assert [r["reference_year"] for r in spark.read.parquet(path).collect()] == [2001]
