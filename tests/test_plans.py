"""Physical-plan properties the design relies on (checked on the initial
adaptive plan, before execution)."""
import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_scans_are_pruned_and_reduced_before_shuffle(spark):
    plan = _plan(E.queries()["panel_union"](spark, SF_SMALL))
    li = re.search(r"FileScan parquet \[([^\]]*)\].*lineitem", plan)
    assert li is not None
    cols = set(li.group(1).replace(" ", "").split(","))
    assert {c.split("#")[0] for c in cols} == {"l_suppkey", "l_quantity", "l_extendedprice",
                                               "l_discount", "l_shipdate"}


@pytest.mark.parametrize("key,absent", [
    *[(k, "lineitem") for k in ("stg_gdp", "stg_unemployment", "process_gdp", "process_unemployment",
                                "mart_gdp_trends", "mart_unemployment", "api_gdp_trends", "gdp_kpis",
                                "rank_unemployment", "heatmap_gdp", "land_unpivot")],
    *[(k, "orders") for k in ("stg_energy", "stg_inflation", "process_energy", "process_inflation")]])
def test_only_the_needed_facts_are_read(spark, key, absent):
    plan = _plan(E.queries()[key](spark, SF_SMALL))
    scans = re.findall(r"Location: \S+ [^\]]*?/(\w+)\.parquet", plan)
    assert scans and absent not in scans


@pytest.mark.parametrize("key", ["rank_gdp", "rank_energy", "energy_kpis", "unemployment_kpis", "composite_index",
                                 "ingestion_event_json", "dq_report"])
def test_facts_are_scanned_once(spark, key):
    plan = _plan(E.queries()[key](spark, SF_SMALL))
    scans = re.findall(r"Location: \S+ [^\]]*?/(\w+)\.parquet", plan)
    assert scans.count("orders") <= 1 and scans.count("lineitem") <= 1
    # no Expand copies fact rows: it stands above the first aggregate of the facts
    tree = plan.split("\n")
    for i, line in enumerate(tree):
        if re.search(r"\bExpand\b", line):
            below = "\n".join(tree[i + 1:])
            assert "HashAggregate" in below or "Scan" not in below


def test_no_array_of_a_series_and_no_nested_loops(spark):
    for key in ("process_panel", "anomaly_alerts", "combined_indicators", "unemployment_kpis", "energy_kpis",
                "home_map", "event_alerts"):
        plan = _plan(E.queries()[key](spark, SF_SMALL))
        assert "collect_list" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_latest_year_is_cut_in_each_task(spark):
    assert "WindowGroupLimit" in _plan(E.queries()["rank_gdp"](spark, SF_SMALL))


def test_dedupe_limits_before_the_shuffle(spark):
    plan = _plan(E.queries()["dedupe_latest"](spark, SF_SMALL))
    first_exchange = plan.rfind("Exchange hashpartitioning(dataset")
    partial = plan.rfind("WindowGroupLimit")
    assert first_exchange >= 0 and partial > first_exchange  # partial limit sits below it


def test_model_chain_shuffles_once_after_dedupe(spark):
    plan = _plan(E.queries()["int_yoy_deltas"](spark, SF_SMALL))
    # dedupe exchange + one country_code exchange serving the wide aggregate and the lag
    hp = re.findall(r"Exchange hashpartitioning\(([^,)]*)", plan)
    assert sum(1 for h in hp if h.startswith("country_code")) == 1
    assert "SortMergeJoin" not in plan


def test_top_k_and_recent_alerts_plans(spark):
    assert "WindowGroupLimit" in _plan(E.queries()["anomaly_alerts"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in _plan(E.queries()["api_recent_alerts"](spark, SF_SMALL))


def test_dimension_lookup_is_not_a_join(spark):
    plan = _plan(E.queries()["event_alerts"](spark, SF_SMALL))
    assert "element_at" in plan or "try_element_at" in plan
    assert plan.count("Join") == 1  # the statistics, one row per type


def test_partitioned_layout_prunes_on_year(spark, tmp_path):
    from pyspark.sql import functions as F

    from paneltide.sources import sinks
    df = spark.createDataFrame([(y, c, 1.0) for y in (2000, 2001, 2002) for c in ("DE", "FR")],
                               "reference_year int, country_code string, v double")
    path = str(tmp_path / "m")
    sinks.write_partitioned(df, path, "reference_year", ["country_code"])
    q = spark.read.parquet(path).filter((F.col("reference_year") >= 2001)
                                        & (F.col("country_code") == "DE"))
    plan = _plan(q)
    assert re.search(r"PartitionFilters: \[[^\]]*reference_year", plan)
    assert re.search(r"PushedFilters: \[[^\]]*country_code", plan)
    assert q.count() == 2
