"""Source adapters, the country dimension and the panel union."""

import pytest
from pyspark.sql import functions as F

from paneltide.operators.panel import union_panel
from paneltide.sources.adapters import SourceRegistry, SourceSpec, read_source_or_empty
from paneltide.sources.dimension import country_dimension, iso3_of_code, name_of_code


def test_missing_source_yields_empty_frame(spark, tmp_path):
    from paneltide.sources.tables import SCHEMAS
    spec = SourceSpec("parquet", str(tmp_path / "absent"), schema=SCHEMAS["nation"])
    df = read_source_or_empty(spark, spec)
    assert df.count() == 0 and df.columns == ["n_nationkey", "n_name", "n_regionkey"]


def test_other_faults_are_errors(spark, tmp_path):
    from paneltide.sources.tables import SCHEMAS
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_source_or_empty(spark, SourceSpec("parquet", str(bad), schema=SCHEMAS["nation"])).count()
    with pytest.raises(Exception):
        read_source_or_empty(spark, SourceSpec("no-such-format", str(bad), schema=SCHEMAS["nation"]))


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from paneltide.session import scratch_root

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session())


def test_registry_loads_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(path)
    reg = SourceRegistry(spark).register("things", SourceSpec("parquet", path))
    assert reg.load("things").first()["v"] == "a"


def test_country_dimension_and_lookups(spark):
    dim = country_dimension(spark)
    assert dim.count() == 27
    el = dim.filter("country_code = 'EL'").first()
    assert (el["iso2"], el["iso3"], el["country_name"]) == ("GR", "GRC", "Greece")
    df = spark.createDataFrame([("EL",), ("XX",)], "c string")
    out = df.select(name_of_code(F.col("c")).alias("n"), iso3_of_code(F.col("c")).alias("i"))
    assert [tuple(r) for r in out.collect()] == [("Greece", "GRC"), (None, None)]


def test_union_panel_adds_dataset_and_fills_missing(spark):
    gdp = spark.createDataFrame([("DE", 2000, 1.0, "B1GQ")],
                                "country_code string, year int, value double, indicator string")
    unem = spark.createDataFrame([("DE", 2000, 5.0, "Y15-74")],
                                 "country_code string, year int, value double, age_group string")
    out = union_panel({"gdp_annual": gdp, "unemployment_annual": unem}).collect()
    got = {r["dataset"]: (r["indicator"], r["age_group"]) for r in out}
    assert got == {"gdp_annual": ("B1GQ", None), "unemployment_annual": (None, "Y15-74")}
