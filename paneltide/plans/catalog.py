"""The registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query rebuilds its plan from the driver tables (through ``PanelRun``),
so its work grows with the input. Streaming and sink queries run their job
to completion into a fresh location under the shared scratch root and
return the table they wrote.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paneltide.functions import constants as K
from paneltide.operators import anomalies, completion, landing, metrics, panel, quality, scoring, views
from paneltide.operators.running_stats import RunningDetector, deviation
from paneltide.params import TEST_PARAMS, Params
from paneltide.plans.run import PanelRun
from paneltide.session import materialize, scratch_path
from paneltide.sources import sinks, testdata
from paneltide.sources.adapters import SourceSpec, read_source_or_empty
from paneltide.sources.store import LATEST_MART, Catalog, MartStore, at_latest_year
from paneltide.streaming import alert_records, event_driven, window_summary
from paneltide.streaming.jobs import landed_tables
from paneltide.sources.testdata import raw_table
from paneltide.streaming.sources import even_cuts, file_stream, in_slices, slice_of

Query = Callable[[SparkSession, str], DataFrame]
GDP_WIDE_DIMS = {"unit": "CP_MEUR", "na_item": "B1GQ"}


def _run(spark: SparkSession, base: str, params: Params = TEST_PARAMS) -> PanelRun:
    """A fresh run: nothing is shared between queries."""
    return PanelRun(spark, base, params)


# --- landing -----------------------------------------------------------------
def land_unpivot(spark, base):
    r = _run(spark, base)
    years = list(range(r.params.year_min, r.params.year_max + 1))
    wide = landing.build_wide(r.raw(K.GDP), K.GDP, spark, GDP_WIDE_DIMS, years)
    return landing.unpivot_wide(wide, r.params.year_min, r.params.year_max, r.params.load_date)


def land_geo_filter(spark, base):
    return landing.geo_filter(land_unpivot(spark, base), spark, K.GDP)


def land_file_slice(spark, base):
    """A wide file on disk with a second unit and a second consumption group beside
    the wanted ones: landing reads it as text and keeps one row per country and year."""
    r = _run(spark, base)
    years = list(range(r.params.year_min, r.params.year_max + 1))
    wanted = {"unit": "RCH_A_AVG", "coicop": "CP00"}
    wide = landing.build_wide(r.raw(K.INFLATION), K.INFLATION, spark, wanted, years)
    other = wide.withColumn("unit", F.lit("INX_A_AVG")).unionByName(wide.withColumn("coicop", F.lit("CP01")))
    path = scratch_path(spark, "wide-file")
    sinks.export_csv(wide.unionByName(other), path)
    long = landing.unpivot_wide(landing.read_wide_csv(spark, path), r.params.year_min, r.params.year_max,
                                r.params.load_date)
    return landing.geo_filter(long, spark, K.INFLATION, {"coicop": "CP00"})


def _folder_of_headers(spark, base) -> tuple[DataFrame, DataFrame]:
    """Land a folder whose files have other years, dimensions and column orders: the years
    to 1997, the odd and the even ones after, as three deliveries."""
    r = _run(spark, base)
    years = list(range(r.params.year_min, r.params.year_max + 1))
    wide = materialize(landing.build_wide(r.raw(K.INFLATION), K.INFLATION, spark,
                                          {"unit": "RCH_A_AVG", "coicop": "CP00"}, years))
    path, dims = scratch_path(spark, "wide-folder"), [c for c in wide.columns if not c.isdigit()]
    deliveries = [dims + [str(y) for y in years if y <= 1997],
                  [str(y) for y in reversed(years) if y > 1997 and y % 2] + dims[::-1],
                  [landing.GEO_HEADER] + [str(y) for y in years if y > 1997 and not y % 2]]
    for columns in deliveries:
        wide.select(*[f"`{c}`" for c in columns]).write.mode("append").option("header", True).csv(path)
    return landing.land_folder(spark, path, K.INFLATION, r.params.year_min, r.params.year_max,
                               r.params.load_date, defaults={"coicop": "CP00"})


def land_file_headers(spark, base):
    return _folder_of_headers(spark, base)[0]


def land_rejects(spark, base):
    """Cells that are neither numbers nor marked as missing, without their files' names."""
    return _folder_of_headers(spark, base)[1].drop("file")


def raw_layout(spark, base):
    """A landed table in its raw layout (a directory per ``loaded_at``, clustered by
    country and year) with two loads; reading the newer load prunes the older."""
    r = _run(spark, base)
    path = scratch_path(spark, "raw-gdp")
    table = testdata.raw_table(r.raw_loads(K.GDP), K.GDP)
    sinks.write_partitioned(table, path, "loaded_at", ["country_code", "year"])
    back = spark.read.schema(table.schema).parquet(path)
    return back.filter(F.col("loaded_at") == F.lit(r.params.load_date)).select(*table.columns)


# --- staging -------------------------------------------------------------------
def _stg(dataset):
    def q(spark, base):
        return _run(spark, base).staged_view(dataset)
    return q


def stg_inflation_raw(spark, base):
    """The inflation view without dedupe (the reference's fan-out)."""
    r = _run(spark, base, TEST_PARAMS.with_(dedupe_inflation=False))
    return r.staged_view(K.INFLATION)


def dedupe_latest(spark, base):
    return _run(spark, base).staged()


# --- batch enrichment ------------------------------------------------------
def _processed(dataset):
    def q(spark, base):
        return _run(spark, base).processed(dataset)
    return q


def yoy_gap_years(spark, base):
    """Rows with a value only, so that series have gap years: the change against the row
    before beside the change against the calendar year before."""
    own = _run(spark, base).sliced().filter(F.col("value").isNotNull())
    measures = {**metrics.yoy(), **metrics.yoy_strict()}
    return own.select("dataset", "country_code", "year", "value", *[c.alias(n) for n, c in measures.items()])


def process_panel(spark, base):
    return _run(spark, base).enriched()


def combined_indicators(spark, base):
    return _run(spark, base).combined()


def panel_union(spark, base):
    return _run(spark, base).raw()


# --- models and marts -----------------------------------------------------
def int_country_indicators(spark, base):
    return _run(spark, base).indicators()


def int_yoy_deltas(spark, base):
    return _run(spark, base).deltas()


def composite_index(spark, base):
    return _run(spark, base).composite()


def mart_gdp_trends(spark, base):
    return _run(spark, base).mart_gdp()


def mart_unemployment(spark, base):
    return _run(spark, base).mart_unemployment()


def mart_energy(spark, base):
    return _run(spark, base).mart_energy()


def mart_country_latest(spark, base):
    return _run(spark, base).mart_latest()


# --- anomalies -------------------------------------------------------------
def anomaly_alerts(spark, base):
    return _run(spark, base).panel_alerts()


def event_alerts(spark, base):
    return _run(spark, base).event_alerts()


def alert_messages_json(spark, base):
    msgs = anomalies.alert_messages(_run(spark, base).panel_alerts())
    return anomalies.parse_alert_messages(msgs)


def ingestion_events(r: PanelRun) -> DataFrame:
    """One completion event per landed dataset plus the full-pipeline event,
    with real record counts, countries and year range."""
    raw = r.raw()
    stamp = r.params.load_date.isoformat() + "T00:00:00"

    def summary(df: DataFrame) -> list:
        return [F.count(F.lit(1)).alias("record_count"),
                F.array_sort(F.collect_set("country_code")).alias("countries"),
                F.struct(F.min("year").alias("start"), F.max("year").alias("end"))
                .alias("year_range")]

    # the small panel's groups and their grand total in one aggregate
    both = raw.rollup("dataset").agg(*summary(raw)).select(
        F.coalesce("dataset", F.lit(K.FULL_PIPELINE_EVENT)).alias("dataset"),
        "record_count", "countries", "year_range")
    return (both.withColumn("timestamp", F.lit(stamp)).withColumn("status", F.lit("completed")))


def ingestion_event_json(spark, base):
    ev = ingestion_events(_run(spark, base))
    js = ev.select(F.to_json(F.struct(*ev.columns)).alias("value"))
    return _decoded_events(js)


def _decoded_events(messages: DataFrame) -> DataFrame:
    p = messages.select(F.from_json("value", completion.EVENT_SCHEMA).alias("e")).select("e.*")
    return p.select("dataset", "record_count", F.array_join("countries", ",").alias("countries"),
                    F.col("year_range.start").alias("year_start"),
                    F.col("year_range.end").alias("year_end"), "timestamp", "status")


# --- read API ------------------------------------------------------------------
def _gdp(spark, base):
    r = _run(spark, base)
    return views.api_gdp_trends(r.mart_gdp(), r.params.api_start, r.params.api_end, r.params.countries)


def _unemployment(spark, base):
    r = _run(spark, base)
    return views.api_unemployment(r.mart_unemployment(), r.params.api_start, r.params.api_end,
                                  r.params.countries)


def _energy(spark, base):
    r = _run(spark, base)
    return views.api_energy(r.mart_energy(), r.params.api_start, r.params.api_end, r.params.countries)


def _composite(spark, base):
    r = _run(spark, base)
    return views.api_composite(r.composite(), r.params.api_start, r.params.api_end, r.params.countries)


def api_gdp_trends(spark, base):
    return views.in_api_order(_gdp(spark, base))


def api_unemployment(spark, base):
    return views.in_api_order(_unemployment(spark, base))


def api_energy(spark, base):
    return views.in_api_order(_energy(spark, base))


def api_composite(spark, base):
    return views.in_api_order(_composite(spark, base), composite=True)


def api_country_latest(spark, base):
    r = _run(spark, base)
    return views.api_country_latest(r.mart_latest(), r.params.countries)


def api_recent_alerts(spark, base):
    r = _run(spark, base)
    return views.api_recent_alerts(r.alert_table(), r.params.recent_alerts)


# --- the same answers from stored marts -----------------------------------------
def _stored(name: str, mart: Callable[[PanelRun], DataFrame]) -> Callable[..., DataFrame]:
    """Write one mart, then give what a reader finds there."""
    def read(spark, base):
        frame = mart(_run(spark, base))
        return MartStore(spark, scratch_path(spark, "marts")).write(name, frame).read(name, frame.schema)
    return read


_stored_gdp = _stored("mart_gdp_trends", PanelRun.mart_gdp)
_stored_unemployment = _stored("mart_unemployment_comparison", PanelRun.mart_unemployment)
_stored_energy = _stored("mart_energy_intensity", PanelRun.mart_energy)
_stored_composite = _stored("mart_composite_economic_index", PanelRun.composite)
_stored_latest = _stored(LATEST_MART, PanelRun.mart_latest)


def _range_of(p: Params = TEST_PARAMS) -> tuple:
    return p.api_start, p.api_end, p.countries


def stored_gdp_trends(spark, base):
    return views.in_api_order(views.api_gdp_trends(_stored_gdp(spark, base), *_range_of()))


def stored_unemployment(spark, base):
    return views.in_api_order(views.api_unemployment(_stored_unemployment(spark, base), *_range_of()))


def stored_energy(spark, base):
    return views.in_api_order(views.api_energy(_stored_energy(spark, base), *_range_of()))


def stored_composite(spark, base):
    return views.in_api_order(views.api_composite(_stored_composite(spark, base), *_range_of()), composite=True)


def stored_country_latest(spark, base):
    return views.api_country_latest(_stored_latest(spark, base), TEST_PARAMS.countries)


def stored_rank_gdp(spark, base):
    """The latest year's ranking: the year is found first, then its directory alone is read."""
    newest = at_latest_year(views.api_gdp_trends(_stored_gdp(spark, base), *_range_of()))
    return views.ranking(newest, ["gdp_beur", "gdp_yoy_growth_pct"])


BUCKETS = 8


def _catalog(spark) -> Catalog:
    return Catalog(spark, scratch_path(spark, "catalog"), f"panel_{uuid.uuid4().hex[:8]}_")


def bucketed_deltas(spark, base):
    """The staged panel as a table in buckets by country: neither the wide table nor the
    lags over it move a row."""
    catalog = _catalog(spark)
    staged = spark.table(catalog.table("staged", _run(spark, base).staged(), BUCKETS, ("country_code",)))
    return scoring.yoy_deltas(panel.country_indicators(staged))


def bucketed_join(spark, base):
    """Four staged tables in buckets by country and year, joined bucket by bucket."""
    catalog, r = _catalog(spark), _run(spark, base).materialised()
    keys = ("country_code", "reference_year")
    stored = {ds: spark.table(catalog.table(f"staged_{ds}", r.staged(ds), BUCKETS, keys)) for ds in K.DATASETS}
    return panel.join_sides(stored)


def catalog_views_tables(spark, base):
    """A source, a view on it and a table made from the view by name; after a second load
    the view sees both loads, the table the one that it was made from."""
    r, catalog, landed = _run(spark, base), _catalog(spark), scratch_path(spark, "landed")
    loads = materialize(r.raw_loads(K.INFLATION))
    first = F.col("loaded_at") == F.lit(r.params.load_date)
    sinks.append(loads.filter(first), landed)
    source = catalog.source("raw_inflation", SourceSpec("parquet", landed, schema=loads.schema))
    view = catalog.view("stg_inflation", f"SELECT * FROM {source} WHERE value IS NOT NULL")
    catalog.table("mart_inflation", f"SELECT * FROM {view} WHERE year > 1995")
    sinks.append(loads.filter(~first), landed)
    return reduce(DataFrame.unionByName, [
        catalog.refreshed(name).groupBy("loaded_at").agg(
            F.count(F.lit(1)).alias("n_rows"), F.min("value").alias("low"), F.max("value").alias("high"))
        .select(F.lit(name).alias("name"), "loaded_at", "n_rows", "low", "high")
        for name in ("stg_inflation", "mart_inflation")])


# --- page datasets ---------------------------------------------------------
def _sel_latest(r: PanelRun) -> DataFrame:
    return r.countries_filter(r.mart_latest())


def home_kpis(spark, base):
    return views.home_kpis(_sel_latest(_run(spark, base)))


def home_map(spark, base):
    r = _run(spark, base)
    comp = views.api_composite(r.composite(), r.params.api_start, r.params.api_end)
    return views.home_map(comp, r.params.countries)


def home_ranking(spark, base):
    return views.home_ranking(_sel_latest(_run(spark, base)))


def _years(p: Params = TEST_PARAMS) -> list[int]:
    return list(range(p.api_start, p.api_end + 1))


def gdp_kpis(spark, base):
    return views.gdp_kpis(_gdp(spark, base))


def rank_gdp(spark, base):
    return views.ranking(views.latest_rows(_gdp(spark, base)),
                         ["gdp_beur", "gdp_yoy_growth_pct"])


def heatmap_gdp(spark, base):
    return views.heatmap(_gdp(spark, base), "gdp_yoy_growth_pct", _years())


def unemployment_kpis(spark, base):
    return views.unemployment_kpis(_unemployment(spark, base))


def heatmap_unemployment(spark, base):
    return views.heatmap(_unemployment(spark, base), "unemployment_rate", _years())


def rank_unemployment(spark, base):
    return views.ranking(views.latest_rows(_unemployment(spark, base)),
                         ["unemployment_rate", "unemp_yoy_change"])


def energy_kpis(spark, base):
    return views.energy_kpis(_energy(spark, base))


def energy_gdp_scatter(spark, base):
    return views.energy_gdp_scatter(_energy(spark, base), _gdp(spark, base))


def heatmap_energy(spark, base):
    return views.heatmap(_energy(spark, base), "energy_intensity", _years())


def rank_energy(spark, base):
    return views.ranking(views.latest_rows(_energy(spark, base)),
                         ["energy_intensity", "energy_yoy_improvement"])


def composite_kpis(spark, base):
    return views.composite_kpis(_composite(spark, base))


def composite_ranking(spark, base):
    return views.composite_ranking(_composite(spark, base))


def composite_tiers(spark, base):
    return views.composite_tiers(_composite(spark, base))


def composite_components(spark, base):
    return views.composite_components(_composite(spark, base))


# --- data quality ----------------------------------------------------------------
def dq_report_of(r: PanelRun) -> DataFrame:
    """All checks over one materialised copy of the landed panel."""
    m = r.materialised()
    return quality.dq_report(m.raw(), m.staged(), m.scored(), m.mart_latest(), m.params.score_year_min)


def dq_report(spark, base):
    return dq_report_of(_run(spark, base))


def dq_report_faulty(spark, base):
    """The same checks over tables with faults put in from the data: missing keys
    where a cell is missing, values out of range, unknown and repeated countries."""
    r = _run(spark, base).materialised()
    missing, ds = F.col("value").isNull(), F.col("dataset")
    raw = (r.raw().withColumn("country_code", F.when(~(missing & ds.isin(K.GDP, K.ENERGY)), F.col("country_code")))
           .withColumn("year", F.when(~(missing & ds.isin(K.UNEMPLOYMENT, K.INFLATION)), F.col("year"))))
    odd = F.col("reference_year") % 2 == 1
    staged = (r.staged().withColumn("value", F.when(ds == K.UNEMPLOYMENT, F.col("value") + 60).otherwise(F.col("value")))
              .withColumn("country_code", F.when((ds == K.GDP) & odd, F.concat("country_code", F.lit("?")))
                          .when((ds == K.GDP) | odd, F.col("country_code"))))
    scored = (r.scored().withColumn("country_code", F.when(F.col("inflation_rate").isNotNull(), F.col("country_code")))
              .withColumn("composite_score", F.col("composite_score") + 45)
              .withColumn("unemployment_rate", F.col("unemployment_rate") - 48))
    latest = r.mart_latest()
    latest = latest.unionByName(latest.filter(F.col("composite_score") > 50))
    return quality.dq_report(raw, staged, scored, latest, r.params.score_year_min)


def country_indicators_fanout(spark, base):
    """The literal LEFT-join chain on inflation that is not deduplicated: a country
    and year with two loads gives two rows."""
    return _run(spark, base, TEST_PARAMS.with_(dedupe_inflation=False)).indicators()


def anomaly_alerts_top3(spark, base):
    """Detection with a limit per table that the panel reaches."""
    return _run(spark, base, TEST_PARAMS.with_(top_k=3, z_threshold=1.2)).panel_alerts()


# --- streaming -----------------------------------------------------------------
SUMMARY_WINDOW = "10 days"


def _alert_messages_of(al: DataFrame) -> DataFrame:
    return al.select(F.col("detected_at").alias("_t"), F.to_json(F.struct(
        "dataset", "country_code", "year", F.coalesce("value", F.lit(0.0)).alias("value"),
        F.coalesce("z_score", F.lit(0.0)).alias("z_score"), "severity", "detected_at"),
        anomalies.JSON_OPTS).alias("value"))


def stream_window_summary(spark, base):
    """Four micro-batches in time order, so that windows are updated across batches,
    then the oldest alerts once more: by then the watermark has passed their
    windows and they must not count. The job folds the days that it has closed."""
    r = _run(spark, base)
    src, sink, checkpoint = (scratch_path(spark, n) for n in ("alerts-in", "alert-summary", "alert-summary-ckpt"))
    messages = materialize(_alert_messages_of(r.event_alerts()))
    cuts = even_cuts(messages, "_t", 4)
    at = slice_of("_t", cuts)
    again = messages.filter(at == 0).withColumn("at", F.lit(4))
    sent = messages.withColumn("at", at).unionByName(again)
    out = window_summary.current_summary(spark, sink)
    for _ in in_slices(sent, src, F.col("at"), 5):
        out = window_summary.run_window_summary(spark, file_stream(spark, src), sink, checkpoint, length=SUMMARY_WINDOW)
    return out


def _record_messages(r: PanelRun) -> DataFrame:
    """Alert messages (some already carrying processed_at) mixed with raw
    event payloads: objects without a country code, truncated JSON and JSON
    arrays, all derived from the events table."""
    al = r.event_alerts()
    processed = F.when(F.minute("detected_at") % 2 == 0,
                       F.col("detected_at") + F.expr("INTERVAL 1 SECOND"))
    body = F.struct("dataset", "country_code", "year", "value", "z_score", "severity",
                    "detected_at", processed.alias("processed_at"))
    good = al.select(F.col("detected_at").alias("_t"),
                     F.to_json(body, anomalies.JSON_OPTS).alias("value"))
    ev = r.events().select(F.col("ts").alias("_t"), "event_id", "props")
    junk = ev.select("_t", F.when(F.col("event_id") % 50 == 0,
                                  F.expr("substring(props, 1, length(props) - 1)"))
                     .when(F.col("event_id") % 50 == 1, F.concat(F.lit("["), "props", F.lit("]")))
                     .otherwise(F.col("props")).alias("value"))
    return good.unionByName(junk)


def stream_alert_records(spark, base):
    r = _run(spark, base)
    src, sink, checkpoint = (scratch_path(spark, n) for n in ("records-in", "alert-records", "alert-records-ckpt"))
    messages = _record_messages(r)
    out = spark.createDataFrame([], alert_records.TABLE_SCHEMA)
    for _ in in_slices(messages, src, slice_of("_t", even_cuts(messages, "_t", 4)), 4):
        out = alert_records.run_alert_records(spark, file_stream(spark, src), sink, checkpoint, r.params.processed_at)
    return out


def _repeated_records(r: PanelRun) -> DataFrame:
    """(value, at): records in four micro-batches by time, some twice in one batch, some
    again in the next one, and some of the first batch only in the third, when the
    watermark has passed them."""
    al = materialize(r.event_alerts().select("dataset", "country_code", "year", "value", "z_score", "severity", "detected_at"))
    n, kind = slice_of("detected_at", even_cuts(al, "detected_at", 4)), F.minute("detected_at") % 7
    at = F.when((kind == 0) & (n == 0), F.array(F.lit(2))).when((kind == 1) & (n < 3), F.array(n, n + 1)) \
        .when(kind == 2, F.array(n, n)).otherwise(F.array(n))
    return al.select(F.explode(at).alias("at"), F.to_json(F.struct(*al.columns), anomalies.JSON_OPTS).alias("value"))


def _unique_records(spark, base, crash_in: int | None = None) -> tuple[str, list[tuple]]:
    """Run the record stream without repeats, one micro-batch a start, each start going on
    from the checkpoint; in batch ``crash_in`` it stops once between write and commit.
    Returns the sink and the accounts of the batches that were committed."""
    r = _run(spark, base)
    src, sink, checkpoint = (scratch_path(spark, n) for n in ("unique-in", "unique-records", "unique-records-ckpt"))
    sent, accounts, crashes = _repeated_records(r), [], [crash_in]
    write = alert_records.batch_writer(sink)

    def write_or_stop(records: DataFrame, batch_id: int) -> None:
        write(records, batch_id)
        if crashes and crashes[0] == len(accounts):
            crashes.clear()
            raise RuntimeError("stopped between write and commit")

    for i in in_slices(sent, src, F.col("at"), 4):
        for _ in range(2):
            query = alert_records.start_unique_records(
                file_stream(spark, src), sink, checkpoint, r.params.processed_at, {"availableNow": True}, writer=write_or_stop)
            try:
                query.awaitTermination()
                break
            except StreamingQueryException:
                if i != crash_in or crashes:      # not the stop that was asked for
                    raise
        accounts += [(i, *a[1:]) for a in alert_records.accounting(query)] or [(i, 0, 0, 0)]
    return sink, accounts


def stream_unique_records(spark, base):
    """Repeated and late messages over several micro-batches: each record once."""
    sink, _ = _unique_records(spark, base)
    return sinks.read_back(spark, sink, alert_records.RECORD_COLUMNS)


def stream_restart(spark, base):
    """The same stream stopped after the write of its second batch and before its commit:
    that batch runs again and replaces what it wrote; state comes from the checkpoint."""
    sink, _ = _unique_records(spark, base, crash_in=1)
    return sinks.read_back(spark, sink, alert_records.RECORD_COLUMNS)


def stream_late_rows(spark, base):
    """What each micro-batch read, dropped as late and kept, from the stream's own progress."""
    return spark.createDataFrame(_unique_records(spark, base)[1], alert_records.ACCOUNT_SCHEMA)


def _event_driven(spark, base) -> tuple[DataFrame, str]:
    """Land the panel, then one ingestion event per micro-batch; returns the alert
    history and the folder of the published messages."""
    r = _run(spark, base)
    src, landed, out = (scratch_path(spark, n) for n in ("ingestion-in", "landed", "event-driven"))
    sinks.write_partitioned(r.sliced(), landed, "dataset", ["country_code", "year"])
    names = spark.createDataFrame([(n, i) for i, n in enumerate(r.params.ingestion_events)],
                                  "dataset string, _ord int")
    # requested names carry the matching dataset summary (zero rows -> zero count)
    evs = names.join(ingestion_events(r), "dataset", "left").select(
        "_ord", F.to_json(F.struct("dataset", F.coalesce("record_count", F.lit(0)).alias(
            "record_count"), "countries", "year_range", "timestamp",
            F.lit("completed").alias("status"))).alias("value"))
    alerts = event_driven.alert_history(spark, f"{out}/alerts")
    for _ in in_slices(materialize(evs), src, F.col("_ord"), len(r.params.ingestion_events)):
        alerts = event_driven.run_event_driven(
            spark, file_stream(spark, src), landed_tables(spark, landed), f"{out}/alerts", f"{out}/checkpoint",
            r.params, sinks.MessageSink(f"{out}/messages"))
    return alerts, f"{out}/messages"


def event_driven_anomalies(spark, base):
    return _event_driven(spark, base)[0]


def event_driven_messages(spark, base):
    """The alert messages that the same run publishes, read back and decoded."""
    spec = SourceSpec("text", _event_driven(spark, base)[1], schema=StructType.fromDDL("value string"))
    return anomalies.parse_alert_messages(read_source_or_empty(spark, spec))


def alerts_appended(spark, base):
    """Two detector runs append to one alert table."""
    path = scratch_path(spark, "anomaly-alerts")
    for datasets in ((K.GDP, K.UNEMPLOYMENT), (K.ENERGY, K.INFLATION, K.GDP)):
        sinks.append(_run(spark, base).panel_alerts(*datasets), path)
    return sinks.read_back(spark, path, anomalies.ALERT_COLUMNS)


RUNNING_LOADS = 3


def _loaded(rows: DataFrame, at: F.Column, keys: tuple[str, ...], params: Params) -> RunningDetector:
    """The rows added as loads 0, 1, 2, of which ``at`` gives the number."""
    detector = RunningDetector(scratch_path(rows.sparkSession, "running"), rows.schema, keys, params.z_threshold)
    for load in range(RUNNING_LOADS):
        detector.add(rows.filter(at == load), load)
    return detector


def running_alerts(spark, base):
    """The panel in three loads by year: after the third, the alerts of one full read,
    found by the moments of all loads."""
    r = _run(spark, base)
    rows = materialize(r.sliced().select("dataset", "country_code", "year", "value"))
    year = F.col("year")
    at = F.when(year <= 1996, 0).when(year <= 1998, 1).otherwise(2)
    found = _loaded(rows, at, metrics.SERIES, r.params).current(spark, RUNNING_LOADS - 1)
    return _six_places(anomalies.strongest(found, r.params))


def _six_places(alerts: DataFrame) -> DataFrame:
    """Statistics to six places: merged moments differ from a full read in the last digits."""
    return alerts.withColumns({c: F.round(c, 6) for c in ("z_score", "mean", "std_dev")})


def _event_loads(spark, base) -> RunningDetector:
    r = _run(spark, base)
    rows = r.events().select("event_id", "event_type", "ts", "value")
    return _loaded(rows, slice_of("ts", even_cuts(rows, "ts", RUNNING_LOADS)), ("event_type",), r.params)


def running_alerts_by_load(spark, base):
    """Events in three loads by time: the alerts of each load when it came in."""
    detector = _event_loads(spark, base)
    each = [detector.of_load(spark, load) for load in range(RUNNING_LOADS)]
    return _six_places(reduce(DataFrame.unionByName, each).withColumnRenamed("batch_id", "load"))


def running_moments(spark, base):
    """Count, mean and deviation of each event type through each of the three loads."""
    detector = _event_loads(spark, base)
    each = [detector.through(spark, load).select(
        F.lit(load).cast("long").alias("load"), "event_type", "n", F.round("mean", 6).alias("mean"),
        F.round(deviation(), 6).alias("std_dev"), "low", "high") for load in range(RUNNING_LOADS)]
    return reduce(DataFrame.unionByName, each)


def completion_events(spark, base):
    """Land the four tables; what each write counted is published after its commit, then
    one event for all of them. The messages are read back and decoded."""
    r = _run(spark, base).materialised()
    out = scratch_path(spark, "landing")
    stamp = r.params.load_date.isoformat() + "T00:00:00"
    target, events = sinks.MessageSink(f"{out}/events"), []
    for i, ds in enumerate(K.DATASETS):
        seen = Observation(ds)
        sinks.write_partitioned(raw_table(r.raw(ds), ds), f"{out}/{ds}", "loaded_at", ["country_code", "year"],
                                observation=partial(completion.counted, observation=seen))
        events.append(completion.event(ds, seen.get, stamp))
        completion.publish(spark, events[-1:], target, i)
    completion.publish(spark, [completion.pipeline_event(events, stamp)], target, len(events))
    return _decoded_events(spark.read.schema("value string").text(target.target))


# --- sinks and layout ------------------------------------------------------------
def sink_overwrite(spark, base):
    """A refresh over an earlier version with other rows: none of them stays."""
    combined = _run(spark, base).combined()
    path = scratch_path(spark, "combined")
    earlier = combined.withColumn("year", F.col("year") - 100).withColumn("gdp_beur", F.lit(-1.0))
    sinks.write_overwrite(earlier, path)
    sinks.write_overwrite(combined, path)
    return sinks.read_back(spark, path, combined.columns)


def layout_partitioned(spark, base):
    """Years of an earlier version go with a full refresh; a filter on the partition
    column reads the directories of the later years only."""
    composite = _run(spark, base).composite()
    path = scratch_path(spark, "composite-by-year")
    earlier = composite.withColumn("reference_year", F.col("reference_year") + 50)
    sinks.write_partitioned(earlier, path, "reference_year", ["country_code"])
    sinks.write_partitioned(composite, path, "reference_year", ["country_code"])
    return spark.read.parquet(path).filter(F.col("reference_year") >= LAYOUT_FROM).select(*composite.columns)


LAYOUT_FROM = 1998


def snapshot_clustered(spark, base):
    latest = _run(spark, base).mart_latest()
    path = scratch_path(spark, "country-latest")
    sinks.write_clustered(latest.withColumn("latest_year", F.col("latest_year") - 1), path, ["country_code"])
    sinks.write_clustered(latest, path, ["country_code"])
    return sinks.read_back(spark, path, latest.columns)


def csv_export(spark, base):
    df = api_gdp_trends(spark, base)
    path = scratch_path(spark, "gdp-csv")
    sinks.export_csv(df, path)
    return sinks.read_csv(spark, path, df.schema)


QUERIES: dict[str, Query] = {
    "land_unpivot": land_unpivot,
    "land_geo_filter": land_geo_filter,
    "stg_gdp": _stg(K.GDP),
    "stg_unemployment": _stg(K.UNEMPLOYMENT),
    "stg_energy": _stg(K.ENERGY),
    "stg_inflation": _stg(K.INFLATION),
    "stg_inflation_raw": stg_inflation_raw,
    "dedupe_latest": dedupe_latest,
    "panel_union": panel_union,
    "process_gdp": _processed(K.GDP),
    "process_unemployment": _processed(K.UNEMPLOYMENT),
    "process_energy": _processed(K.ENERGY),
    "process_inflation": _processed(K.INFLATION),
    "process_panel": process_panel,
    "yoy_gap_years": yoy_gap_years,
    "combined_indicators": combined_indicators,
    "int_country_indicators": int_country_indicators,
    "int_yoy_deltas": int_yoy_deltas,
    "composite_index": composite_index,
    "mart_gdp_trends": mart_gdp_trends,
    "mart_unemployment": mart_unemployment,
    "mart_energy": mart_energy,
    "mart_country_latest": mart_country_latest,
    "anomaly_alerts": anomaly_alerts,
    "event_alerts": event_alerts,
    "alert_messages_json": alert_messages_json,
    "ingestion_event_json": ingestion_event_json,
    "api_gdp_trends": api_gdp_trends,
    "api_unemployment": api_unemployment,
    "api_energy": api_energy,
    "api_composite": api_composite,
    "api_country_latest": api_country_latest,
    "api_recent_alerts": api_recent_alerts,
    "home_kpis": home_kpis,
    "home_map": home_map,
    "home_ranking": home_ranking,
    "gdp_kpis": gdp_kpis,
    "rank_gdp": rank_gdp,
    "heatmap_gdp": heatmap_gdp,
    "unemployment_kpis": unemployment_kpis,
    "heatmap_unemployment": heatmap_unemployment,
    "rank_unemployment": rank_unemployment,
    "energy_kpis": energy_kpis,
    "energy_gdp_scatter": energy_gdp_scatter,
    "heatmap_energy": heatmap_energy,
    "rank_energy": rank_energy,
    "composite_kpis": composite_kpis,
    "composite_ranking": composite_ranking,
    "composite_tiers": composite_tiers,
    "composite_components": composite_components,
    "dq_report": dq_report,
    "stream_window_summary": stream_window_summary,
    "stream_alert_records": stream_alert_records,
    "stream_unique_records": stream_unique_records,
    "stream_restart": stream_restart,
    "stream_late_rows": stream_late_rows,
    "completion_events": completion_events,
    "event_driven_anomalies": event_driven_anomalies,
    "sink_overwrite": sink_overwrite,
    "layout_partitioned": layout_partitioned,
    "snapshot_clustered": snapshot_clustered,
    "csv_export": csv_export,
    "land_file_slice": land_file_slice,
    "raw_layout": raw_layout,
    "country_indicators_fanout": country_indicators_fanout,
    "anomaly_alerts_top3": anomaly_alerts_top3,
    "alerts_appended": alerts_appended,
    "event_driven_messages": event_driven_messages,
    "dq_report_faulty": dq_report_faulty,
    "stored_gdp_trends": stored_gdp_trends,
    "stored_unemployment": stored_unemployment,
    "stored_energy": stored_energy,
    "stored_composite": stored_composite,
    "stored_country_latest": stored_country_latest,
    "stored_rank_gdp": stored_rank_gdp,
    "bucketed_deltas": bucketed_deltas,
    "bucketed_join": bucketed_join,
    "catalog_views_tables": catalog_views_tables,
    "land_file_headers": land_file_headers,
    "land_rejects": land_rejects,
    "running_alerts": running_alerts,
    "running_alerts_by_load": running_alerts_by_load,
    "running_moments": running_moments,
}
