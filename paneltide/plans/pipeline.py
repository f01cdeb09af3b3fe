"""The full batch DAG written as tables (the reference's batch job, SQL
models, data tests and detector in one Spark application).

usage: python -m paneltide.plans.pipeline <input_dir> <output_dir> [<landed_dir> [<events_dir>]]

With ``landed_dir`` the run starts from landed tables (one folder per dataset),
else from the driver tables. Tables are full refreshes (overwrite), except
``anomaly_alerts``, to which every run appends. Landed tables get a directory per
load date and are clustered by country and year, marts a directory per
reference_year clustered by country; the latest snapshot is clustered only. The
landed panel is tiny next to the fact tables it is derived from, so it is
materialised once (checkpoint to the shared checkpoint dir) and every table
reads that copy.
"""
from __future__ import annotations

import sys
from functools import partial

from pyspark.sql import Observation, SparkSession

from paneltide.functions import constants as K
from paneltide.operators import completion, quality
from paneltide.params import Params
from paneltide.plans.run import PanelRun
from paneltide.sources import sinks
from paneltide.sources.adapters import SourceRegistry, SourceSpec
from paneltide.sources.sinks import MessageSink
from paneltide.sources.testdata import raw_table


def landed_registry(spark: SparkSession, folder: str) -> SourceRegistry:
    return SourceRegistry(spark, {n: SourceSpec("parquet", f"{folder.rstrip('/')}/{n}") for n in K.DATASETS})


def run_batch(spark: SparkSession, base: str, out: str, params: Params | None = None,
              counts: dict | None = None, landed: SourceRegistry | None = None,
              messages: MessageSink | None = None) -> list[str]:
    """Write every table; ``counts`` (if given) receives the rows written per
    table, observed during the write itself (no second scan). Without ``params``
    the run has the default parameters and stamps its rows with its own start. With
    ``messages`` every landed table's completion event is published once the table is
    there, and one for all of them at the end of the run."""
    source = PanelRun(spark, base, params or Params(), landed)
    r = source.materialised()
    written = []

    def put(name, df, partition=None, clustered=None, append=False, observed=None):
        path = f"{out.rstrip('/')}/{name}"
        seen = Observation(name)
        obs = partial(observed, observation=seen) if observed else seen
        if append:
            sinks.append(df, path, observation=obs)
        elif partition:
            sinks.write_partitioned(df, path, partition, clustered, observation=obs)
        elif clustered:
            sinks.write_clustered(df, path, clustered, observation=obs)
        else:
            sinks.write_overwrite(df, path, observation=obs)
        written.append(name)
        if counts is not None:
            counts[name] = seen.get["record_count" if observed else "rows"]
        return seen

    events, stamp = [], r.params.detected_at.isoformat()
    run = int(r.params.detected_at.timestamp() * 1_000_000)
    for i, ds in enumerate(K.DATASETS):
        seen = put(ds, raw_table(r.raw(ds), ds), "loaded_at", ["country_code", "year"], observed=completion.counted)
        events.append(completion.event(ds, seen.get, stamp))
        if messages is not None:
            completion.publish(spark, events[-1:], messages, run + i)
        put(f"{ds}_processed", r.processed(ds))
    put("combined_indicators", r.combined())
    put("int_country_indicators", r.indicators())
    put("int_yoy_deltas", r.deltas())
    for name, mart in (("mart_gdp_trends", r.mart_gdp()), ("mart_unemployment_comparison", r.mart_unemployment()),
                       ("mart_energy_intensity", r.mart_energy()), ("mart_composite_economic_index", r.composite())):
        put(name, mart, "reference_year", ["country_code"])
    put("mart_country_latest", r.mart_latest(), clustered=["country_code"])
    put("anomaly_alerts", r.panel_alerts() if landed is not None else r.alert_table(), append=True)
    put("dq_report", quality.dq_report(r.raw(), r.staged(), r.scored(), r.mart_latest(), r.params.score_year_min))
    if messages is not None:
        completion.publish(spark, [completion.pipeline_event(events, stamp)], messages, run + len(events))
    return written


if __name__ == "__main__":
    from paneltide.session import build_session
    session = build_session()
    print(run_batch(session, sys.argv[1], sys.argv[2],
                    landed=landed_registry(session, sys.argv[3]) if len(sys.argv) > 3 else None,
                    messages=MessageSink(sys.argv[4]) if len(sys.argv) > 4 else None))
