"""Event-driven anomaly detection (R12, J8, S12, S13): each micro-batch of
ingestion-completed events selects landed tables; only those are read, their
anomalies are appended to the alert table and published as messages."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paneltide.operators.anomalies import (ALERT_COLUMNS, INGESTION_EVENT_SCHEMA, alert_messages,
                                           detect_panel_anomalies, dispatch)
from paneltide.params import Params
from paneltide.sources.adapters import SourceSpec, read_source_or_empty
from paneltide.sources.sinks import MessageSink, write_batch

OUTPUT_COLUMNS = ["request"] + ALERT_COLUMNS
ALERT_SCHEMA = ("request string, dataset string, country_code string, year int, value double, z_score double, "
                "mean double, std_dev double, severity string, detected_at timestamp_ntz, batch_id bigint")

Landed = Callable[[list[str]], DataFrame]      # table names -> their rows


def requests_of(events: DataFrame) -> DataFrame:
    """(request, dataset) for every table that an event selects."""
    request = F.from_json("value", INGESTION_EVENT_SCHEMA)["dataset"]
    return dispatch(events.select(request.alias("request")), "request") \
        .select("request", F.col("table").alias("dataset"))


def detections_for(requests: DataFrame, landed: Landed, params: Params | None = None) -> DataFrame | None:
    """Alerts of the requested tables, one copy per request; None without any. At
    most one name per table of the fixed set reaches the driver. Without ``params`` the
    alerts are stamped with this call's time, so those of a job that runs for weeks have
    the time of their micro-batch."""
    params = params or Params()
    names = sorted(r["dataset"] for r in requests.select("dataset").distinct().collect())
    if not names:
        return None
    alerts = detect_panel_anomalies(landed(names), params)
    return alerts.join(requests, "dataset").select(*OUTPUT_COLUMNS)


def start_event_driven(stream: DataFrame, landed: Landed, sink: str, checkpoint: str, params: Params | None = None,
                       messages: MessageSink | None = None, trigger: dict | None = None):
    def handle(events: DataFrame, batch_id: int) -> None:
        found = detections_for(requests_of(events), landed, params)
        if found is None:
            return
        write_batch(found, sink, batch_id)
        if messages is not None:       # publish what the table now holds of this batch
            stored = found.sparkSession.read.schema(StructType.fromDDL(ALERT_SCHEMA)).parquet(sink)
            messages.publish(alert_messages(stored.filter(F.col("batch_id") == batch_id)), batch_id)

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "60 seconds"})).start())


def alert_history(spark: SparkSession, sink: str) -> DataFrame:
    """All alerts appended so far; empty before the first."""
    return read_source_or_empty(spark, SourceSpec("parquet", sink, schema=StructType.fromDDL(ALERT_SCHEMA))) \
        .select(*OUTPUT_COLUMNS)


def run_event_driven(spark: SparkSession, stream: DataFrame, landed: Landed, sink: str, checkpoint: str,
                     params: Params, messages: MessageSink | None = None) -> DataFrame:
    """Process what is there now and return the alert history."""
    start_event_driven(stream, landed, sink, checkpoint, params, messages,
                       {"availableNow": True}).awaitTermination()
    return alert_history(spark, sink)
