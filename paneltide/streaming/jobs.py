"""Stream jobs by configuration: source, sink, trigger and checkpoint.

usage: python -m paneltide.streaming.jobs window_summary|alert_records|event_driven
         (--files DIR | --servers HOST:PORT --topic NAME) --sink DIR --checkpoint DIR
         [--from earliest|latest] [--group ID] [--every "60 seconds" | --once] [--per-trigger N]
         [--landed DIR] [--messages DIR | --message-topic NAME] [--message-servers HOST:PORT] [--unique]

A new job starts at the offsets of STARTS unless told otherwise: the summary at what comes
next, the others at the earliest message. A restarted one goes on from its checkpoint.
"""
from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from paneltide.functions import constants as K
from paneltide.sources.sinks import MessageSink
from paneltide.streaming import alert_records, event_driven, window_summary
from paneltide.streaming.sources import file_stream, kafka_stream


STARTS = {"window_summary": "latest", "alert_records": "earliest", "event_driven": "earliest"}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="paneltide.streaming.jobs")
    p.add_argument("job", choices=["window_summary", "alert_records", "event_driven"])
    p.add_argument("--files")
    p.add_argument("--servers")
    p.add_argument("--topic")
    p.add_argument("--sink", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--every", default=K.TRIGGER)
    p.add_argument("--once", action="store_true")
    p.add_argument("--per-trigger", type=int)
    p.add_argument("--landed", help="folder of landed tables, one per dataset")
    p.add_argument("--messages")
    p.add_argument("--message-topic")
    p.add_argument("--message-servers")
    p.add_argument("--from", dest="offsets", choices=["earliest", "latest"])
    p.add_argument("--group")
    p.add_argument("--unique", action="store_true", help="alert_records: drop repeated records")
    return p


def start(spark: SparkSession, argv: list[str]):
    """Start the configured job and return its query."""
    a = parser().parse_args(argv)
    if bool(a.files) == bool(a.servers):
        raise ValueError("give either --files or --servers")
    stream = file_stream(spark, a.files, a.per_trigger) if a.files else \
        kafka_stream(spark, a.servers, a.topic, starting_offsets=a.offsets or STARTS[a.job],
                     group_id=a.group or f"paneltide-{a.job}", max_offsets_per_trigger=a.per_trigger)
    trigger = {"availableNow": True} if a.once else {"processingTime": a.every}
    if a.job == "window_summary":
        return window_summary.start_window_summary(stream, a.sink, a.checkpoint, trigger)
    if a.job == "alert_records":
        start_records = alert_records.start_unique_records if a.unique else alert_records.start_alert_records
        return start_records(stream, a.sink, a.checkpoint, trigger=trigger)
    if not a.landed:
        raise ValueError("event_driven needs --landed")
    return event_driven.start_event_driven(stream, landed_tables(spark, a.landed), a.sink, a.checkpoint,
                                           messages=message_target(a), trigger=trigger)


def message_target(a: argparse.Namespace) -> MessageSink | None:
    """Where alerts are published, if anywhere."""
    if not a.message_topic:
        return MessageSink(a.messages) if a.messages else None
    servers = a.message_servers or a.servers
    if not servers:
        raise ValueError("--message-topic needs --message-servers or --servers")
    return MessageSink(a.message_topic, "kafka", {"kafka.bootstrap.servers": servers})


def landed_tables(spark: SparkSession, folder: str) -> event_driven.Landed:
    """Rows of the landed panel under ``folder`` (partitioned by dataset): reading
    names prunes the other tables."""
    def read(names: list[str]):
        return spark.read.parquet(folder).filter(F.col("dataset").isin(names))
    return read


if __name__ == "__main__":
    import sys

    from paneltide.session import build_session
    start(build_session(), sys.argv[1:]).awaitTermination()
