"""Completion events of landed tables (S14, A12): what a write itself has counted becomes
the message that tells readers of the table, published after the commit."""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from paneltide.functions import constants as K
from paneltide.sources.sinks import MessageSink

EVENT_SCHEMA = "dataset string, record_count bigint, countries array<string>, " \
               "year_range struct<start:int,end:int>, timestamp string, status string"


def counted(table: DataFrame, observation: Observation) -> DataFrame:
    """``table`` with what its event needs observed as it is written: no second scan. The
    countries are those of the fixed dimension, the only collection kept."""
    return table.observe(observation, F.count(F.lit(1)).alias("record_count"),
                         F.array_sort(F.collect_set("country_code")).alias("countries"),
                         F.min("year").alias("start"), F.max("year").alias("end"))


def event(dataset: str, seen: dict, stamp: str) -> tuple:
    """The event of one written table from its observation."""
    return (dataset, seen["record_count"], list(seen["countries"]), (seen["start"], seen["end"]), stamp, "completed")


def pipeline_event(events: list[tuple], stamp: str) -> tuple:
    """One event for all tables of a run."""
    years = [y for e in events for y in e[3] if y is not None]
    return (K.FULL_PIPELINE_EVENT, sum(e[1] for e in events), sorted({c for e in events for c in e[2]}),
            (min(years, default=None), max(years, default=None)), stamp, "completed")


def publish(spark: SparkSession, events: list[tuple], target: MessageSink, run: int) -> None:
    """Send the events (a row per table) as JSON messages; a repeated ``run`` replaces its
    messages where the target is a folder."""
    frame = spark.createDataFrame(events, EVENT_SCHEMA)
    target.publish(frame.coalesce(1).select(F.to_json(F.struct(*frame.columns)).alias("value")), run)
