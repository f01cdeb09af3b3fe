"""Anomaly detection, alert messages and event dispatch (A1, J3, R13, T4,
F10, F17, F23, J8)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)

from paneltide.functions import constants as K
from paneltide.functions.columns import severity
from paneltide.operators.metrics import series_stats, z_score
from paneltide.params import Params
from paneltide.sources.dimension import code_of_index

ALERT_COLUMNS = ["dataset", "country_code", "year", "value", "z_score", "mean", "std_dev",
                 "severity", "detected_at"]

# schema of one published alert message
ALERT_MESSAGE_SCHEMA = StructType([
    StructField("dataset", StringType()),
    StructField("country_code", StringType()),
    StructField("year", IntegerType()),
    StructField("value", DoubleType()),
    StructField("z_score", DoubleType()),
    StructField("severity", StringType()),
    StructField("detected_at", TimestampNTZType()),
])

INGESTION_EVENT_SCHEMA = StructType([
    StructField("dataset", StringType()),
    StructField("record_count", LongType()),
    StructField("countries", StringType()),
    StructField("year_range", StructType([StructField("start", IntegerType()),
                                          StructField("end", IntegerType())])),
    StructField("timestamp", StringType()),
    StructField("status", StringType()),
])

# Timestamps travel as ISO text with microseconds and no zone (session is UTC).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_OPTS = {"timestampFormat": TS_FORMAT, "timestampNTZFormat": TS_FORMAT}


def _finish(df: DataFrame, params: Params, detected_at: F.Column | None = None) -> DataFrame:
    det = detected_at if detected_at is not None else \
        F.lit(params.detected_at).cast("timestamp_ntz")
    return df.select("dataset", "country_code", F.col("year").cast("int").alias("year"),
                     "value", "z_score", "mean", "std_dev",
                     severity("z_score").alias("severity"), det.alias("detected_at"))


def detect_panel_anomalies(panel: DataFrame, params: Params,
                           keys: tuple[str, ...] = ("dataset", "country_code")) -> DataFrame:
    """|z| > threshold per series, the top-k by |z| per dataset.

    The top-k is ``row_number() <= k`` per dataset, planned as a
    WindowGroupLimit that keeps k rows per dataset per partition before the
    shuffle, so a dataset holding most rows never reaches one task whole.
    """
    base = panel.select("dataset", "country_code", "year", "value")
    scored = base.select("*", *[c.alias(n) for n, c in series_stats(keys).items()]) \
        .withColumn("z_score", z_score(F.col("value"), F.col("mean"), F.col("std_dev"))) \
        .filter(F.abs("z_score") > params.z_threshold)
    return strongest(scored, params)


def strongest(scored: DataFrame, params: Params) -> DataFrame:
    """The top-k of scored rows by |z| per dataset, as alerts."""
    rank = Window.partitionBy("dataset").orderBy(F.abs("z_score").desc(), F.col("country_code"),
                                                 F.col("year"))
    top = scored.withColumn("_rn", F.row_number().over(rank)).filter(F.col("_rn") <= params.top_k)
    return _finish(top, params)


def detect_event_anomalies(events: DataFrame, params: Params) -> DataFrame:
    """Alerts over raw events: z-score of ``value`` within its event type.

    Groups here are unbounded (an event type can hold a third of all rows), so
    the statistics are a partial+final aggregate, one row per type, joined back
    instead of a whole-group window; AQE broadcasts them by their measured size
    or else splits the hot type's partitions. Country = dimension entry
    ``user_id mod 25``.
    """
    ev = events.select("event_type", "user_id", "ts", "value")
    stats = ev.groupBy("event_type").agg(F.avg("value").alias("mean"),
                                         F.stddev("value").alias("std_dev"))
    scored = (ev.join(stats, "event_type")
              .withColumn("z_score", z_score(F.col("value"), F.col("mean"), F.col("std_dev")))
              .filter(F.abs("z_score") > params.z_threshold)
              .withColumn("country_code", code_of_index(F.pmod(F.col("user_id"), F.lit(25))))
              .filter(F.col("country_code").isNotNull())
              .withColumn("dataset", F.col("event_type"))
              .withColumn("year", F.year("ts")))
    return _finish(scored, params, F.col("ts").cast("timestamp_ntz"))


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Alert -> JSON message text (NULL value / z become 0, as published)."""
    msg = F.struct(F.col("dataset"), F.col("country_code"), F.col("year"),
                   F.coalesce(F.col("value"), F.lit(0.0)).alias("value"),
                   F.coalesce(F.col("z_score"), F.lit(0.0)).alias("z_score"),
                   F.col("severity"), F.col("detected_at"))
    return alerts.select(F.to_json(msg, JSON_OPTS).alias("value"))


def parse_alert_messages(messages: DataFrame, col: str = "value") -> DataFrame:
    return (messages.select(F.from_json(F.col(col), ALERT_MESSAGE_SCHEMA, JSON_OPTS).alias("m"))
            .select("m.*"))


def dispatch(events: DataFrame, dataset_col: str = "dataset") -> DataFrame:
    """Request -> tables: a name containing ``full_pipeline`` selects all
    tables, an exact table name selects itself, anything else nothing. The
    tables of a request are exploded from an array: no join."""
    c = F.col(dataset_col)
    own = F.when(c.isin(K.DATASETS), F.array(c))
    tables = F.when(c.contains(K.FULL_PIPELINE_MARKER), F.array(*map(F.lit, K.DATASETS))).otherwise(own)
    return events.select("*", F.explode(tables).alias("table"))
