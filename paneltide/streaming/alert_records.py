"""Per-record alert stream (R9, R10, F16, F22, P25, S11): parse each message,
drop malformed / non-object / code-less records, stamp ``processed_at``
unless present, append to a file table (exactly-once file sink)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from paneltide.functions import constants as K
from paneltide.sources import sinks

RECORD_FIELDS = ["dataset", "country_code", "year", "value", "z_score", "severity",
                 "detected_at", "processed_at"]
# every field is read as text and converted with try_cast, so a record with a
# mistyped field is kept (with a NULL) instead of being flagged corrupt
RECORD_SCHEMA = StructType([StructField(f, StringType()) for f in RECORD_FIELDS]
                           + [StructField("_corrupt_record", StringType())])
RECORD_COLUMNS = RECORD_FIELDS
TABLE_SCHEMA = ("dataset string, country_code string, year int, value double, z_score double, severity string, "
                "detected_at timestamp_ntz, processed_at timestamp_ntz")


def parse_records(stream: DataFrame, processed_at=None) -> DataFrame:
    """Records of the messages. One without ``processed_at`` is stamped with the time of
    its micro-batch, or with ``processed_at`` where a run gives one."""
    stamp = F.current_timestamp() if processed_at is None else F.lit(processed_at)
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    rec = (stream.select(F.from_json(F.col("value"), RECORD_SCHEMA, opts).alias("r"))
           .select("r.*"))
    ok = (F.col("_corrupt_record").isNull() & F.col("country_code").isNotNull()
          & (F.col("country_code") != ""))
    ts = lambda c: F.col(c).try_cast("timestamp_ntz")
    return rec.filter(ok).select(
        "dataset", "country_code", F.col("year").try_cast("int").alias("year"),
        F.col("value").try_cast("double").alias("value"),
        F.col("z_score").try_cast("double").alias("z_score"), "severity",
        ts("detected_at").alias("detected_at"),
        F.coalesce(ts("processed_at"), stamp.cast("timestamp_ntz"))
        .alias("processed_at"))


def without_repeats(records: DataFrame, delay: str = K.OUT_OF_ORDERNESS) -> DataFrame:
    """Every record once, up to ``delay`` out of order (R10). A record's keys are kept as
    state until the watermark, the latest time seen less ``delay``, has passed its time;
    after that a copy comes too late and is dropped as such, so state holds the last
    ``delay`` of records whatever the stream's length. Records without a time count as
    of their micro-batch."""
    at = F.coalesce(F.col("detected_at"), F.col("processed_at")).cast("timestamp")
    keys = [c for c in RECORD_COLUMNS if c != "processed_at"]
    return records.withColumn("event_time", at).withWatermark("event_time", delay) \
        .dropDuplicatesWithinWatermark(keys).drop("event_time")


def batch_writer(path: str):
    """foreachBatch sink: a partition per micro-batch, so one that is run again after a
    crash replaces what it wrote."""
    def write(records: DataFrame, batch_id: int) -> None:
        sinks.write_batch(records, path, batch_id)
    return write


def start_unique_records(stream: DataFrame, sink: str, checkpoint: str, processed_at=None, trigger: dict | None = None,
                         delay: str = K.OUT_OF_ORDERNESS, writer=None):
    """The record stream without repeats; ``kept`` in its progress counts what was written."""
    kept = without_repeats(parse_records(stream, processed_at), delay).observe("kept", F.count(F.lit(1)).alias("rows"))
    return (kept.writeStream.outputMode("append").foreachBatch(writer or batch_writer(sink))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": K.TRIGGER})).start())


ACCOUNT_SCHEMA = "batch_id long, rows_in long, rows_late long, rows_kept long"


def accounting(query) -> list[tuple[int, int, int, int]]:
    """(batch, rows in, rows dropped as late, rows kept) of the query's micro-batches that
    read something, from its own progress."""
    out = []
    for p in query.recentProgress:
        if p.numInputRows:
            late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
            out.append((p.batchId, p.numInputRows, late, p.observedMetrics["kept"]["rows"]))
    return out


def start_alert_records(stream: DataFrame, sink: str, checkpoint: str, processed_at=None,
                        trigger: dict | None = None):
    """Start the stream; a micro-batch every ``K.TRIGGER`` unless given."""
    return (parse_records(stream, processed_at).writeStream.format("parquet")
            .option("path", sink).option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(**(trigger or {"processingTime": K.TRIGGER})).start())


def run_alert_records(spark: SparkSession, stream: DataFrame, sink: str, checkpoint: str,
                      processed_at=None) -> DataFrame:
    """Process what is there now and return the table."""
    start_alert_records(stream, sink, checkpoint, processed_at, {"availableNow": True}).awaitTermination()
    return spark.read.parquet(sink).select(*RECORD_COLUMNS)
