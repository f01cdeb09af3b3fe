"""Stream sources: a Kafka adapter by configuration and a file adapter used
offline. Both yield one string column ``value`` per message."""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(servers: str, topic: str, starting_offsets: str = "latest", group_id: str | None = None,
                  max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Reader options of a topic. ``starting_offsets`` counts for a new checkpoint only;
    a restarted query goes on from the offsets of its checkpoint."""
    if not servers or not topic:
        raise ValueError("a broker source needs servers and a topic")
    if starting_offsets not in ("earliest", "latest"):
        raise ValueError("starting offsets are earliest or latest")
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets}
    if group_id:
        options["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, **more) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **more)).load() \
        .select(F.col("value").cast("string").alias("value"))


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def micros(order: Column) -> Column:
    """A timestamp as whole microseconds."""
    return F.unix_micros(order.cast("timestamp"))


def even_cuts(messages: DataFrame, order_col: str, slices: int) -> list[int]:
    """Bounds that part the span of ``order_col`` evenly: one aggregate, two numbers."""
    span = messages.agg(F.min(micros(F.col(order_col))).alias("a"), F.max(micros(F.col(order_col))).alias("b")).first()
    if span["a"] is None:
        return []
    return [span["a"] + (span["b"] - span["a"]) // slices * i for i in range(1, slices)]


def in_slices(messages: DataFrame, path: str, at: Column, slices: int) -> Iterator[int]:
    """Append the messages (column ``value``) to ``path`` as text, slice after slice by
    the number ``at`` (null: the first), and give the slice's number once it is there. A
    stream run in between reads it as one micro-batch. A slice has as many files as its
    partitions: order matters between slices only."""
    numbered = messages.select("value", F.coalesce(at, F.lit(0)).cast("int").alias("_slice"))
    for i in range(slices):
        numbered.filter(F.col("_slice") == i).select("value").write.mode("append").text(path)
        yield i


def slice_of(order_col: str, cuts: list[int]) -> Column:
    """Number of the slice between ``cuts`` that a row's time falls into."""
    t = micros(F.col(order_col))
    return reduce(lambda n, c: n + F.when(t >= F.lit(c), 1).otherwise(0), cuts, F.lit(0))
