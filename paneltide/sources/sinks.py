"""Table sinks: overwrite, partitioned + clustered layout, CSV export."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _observed(df: DataFrame, observation) -> DataFrame:
    """Attach an Observation right below the write, above any exchange, so a
    range-sampling job does not count rows twice. A function is given the frame and
    attaches its own."""
    if observation is None:
        return df
    if callable(observation):
        return observation(df)
    return df.observe(observation, F.count(F.lit(1)).alias("rows"))


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet", observation=None) -> None:
    """Full refresh: the target is replaced (idempotent on retry)."""
    (_observed(df, observation).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").format(fmt).save(path))


def write_partitioned(df: DataFrame, path: str, partition_col: str,
                      cluster_cols: list[str] | None = None,
                      max_records_per_file: int = 5_000_000, observation=None) -> None:
    """Partition directories on ``partition_col`` and rows clustered by
    ``cluster_cols`` inside each file.

    A range exchange on (partition, cluster) keys gives balanced tasks even
    when one partition value holds most rows, and leaves every file sorted,
    so parquet min/max statistics skip row groups on the cluster keys.
    """
    keys = [partition_col] + list(cluster_cols or [])
    (_observed(df.repartitionByRange(*keys).sortWithinPartitions(*keys), observation)
     .write.mode("overwrite").option("partitionOverwriteMode", "static")
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(partition_col).parquet(path))


def write_clustered(df: DataFrame, path: str, cluster_cols: list[str],
                    observation=None) -> None:
    """Unpartitioned snapshot with rows clustered by ``cluster_cols``."""
    (_observed(df.repartitionByRange(*cluster_cols).sortWithinPartitions(*cluster_cols),
               observation)
     .write.mode("overwrite").parquet(path))


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def append(df: DataFrame, path: str, observation=None) -> None:
    """Append rows as they are (NULLs preserved); earlier rows stay."""
    _observed(df, observation).write.mode("append").parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet",
                partitions: tuple[str, ...] = ()) -> None:
    """One micro-batch as its own ``batch_id`` partition: other batches stay, and a
    retried batch replaces itself."""
    (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.format(fmt).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partitions, "batch_id").save(path))


@dataclass(frozen=True)
class MessageSink:
    """Where messages (one string column ``value``) are published: ``text`` files
    under ``target``, or topic ``target`` of a broker (``fmt="kafka"``, ``options``)."""
    target: str
    fmt: str = "text"
    options: dict = field(default_factory=dict)

    def publish(self, messages: DataFrame, batch_id: int) -> None:
        if self.fmt == "text":
            write_batch(messages.select("value"), self.target, batch_id, "text")
        else:
            messages.select("value").write.format(self.fmt).options(**self.options) \
                .option("topic", self.target).save()


def read_back(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(path).select(*[F.col(c) for c in columns])
