"""Session construction and the shared scratch location."""
from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. They are applied to new sessions only; an
# existing cluster session keeps what its operator configured, except for the
# session time zone, which output timestamps depend on.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "paneltide",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    conf.setdefault("spark.ui.enabled", "false")
    conf.setdefault("spark.driver.memory", os.environ.get("PANELTIDE_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    prepare(spark)
    return spark


RUNTIME_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime SQL settings results depend on (UTC for parsing zone-less
    timestamps, AQE with skew-join splitting) on any session, including one
    the caller built. Overwrite modes are chosen per write, never globally."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables: what the cluster
    names in ``spark.checkpoint.dir`` (or the context's checkpoint dir).

    Only a local master, where driver and executors are one process, gets a
    private directory when neither is set; on a cluster that is an error,
    since executors would write to their own disks.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="paneltide-ckpt-")
        sc.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh location in this application's folder under the shared root; the
    folder is deleted when the driver's JVM ends."""
    sc = spark.sparkContext
    app = f"{scratch_root(spark)}/paneltide-{sc.applicationId}"
    folder = sc._jvm.org.apache.hadoop.fs.Path(app)
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return f"{app}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint
    (written under the shared checkpoint dir; survives executor loss)."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)
