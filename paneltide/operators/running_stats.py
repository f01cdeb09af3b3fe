"""Statistics that grow load by load, and detection on them.

Each load of rows is stored as its own partition. The moments of a series (count, mean,
sum of squared deviations, smallest and largest value) through a load are those through the
load before merged with the load's own, so that a detection reads the new load and one row
per series, however long the history is:

* ``of_load``: alerts of one load's rows, by the statistics through that load;
* ``current``: alerts of all rows by the statistics through a load, equal to one full read.
  Earlier rows are read again only in series whose extremes lie beyond the threshold now.

Rows and moments of a load replace themselves when the load is added again; the moments of
later loads must then be added again, in order. A load may be empty; NULL values count for
nothing, a series without any value has no statistics, and a NULL key is a series of its own.
Values that are NaN make their series' statistics NaN, and none of its rows an alert.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from paneltide.operators.metrics import z_score
from paneltide.sources.adapters import SourceSpec, read_source, read_source_or_empty
from paneltide.sources.sinks import write_batch, write_overwrite

MOMENTS = "n bigint, mean double, m2 double, low double, high double"


def moments(rows: DataFrame, keys: tuple[str, ...], value: str = "value") -> DataFrame:
    """One row per series with a value: a partial and a final aggregate."""
    v = F.col(value)
    return rows.groupBy(*keys).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"),
        F.min(v).alias("low"), F.max(v).alias("high")).filter(F.col("n") > 0)


def merge(before: DataFrame, more: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Moments of both together (one row per series in each): the squared deviations between
    the two means are added, so nothing cancels as it does in sums of squares."""
    n, pair = F.sum("n"), F.count(F.lit(1)) == 2
    gap = F.max("mean") - F.min("mean")
    between = F.when(pair, gap * gap * F.min("n") * F.max("n") / n).otherwise(F.lit(0.0))
    mean = F.when(pair, F.max_by("mean", "n") + (F.sum("mean") - 2 * F.max_by("mean", "n")) * F.min("n") / n) \
        .otherwise(F.max("mean"))
    return before.unionByName(more).groupBy(*keys).agg(
        n.alias("n"), mean.alias("mean"), (F.sum("m2") + between).alias("m2"),
        F.min("low").alias("low"), F.max("high").alias("high"))


def deviation() -> Column:
    """Sample standard deviation; NULL below two values."""
    return F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))


@dataclass(frozen=True)
class RunningDetector:
    """Loads, their moments and alerts under ``folder`` (shared by driver and executors).
    ``schema``: the columns of a row, ``keys``: those that name its series."""
    folder: str
    schema: StructType
    keys: tuple[str, ...]
    threshold: float
    value: str = "value"

    @property
    def _rows(self) -> str:
        return f"{self.folder.rstrip('/')}/rows"

    def _moments_path(self, load: int) -> str:
        return f"{self.folder.rstrip('/')}/moments-{load}"

    def rows(self, spark: SparkSession) -> DataFrame:
        schema = StructType(list(self.schema.fields)).add("batch_id", LongType())
        return read_source_or_empty(spark, SourceSpec("parquet", self._rows, schema=schema))

    def through(self, spark: SparkSession, load: int) -> DataFrame:
        """The moments through ``load``; an error if they were never added."""
        keys = [f for f in self.schema.fields if f.name in self.keys]
        schema = StructType(keys + StructType.fromDDL(MOMENTS).fields)
        return read_source(spark, SourceSpec("parquet", self._moments_path(load), schema=schema))

    def add(self, rows: DataFrame, load: int) -> None:
        """Store load number ``load`` (0, 1, 2, ...) and the moments through it; only the
        load itself and the moments before it are read."""
        spark = rows.sparkSession
        write_batch(rows.select(*self.schema.names), self._rows, load)
        own = moments(self.rows(spark).filter(F.col("batch_id") == load), self.keys, self.value)
        total = merge(self.through(spark, load - 1), own, self.keys) if load else own
        write_overwrite(total, self._moments_path(load))

    def _same_series(self, a: DataFrame, b: DataFrame) -> Column:
        return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in self.keys])

    def _scored(self, rows: DataFrame, stats: DataFrame) -> DataFrame:
        """Rows beyond the threshold with their series' mean, deviation and z-score."""
        series = stats.select(*self.keys, "mean", deviation().alias("std_dev"))
        z = z_score(F.col(self.value), F.col("mean"), F.col("std_dev"))
        return (rows.join(series, self._same_series(rows, series))
                .select(*[rows[c] for c in rows.columns], "mean", "std_dev").withColumn("z_score", z)
                .filter((F.abs("z_score") > self.threshold) & ~F.isnan("z_score")))

    def of_load(self, spark: SparkSession, load: int) -> DataFrame:
        return self._scored(self.rows(spark).filter(F.col("batch_id") == load), self.through(spark, load))

    def reopened(self, spark: SparkSession, load: int) -> DataFrame:
        """Series (their moments through ``load``) of which an earlier row is beyond the
        threshold now: the same z-score of the earlier extremes decides, and no row lies
        outside these."""
        if load == 0:
            return self.through(spark, 0).limit(0)
        now = self.through(spark, load)
        before = self.through(spark, load - 1).select(*self.keys, F.col("low").alias("_low"), F.col("high").alias("_high"))
        far = [z_score(F.col(c), F.col("mean"), deviation()) for c in ("_low", "_high")]
        return (now.join(before, self._same_series(now, before))
                .filter((far[0] < -self.threshold) | (far[1] > self.threshold))
                .select(*[now[c] for c in now.columns]))

    def current(self, spark: SparkSession, load: int) -> DataFrame:
        """Alerts of every row through ``load`` by the statistics through it."""
        earlier = self.rows(spark).filter(F.col("batch_id") < load)
        return self.of_load(spark, load).unionByName(self._scored(earlier, self.reopened(spark, load)))
