"""Marts that are stored, and read without their facts.

* ``MartStore``: marts as folders. The yearly ones have a directory per reference_year, so a
  range of years is a partition filter and the latest year a subquery on the partition
  column; files are sorted by country.
* ``Catalog``: declared sources and models by name in the session's catalog. A view is its
  definition and sees every later load; a table is what was stored when it was refreshed.
* bucketed tables: rows hashed and sorted by the keys when stored, so that joins and windows
  on these keys move no rows when the table is read.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paneltide.sources.adapters import SourceSpec, read_source
from paneltide.sources.sinks import write_clustered, write_partitioned

YEAR = "reference_year"
# names of the stored marts; the first four have a directory per year
YEARLY_MARTS = ("mart_gdp_trends", "mart_unemployment_comparison", "mart_energy_intensity",
                "mart_composite_economic_index")
LATEST_MART = "mart_country_latest"


def at_latest_year(stored: DataFrame, year: str = YEAR) -> DataFrame:
    """Rows of the latest stored year: the year is a scalar subquery over the partition
    column, evaluated before the scan, which then opens that year's directory only."""
    return stored.where(F.col(year) == stored.agg(F.max(year)).scalar())


@dataclass(frozen=True)
class MartStore:
    """Stored marts below ``folder``, by name."""
    spark: SparkSession
    folder: str

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def write(self, name: str, mart: DataFrame) -> "MartStore":
        """Replace one mart (full refresh)."""
        if name in YEARLY_MARTS:
            write_partitioned(mart, self.path(name), YEAR, ["country_code"])
        else:
            write_clustered(mart, self.path(name), ["country_code"])
        return self

    def read(self, name: str, schema: StructType | None = None) -> DataFrame:
        """A stored mart; with its ``schema`` no file is opened to find the columns, and a
        mart without rows can be read."""
        return read_source(self.spark, SourceSpec("parquet", self.path(name), schema=schema))


class Catalog:
    """Named views and tables of one session; ``prefix`` keeps runs apart. ``folder`` holds
    the tables' files, so no warehouse folder is needed. Names are case-insensitive."""

    def __init__(self, spark: SparkSession, folder: str, prefix: str = ""):
        self.spark, self.folder, self.prefix = spark, folder.rstrip("/"), prefix

    def name(self, model: str) -> str:
        return f"{self.prefix}{model}"

    def source(self, model: str, spec: SourceSpec) -> str:
        """Declare a source: a view on what the place of ``spec`` holds."""
        return self.view(model, read_source(self.spark, spec))

    def view(self, model: str, definition: DataFrame | str) -> str:
        """A model as a view: a frame, or SQL over other names of the catalog."""
        frame = self.spark.sql(definition) if isinstance(definition, str) else definition
        frame.createOrReplaceTempView(self.name(model))
        return self.name(model)

    def table(self, model: str, definition: DataFrame | str, buckets: int = 0,
              keys: tuple[str, ...] = (), version: int = 0) -> str:
        """A model as a stored table, replaced as a whole; with ``buckets`` hashed and sorted
        by ``keys``. Each ``version`` has its own folder, so readers of the one before go on.
        One task writes a bucket, so there is one file of each."""
        frame = self.spark.sql(definition) if isinstance(definition, str) else definition
        path = f"{self.folder}/{model}-{version}"
        if buckets:
            writer = frame.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
        else:
            writer = frame.write
        writer.format("parquet").mode("overwrite").option("path", path).saveAsTable(self.name(model))
        return self.name(model)

    def refreshed(self, model: str) -> DataFrame:
        """A name as it is now: files that were added since are listed anew."""
        self.spark.catalog.refreshTable(self.name(model))
        return self.spark.table(self.name(model))

