"""Landing: wide statistic table -> long rows -> typed, filtered raw table
(S3, S4, P1-P9).

Year columns and the geo column are found from the schema at plan time;
the reshape itself is Spark's ``unpivot`` (an Expand, no shuffle).
"""
from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.functions import constants as K
from paneltide.functions.columns import strip_ws
from paneltide.sources.dimension import index_of_code, name_of_code

GEO_HEADER = "geo\\TIME_PERIOD"


def read_wide_csv(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    """A landed wide statistic file, or several with the same header: header row, every
    cell read as text (no schema inference, so ':' and flagged cells survive until
    coercion)."""
    return (spark.read.option("header", True).option("sep", sep)
            .option("inferSchema", False).csv(path))


def year_columns(columns: list[str], start: int, end: int) -> list[str]:
    """Names made only of digits whose value lies in [start, end]."""
    return [c for c in columns if str(c).isdigit() and start <= int(c) <= end]


def geo_column(columns: list[str]) -> str:
    """First column whose lower-cased name contains 'geo', else 'geo'."""
    for c in columns:
        if "geo" in c.lower():
            return c
    return "geo"


def unpivot_wide(wide: DataFrame, start: int, end: int, load_date) -> DataFrame:
    """Wide -> long: dims kept, one row per (dims, year); value coerced to a
    double (bad cells -> NULL); rows with NULL year or value dropped."""
    years = year_columns(wide.columns, start, end)
    dims = [c for c in wide.columns if c not in years]
    if not years:
        return (wide.select(*[F.col(f"`{d}`") for d in dims])
                .withColumn("year", F.lit(None).cast("int"))
                .withColumn("value", F.lit(None).cast("double"))
                .withColumn("loaded_at", F.lit(load_date)).where(F.lit(False)))
    long = wide.select(*[F.col(f"`{c}`").cast("string").alias(c) if c in years
                         else F.col(f"`{c}`") for c in wide.columns]) \
        .unpivot([F.col(f"`{d}`") for d in dims], [F.col(f"`{y}`") for y in years],
                 "year", "value")
    return (long.withColumn("year", F.col("year").try_cast("int"))
            .withColumn("value", strip_ws("value").try_cast("double"))
            .filter(F.col("year").isNotNull() & F.col("value").isNotNull())
            .withColumn("loaded_at", F.lit(load_date)))


# names that a wide file may give to the dimensions of an extraction slice
SLICE_COLUMNS = {"unit": ("unit",), "indicator": ("na_item", "coicop", "indicator"),
                 "age_group": ("age", "age_group"), "sex": ("sex",)}


def extraction_filter(long: DataFrame, dataset: str, extra: dict[str, str] | None = None) -> DataFrame:
    """Keep the rows of the dataset's extraction: every dimension that the file has
    must hold the wanted value (``extra``: more file columns, such as ``coicop``)."""
    wanted = {c: v for d, v in K.DATASET_SLICES[dataset].items() for c in SLICE_COLUMNS[d]
              if (d, c) != ("indicator", "coicop")} | (extra or {})
    for c, v in wanted.items():
        if c in long.columns:
            long = long.filter(strip_ws(F.col(f"`{c}`").cast("string")) == v)
    return long


def geo_filter(long: DataFrame, spark: SparkSession, dataset: str,
               defaults: dict[str, str] | None = None) -> DataFrame:
    """Keep the extraction slice, trim the geo code, keep known countries (fixed
    27-entry lookup), add the name and the dataset's constant columns."""
    geo = geo_column(long.columns)
    df = (extraction_filter(long, dataset, defaults).withColumn("country_code", strip_ws(F.col(f"`{geo}`")))
          .withColumn("country_name", name_of_code(F.col("country_code")))
          .filter(F.col("country_name").isNotNull()))
    spec = dict(K.DATASET_SLICES[dataset])
    spec.update(defaults or {})

    def col_or_default(name: str, default: str) -> F.Column:
        if name in df.columns:
            return F.coalesce(F.col(name).cast("string"), F.lit(default))
        return F.lit(default)

    out = [F.col("country_code"), F.col("country_name"), F.col("year").cast("int").alias("year")]
    if dataset == K.GDP:
        out += [col_or_default("unit", spec["unit"]).alias("unit"),
                F.lit(spec["indicator"]).alias("indicator")]
    elif dataset == K.UNEMPLOYMENT:
        out += [F.lit(spec["unit"]).alias("unit"),
                col_or_default("age", "TOTAL").alias("age_group"),
                col_or_default("sex", "T").alias("sex")]
    else:
        out += [F.lit(spec["unit"]).alias("unit")]
    out += [F.col("value"), F.col("loaded_at")]
    return df.select(*out)


# cells that say "no value", which is no fault of a file
MISSING_CELLS = ("", ":")


def header_groups(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Header line -> the files below ``path`` that begin with it.

    The first line with any text of every file is found by an aggregate over the files'
    first blocks; names of files and distinct headers come to the driver, no rows."""
    meta = F.col("_metadata")
    lines = (spark.read.text(path)
             .filter((meta["file_block_start"] == 0) & (F.trim("value") != ""))
             .select(meta["file_path"].alias("file"), "value", F.monotonically_increasing_id().alias("at")))
    first = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    groups = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header")
    # the path column is a URI; signs that a reader takes for a pattern are escaped
    return {g["header"]: [re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(f)) for f in g["files"]] for g in groups.collect()}


def rejected_cells(wide: DataFrame, start: int, end: int) -> DataFrame:
    """(file, country_code, year, cell): cells of year columns that hold something, but
    no number, such as flagged values."""
    years, geo = year_columns(wide.columns, start, end), geo_column(wide.columns)
    named = wide.select(F.col("_metadata.file_path").alias("file"),
                        (strip_ws(F.col(f"`{geo}`")) if geo in wide.columns else F.lit(None).cast("string"))
                        .alias("country_code"), *[F.col(f"`{y}`") for y in years])
    if not years:
        return named.select("file", "country_code", F.lit(None).cast("int").alias("year"),
                            F.lit(None).cast("string").alias("cell")).where(F.lit(False))
    return (named.unpivot(["file", "country_code"], [F.col(f"`{y}`") for y in years], "year", "cell")
            .filter(~strip_ws("cell").isin(*MISSING_CELLS) & strip_ws("cell").try_cast("double").isNull())
            .withColumn("year", F.col("year").cast("int")))


def land_folder(spark: SparkSession, path: str, dataset: str, start: int, end: int, load_date,
                sep: str = ",", defaults: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The landed rows of all wide files below ``path`` and their rejected cells.

    Files may differ in their year columns, dimensions and column order: those with the
    same header are read together, every group is unpivoted by its own column names, and
    the results are united by name. A folder without any line gives empty tables, as do
    files that hold a header only or no geo column."""
    landed, rejects = [], []
    for files in header_groups(spark, path).values():
        wide = read_wide_csv(spark, files, sep)
        rejects.append(rejected_cells(wide, start, end))
        if geo_column(wide.columns) in wide.columns:
            landed.append(geo_filter(unpivot_wide(wide, start, end, load_date), spark, dataset, defaults))
    if not landed:
        none = unpivot_wide(spark.createDataFrame([], "geo string"), start, end, load_date)
        landed.append(geo_filter(none, spark, dataset, defaults))
    if not rejects:
        rejects.append(spark.createDataFrame([], "file string, country_code string, year int, cell string"))
    return reduce(DataFrame.unionByName, landed), reduce(DataFrame.unionByName, rejects)


def build_wide(panel: DataFrame, dataset: str, spark: SparkSession,
               dims: dict[str, str], years: list[int]) -> DataFrame:
    """Test input: a dataset's panel rows pivoted back into a wide statistic
    table with text cells. Cells are ':' (missing) when (year + k) % 5 == 0
    and carry a ' p' flag when (year + k) % 7 == 0, k being the country's
    dimension index; codes with an even index are padded with blanks. An
    aggregate row 'EU27_2020' (sum over countries) is added; landing drops it.
    One text column per year of ``years`` (empty where no data), so the pivot
    needs no distinct-values job.
    """
    rows = (panel.filter(F.col("dataset") == dataset)
            .withColumn("dim_index", index_of_code(F.col("country_code")))
            .filter(F.col("dim_index").isNotNull())
            .select("country_code", "dim_index", "year", "value"))
    k = F.col("year") + F.col("dim_index")
    cell = (F.when(k % 5 == 0, F.lit(":"))
            .when(k % 7 == 0, F.concat(F.col("value").cast("string"), F.lit(" p")))
            .otherwise(F.col("value").cast("string")))
    geo = F.when(F.col("dim_index") % 2 == 0,
                 F.concat(F.lit(" "), F.col("country_code"), F.lit(" "))
                 ).otherwise(F.col("country_code"))
    per_country = rows.select(geo.alias("geo"), "year", cell.alias("cell"))
    # summed as DECIMAL so the aggregate does not depend on summation order
    eu = (rows.groupBy("year").agg(F.sum(F.col("value").cast("decimal(38,6)")).alias("value"))
          .select(F.lit("EU27_2020").alias("geo"), "year",
                  F.col("value").cast("string").alias("cell")))
    long = per_country.unionByName(eu)
    for name, v in dims.items():
        long = long.withColumn(name, F.lit(v))
    wide = (long.groupBy(*dims.keys(), F.col("geo").alias(GEO_HEADER))
            .pivot("year", years).agg(F.first("cell")))
    return wide
