"""Staging: typed projection, NOT NULL / range / slice filters, dedupe to the
latest load (P14-P18), and the extraction slice applied at landing (P8)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneltide.functions import constants as K
from paneltide.functions.columns import strip_ws, year_start
from paneltide.params import Params

STAGED_VALUE_NAMES = {
    K.GDP: "gdp_meur",
    K.UNEMPLOYMENT: "unemployment_rate",
    K.ENERGY: "energy_intensity",
    K.INFLATION: "inflation_rate",
}


def slice_condition(dataset_col: Column, fields: tuple[str, ...] | None = None) -> Column:
    """True for rows inside their dataset's extraction slice (dims other than
    ``unit``/``indicator``, which are constant per landed table)."""
    cond = None
    for ds, spec in K.DATASET_SLICES.items():
        dims = [(k, v) for k, v in spec.items() if k not in ("unit", "indicator")
                and (fields is None or k in fields)]
        c = dataset_col == ds
        for k, v in dims:
            c = c & (F.col(k) == v)
        cond = c if cond is None else cond | c
    return cond


def extraction_slice(panel: DataFrame) -> DataFrame:
    """Keep each dataset's extraction slice (e.g. unemployment Y15-74 / T)."""
    return panel.filter(slice_condition(F.col("dataset")))


def dedupe_latest(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Keep the newest load per key: loaded_at desc, then value desc, then unit.

    ``row_number() ... = 1`` is planned as a WindowGroupLimit, which keeps one
    row per key per input partition before the shuffle; a key's group holds at
    most one row per load.
    """
    order = order or [F.col("loaded_at").desc_nulls_last(), F.col("value").desc_nulls_last(),
                      F.col("unit").asc_nulls_last()]
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def stage_panel(raw: DataFrame, params: Params, dedupe: bool = True,
                partition_by: list[str] | None = None) -> DataFrame:
    """All four staging views at once over the long panel.

    Output: dataset, country_code, country_name, reference_year,
    reference_date, value, unit, indicator, age_group, sex, loaded_at.
    """
    year = F.col("year").cast("int")
    staged = (raw
              .filter(F.col("value").isNotNull() & F.col("year").isNotNull()
                      & F.col("country_code").isNotNull()
                      & year.between(params.year_min, params.year_max))
              .filter(~(F.col("dataset") == K.UNEMPLOYMENT)
                      | slice_condition(F.col("dataset"), ("age_group", "sex")))
              .select("dataset",
                      strip_ws("country_code").alias("country_code"),
                      strip_ws("country_name").alias("country_name"),
                      year.alias("reference_year"),
                      year_start(year).alias("reference_date"),
                      F.col("value").cast("double").alias("value"),
                      "unit", "indicator", "age_group", "sex", "loaded_at"))
    # The dedupe runs before any repartition so that its partial
    # WindowGroupLimit keeps one row per key per input partition before the
    # shuffle: a key with many copies (a third of all rows) is reduced map-side.
    # Only the deduplicated panel (one row per dataset x country x year) is
    # then hash-partitioned, so ``partition_by`` never moves raw copies.
    keys = ["dataset", "country_code", "reference_year"]
    if not dedupe:
        out = staged
    elif params.dedupe_inflation:
        out = dedupe_latest(staged, keys)
    else:
        deduped = dedupe_latest(staged.filter(F.col("dataset") != K.INFLATION), keys)
        out = deduped.unionByName(staged.filter(F.col("dataset") == K.INFLATION))
    return out.repartition(*partition_by) if partition_by else out


def staged_view(staged: DataFrame, dataset: str) -> DataFrame:
    """One staging view in the reference's column layout."""
    vname = STAGED_VALUE_NAMES[dataset]
    base = [F.col("country_code"), F.col("country_name"), F.col("reference_year"),
            F.col("reference_date"), F.col("value").alias(vname)]
    if dataset == K.GDP:
        base.append(F.round(F.col("value") / F.lit(1000), 3).alias("gdp_beur"))
    base.append(F.col("unit"))
    if dataset == K.UNEMPLOYMENT:
        base += [F.col("age_group"), F.col("sex")]
    base.append(F.col("loaded_at"))
    return staged.filter(F.col("dataset") == dataset).select(*base)
