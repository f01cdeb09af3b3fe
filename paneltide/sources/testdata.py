"""Maps the driver's TPC-H-style tables onto the indicator panel.

* ``gdp_annual``          customer nation x order year: sum(o_totalprice) / 1000
* ``unemployment_annual`` customer nation x order year: 100 x share of orders
  with status F (age_group Y15-74, sex T), plus one row per order priority as
  another age group so that the demographic slice filter has work to do
* ``energy_intensity``    supplier nation x ship year:
  1000 x sum(l_quantity) / sum(l_extendedprice)
* ``inflation_annual``    supplier nation x ship year: 100 x avg(l_discount)

Nation key k maps to the k-th code of the sorted country dimension; keys beyond
its 27 codes have no country and are left out, as landing leaves out unknown
codes. Cells whose row count is a multiple of ``MISSING[dataset]`` are published
as missing (NULL value), the way statistic tables carry ``:`` cells.

Scale notes: the only large inputs are ``orders`` and ``lineitem``. Only the
facts of the requested datasets are read, each once, with a narrow ReadSchema,
joined to its (column-pruned) customer/supplier side with a shuffle join chosen
by AQE, and reduced by a partial (map-side) aggregate to nation x year [x
priority] before any further shuffle. The (nation, year) level of the orders is
summed from the few (nation, year, priority) rows. Amounts are summed as exact
integer cents, so results do not depend on partitioning or summation order.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.functions import constants as K
from paneltide.params import Params
from paneltide.sources.dimension import code_of_index, name_of_code
from paneltide.sources.tables import read_table

MISSING = {K.GDP: 7, K.UNEMPLOYMENT: 5, K.ENERGY: 6, K.INFLATION: 4}


def cents(c: str) -> F.Column:
    """Exact integer hundredths of a 2-decimal amount. Summing BIGINT cents is
    exact and order-independent like DECIMAL, but stays on the fast
    fixed-width aggregation path (a DECIMAL(18,2) sum widens to
    DECIMAL(28,2), which Spark evaluates with BigDecimal objects)."""
    return F.round(F.col(c) * 100).cast("long")


def from_cents(c: str) -> F.Column:
    return F.col(c).cast("double") / F.lit(100.0)


PANEL_COLUMNS = ["dataset", "country_code", "country_name", "year", "unit",
                 "indicator", "age_group", "sex", "value", "loaded_at"]

RAW_COLUMNS: dict[str, list[str]] = {
    K.GDP: ["country_code", "country_name", "year", "unit", "indicator", "value", "loaded_at"],
    K.UNEMPLOYMENT: ["country_code", "country_name", "year", "unit", "age_group", "sex",
                     "value", "loaded_at"],
    K.ENERGY: ["country_code", "country_name", "year", "unit", "value", "loaded_at"],
    K.INFLATION: ["country_code", "country_name", "year", "unit", "value", "loaded_at"],
}


def _nations(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "nation", ["n_nationkey"])


def line_facts(spark: SparkSession, base: str, datasets: Sequence[str]) -> DataFrame:
    """lineitem x supplier x nation reduced to supplier nation x ship year, with
    the sums that ``datasets`` need."""
    sums = {}
    if K.ENERGY in datasets:
        sums |= {"l_quantity": "qty_sum", "l_extendedprice": "price_sum"}
    if K.INFLATION in datasets:
        sums |= {"l_discount": "disc_sum"}
    li = read_table(spark, base, "lineitem", ["l_suppkey", *sums, "l_shipdate"])
    supplier = read_table(spark, base, "supplier", ["s_suppkey", "s_nationkey"])
    # semi join: keeps the supplier side's own size estimate (an inner join's
    # estimate is the product of both sides), so the planner never picks the
    # fact table as the build side
    supp_nation = supplier.join(_nations(spark, base), F.col("s_nationkey") == F.col("n_nationkey"),
                                "left_semi")
    joined = li.join(supp_nation, li.l_suppkey == supp_nation.s_suppkey)
    return (joined.groupBy(F.col("s_nationkey").alias("nation_key"), F.year("l_shipdate").alias("year"))
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 *[F.sum(cents(c)).alias(name) for c, name in sums.items()]))


def order_facts(spark: SparkSession, base: str, datasets: Sequence[str]) -> DataFrame:
    """orders x customer x nation at (nation, year); with unemployment also at
    (nation, year, priority), marked by a non-null ``priority``."""
    rates = K.UNEMPLOYMENT in datasets
    columns = ["o_custkey", "o_orderdate", *(["o_totalprice"] if K.GDP in datasets else []),
               *(["o_orderstatus", "o_orderpriority"] if rates else [])]
    orders = read_table(spark, base, "orders", columns)
    customer = read_table(spark, base, "customer", ["c_custkey", "c_nationkey"])
    cust_nation = customer.join(_nations(spark, base), F.col("c_nationkey") == F.col("n_nationkey"),
                                "left_semi")
    joined = orders.join(cust_nation, orders.o_custkey == cust_nation.c_custkey)
    keys = [F.col("c_nationkey").alias("nation_key"), F.year("o_orderdate").alias("year"),
            *([F.coalesce("o_orderpriority", F.lit("")).alias("priority")] if rates else [])]
    first = joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_orders"),
        *([F.sum(cents("o_totalprice")).alias("price_sum")] if K.GDP in datasets else []),
        *([F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("n_final")] if rates else []))
    if not rates:
        return first.withColumn("priority", F.lit(None).cast("string"))
    # counts and cents add up exactly: the coarser level comes from these few rows
    sums = [F.sum(c).alias(c) for c in first.columns if c not in ("nation_key", "year", "priority")]
    return (first.rollup("nation_key", "year", "priority").agg(*sums, F.grouping_id().alias("_gid"))
            .filter(F.col("_gid") <= 1).drop("_gid"))


def _with_country(facts: DataFrame) -> DataFrame:
    """Nation key -> (code, name) of the fixed dimension; unknown keys drop."""
    code = code_of_index(F.col("nation_key"))
    return (facts.withColumn("country_code", code)
            .filter(F.col("country_code").isNotNull())
            .withColumn("country_name", name_of_code(F.col("country_code")))
            .drop("nation_key"))


def _row(dataset: str, value: F.Column, n: str, age_group: F.Column | None = None) -> F.Column:
    sl = K.DATASET_SLICES[dataset]
    nul = F.lit(None).cast("string")
    return F.struct(F.lit(dataset).alias("dataset"), F.lit(sl["unit"]).alias("unit"),
                    (F.lit(sl["indicator"]) if "indicator" in sl else nul).alias("indicator"),
                    (age_group if age_group is not None else nul).alias("age_group"),
                    (F.lit(sl["sex"]) if "sex" in sl else nul).alias("sex"),
                    F.when(F.col(n) % MISSING[dataset] != 0, value).cast("double").alias("value"))


def _expand(facts: DataFrame, rows: list[F.Column], params: Params, reload: bool) -> DataFrame:
    """One fact row -> its panel rows (and, with ``reload``, both loads):
    a single projection + explode, so each fact table is scanned once."""
    loads = [F.struct(F.lit(params.load_date).alias("loaded_at"), F.lit(1.0).alias("f"))]
    if reload:
        loads.append(F.struct(F.lit(params.reload_date).alias("loaded_at"),
                              F.lit(params.reload_factor).alias("f")))
    one_or_each = lambda xs: xs[0] if len(xs) == 1 else F.explode(F.array(*xs))
    x = (facts.select("country_code", "country_name", F.col("year").cast("int").alias("year"),
                      one_or_each(rows).alias("r"))
         .filter(F.col("r").isNotNull())
         .select("*", one_or_each(loads).alias("l")))
    value = F.col("r.value") * F.col("l.f")  # x * 1.0 == x exactly
    return x.select(F.col("r.dataset").alias("dataset"), "country_code", "country_name", "year",
                    F.col("r.unit").alias("unit"), F.col("r.indicator").alias("indicator"),
                    F.col("r.age_group").alias("age_group"), F.col("r.sex").alias("sex"),
                    value.alias("value"), F.col("l.loaded_at").alias("loaded_at"))


def raw_panel(spark: SparkSession, base: str, params: Params, reload: bool = False,
              datasets: Sequence[str] = tuple(K.DATASETS)) -> DataFrame:
    """The requested landed datasets as one long panel with a ``dataset`` column;
    fact tables that none of them needs are not read.

    ``reload=True`` appends an older second load (value x 0.99, one day
    earlier) of every row: the input the staging dedupe is tested on.
    """
    parts = []
    total = F.col("priority").isNull()
    if {K.GDP, K.UNEMPLOYMENT} & set(datasets):
        rows = []
        if K.GDP in datasets:
            rows.append(F.when(total, _row(K.GDP, from_cents("price_sum") / F.lit(1000.0), "n_orders")))
        if K.UNEMPLOYMENT in datasets:
            share = F.lit(100.0) * F.col("n_final") / F.col("n_orders")
            age = F.coalesce("priority", F.lit(K.DATASET_SLICES[K.UNEMPLOYMENT]["age_group"]))
            rows.append(_row(K.UNEMPLOYMENT, share, "n_orders", age))
        parts.append(_expand(_with_country(order_facts(spark, base, datasets)), rows, params, reload))
    if {K.ENERGY, K.INFLATION} & set(datasets):
        rows = []
        if K.ENERGY in datasets:
            rows.append(_row(K.ENERGY, F.lit(1000.0) * from_cents("qty_sum") / from_cents("price_sum"),
                             "n_lines"))
        if K.INFLATION in datasets:
            rows.append(_row(K.INFLATION, F.lit(100.0) * from_cents("disc_sum") / F.col("n_lines"),
                             "n_lines"))
        parts.append(_expand(_with_country(line_facts(spark, base, datasets)), rows, params, reload))
    return reduce(DataFrame.unionByName, parts)


def raw_table(panel: DataFrame, dataset: str) -> DataFrame:
    """One landed table in the reference's column layout."""
    return panel.filter(F.col("dataset") == dataset).select(*RAW_COLUMNS[dataset])


def event_facts(spark: SparkSession, base: str) -> DataFrame:
    """Events with the columns the alert mapping uses."""
    return read_table(spark, base, "events", ["event_id", "ts", "user_id", "event_type",
                                              "value", "props"])
