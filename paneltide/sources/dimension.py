"""Country dimension: a fixed 27-row lookup (code, name, iso2, iso3).

Its size is fixed by the constant list, so broadcasting it is always safe.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from paneltide.functions import constants as K

DIM_SCHEMA = StructType([
    StructField("dim_index", IntegerType(), False),
    StructField("country_code", StringType(), False),
    StructField("country_name", StringType(), False),
    StructField("iso2", StringType(), False),
    StructField("iso3", StringType(), False),
])


def dimension_rows() -> list[tuple]:
    codes = sorted(K.COUNTRY_NAMES)
    return [(i, c, K.COUNTRY_NAMES[c], K.CODE_TO_ISO2.get(c, c), K.CODE_TO_ISO3[c])
            for i, c in enumerate(codes)]


def country_dimension(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(dimension_rows(), DIM_SCHEMA))


def dimension_values_sql() -> str:
    """The same dimension as an SQL VALUES list (for the DuckDB oracle)."""
    rows = ", ".join(f"({i}, '{c}', '{n}', '{i2}', '{i3}')"
                     for i, c, n, i2, i3 in dimension_rows())
    return (f"(SELECT * FROM (VALUES {rows}) "
            "AS t(dim_index, country_code, country_name, iso2, iso3))")


def _sql_lit(x) -> str:
    return str(x) if isinstance(x, int) else "'" + str(x).replace("'", "''") + "'"


def _lookup(pairs: list[tuple], key: F.Column) -> F.Column:
    """Value of ``key`` in a fixed literal map (NULL when absent): a
    projection inside whole-stage codegen, no join and no broadcast job.
    The map literal is parsed from SQL text in one call."""
    m = F.expr("map(" + ", ".join(f"{_sql_lit(k)}, {_sql_lit(v)}" for k, v in pairs) + ")")
    return F.try_element_at(m, key)


def code_of_index(idx: F.Column) -> F.Column:
    return _lookup([(r[0], r[1]) for r in dimension_rows()], idx.cast("int"))


def name_of_code(code: F.Column) -> F.Column:
    return _lookup([(r[1], r[2]) for r in dimension_rows()], code)


def index_of_code(code: F.Column) -> F.Column:
    return _lookup([(r[1], r[0]) for r in dimension_rows()], code)


def iso3_of_code(code: F.Column) -> F.Column:
    return _lookup([(r[1], r[4]) for r in dimension_rows()], code)
