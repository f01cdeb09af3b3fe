"""Readers for the parquet tables a run starts from.

Tables are read with a declared schema: no footer-inference job per read,
and a drifted file fails loudly instead of silently changing types.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def _schema(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


L, I, D, S, TS = LongType(), IntegerType(), DoubleType(), StringType(), TimestampNTZType()

SCHEMAS: dict[str, StructType] = {
    "region": _schema(("r_regionkey", I), ("r_name", S)),
    "nation": _schema(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _schema(("c_custkey", L), ("c_name", S), ("c_nationkey", I),
                        ("c_acctbal", D), ("c_mktsegment", S)),
    "supplier": _schema(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "orders": _schema(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S),
                      ("o_totalprice", D), ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": _schema(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L),
                        ("l_linenumber", I), ("l_quantity", D), ("l_extendedprice", D),
                        ("l_discount", D), ("l_tax", D), ("l_returnflag", S),
                        ("l_linestatus", S), ("l_shipdate", TS)),
    "events": _schema(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S),
                      ("value", D), ("props", S)),
}


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Read one table with its declared schema; selecting ``columns`` here
    keeps the scan's ReadSchema narrow."""
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    df = reader.parquet(table_path(base, name))
    return df.select(*columns) if columns else df
