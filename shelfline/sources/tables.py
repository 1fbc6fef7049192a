"""Readers for the driver-supplied Parquet tables.

Schemas are declared, never inferred, so a file with a drifting type fails
at read time instead of silently changing query semantics. Every reader
returns a lazy DataFrame; Catalyst prunes columns and pushes filters into
the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_L, _I, _D, _S, _TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


DRIVER_SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _schema(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I),
                        ("c_acctbal", _D), ("c_mktsegment", _S)),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "part": _schema(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S),
                    ("p_size", _I), ("p_retailprice", _D)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S),
                      ("o_totalprice", _D), ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L),
                        ("l_linenumber", _I), ("l_quantity", _D), ("l_extendedprice", _D),
                        ("l_discount", _D), ("l_tax", _D), ("l_returnflag", _S),
                        ("l_linestatus", _S), ("l_shipdate", _TS)),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table with its declared schema (if we know it)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = DRIVER_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)
