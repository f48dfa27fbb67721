"""Explicit-schema Parquet readers for the input tables.

Schemas are declared, never inferred: the reader only has to open footers for
row groups, Catalyst prunes columns to what each plan needs (``ReadSchema``) and
pushes filters into the scan (``PushedFilters``).
"""

from __future__ import annotations

import os

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_L, _I, _S, _D = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()
_TS = T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _schema(
        ("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I), ("c_acctbal", _D),
        ("c_mktsegment", _S),
    ),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "part": _schema(
        ("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S), ("p_size", _I),
        ("p_retailprice", _D),
    ),
    "orders": _schema(
        ("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_totalprice", _D),
        ("o_orderdate", _TS), ("o_orderpriority", _S),
    ),
    "lineitem": _schema(
        ("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_linenumber", _I),
        ("l_quantity", _D), ("l_extendedprice", _D), ("l_discount", _D), ("l_tax", _D),
        ("l_returnflag", _S), ("l_linestatus", _S), ("l_shipdate", _TS),
    ),
    "events": _schema(
        ("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S), ("value", _D),
        ("props", _S),
    ),
    "documents": _schema(
        ("doc_id", _L), ("text", _S), ("lang", _S), ("source", _S), ("n_chars", _L),
    ),
}


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one input table with its declared schema."""
    if name not in SCHEMAS:
        raise KeyError(f"unknown table {name!r}; known: {sorted(SCHEMAS)}")
    return spark.read.schema(SCHEMAS[name]).parquet(table_path(sf_dir, name))


def stored_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Bytes of the warehouse's input tables as they are stored; ``documents`` belong to ``llm``."""
    paths = [spark._jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, n)) for n in SCHEMAS if n != "documents"]
    stores = [(p.getFileSystem(spark._jsc.hadoopConfiguration()), p) for p in paths]
    return sum(fs.getContentSummary(p).getLength() for fs, p in stores if fs.exists(p))


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).orders`` reads on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in SCHEMAS:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]

    def frame(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The derived frame ``name``. Here it is made anew for each reader and stays lazy;
        ``sources.shared`` writes those that several readers of one build ask for."""
        return make()
