"""Every registered query equals its DuckDB oracle on the smallest test scale."""

import pytest

import __spark_entry__ as entry
from estrella.plans import ORACLE_SQL, QUERIES
from tests.oracle_compare import compare, duck_conn

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck(sf_small):
    return duck_conn(sf_small)


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, sf_small, key):
    res = compare(spark, duck, key, QUERIES[key], ORACLE_SQL.get(key), sf_small)
    assert res["ok"], res.get("why")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "porcentaje_cobrado" in df.columns


def _duck_type(dt):
    from pyspark.sql import types as T

    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    return {
        T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.StringType: "VARCHAR",
        T.DoubleType: "DOUBLE", T.DateType: "DATE", T.BooleanType: "BOOLEAN",
        T.TimestampNTZType: "TIMESTAMP",
    }.get(type(dt), str(dt))


@pytest.mark.parametrize("key", KEYS)
def test_column_types_match_oracle(spark, duck, sf_small, key):
    schema = QUERIES[key](spark, sf_small).schema
    rel = duck.sql(ORACLE_SQL[key])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {f.name: _duck_type(f.dataType) for f in schema.fields} == duck_types
