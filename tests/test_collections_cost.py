"""What the collections mart and its refresh read, sum and write at size."""

import glob
import random
import re
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from estrella.functions import percent_half_up
from estrella.plans import audits as A
from estrella.plans import marts as M


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def scans(df, table):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(rf"FileScan parquet[^\n]*/{table}\.parquet", plan))


def test_orders_with_units_are_joined_once_above_the_bound(spark, sf_small, monkeypatch):
    plain = M.collections_mart(spark, sf_small)
    monkeypatch.setattr(M, "COLLECTIONS_SHARE_BYTES", 0)
    once = M.collections_mart(spark, sf_small)
    assert scans(plain, "orders") > 2 and scans(once, "orders") == 0
    assert rows(once) == rows(plain)


def test_payments_are_summed_as_cents(spark):
    data = [(1, "99999999.99", "Activo"), (1, "0.01", "ACTIVO"), (1, "-5.05", "Cancelado"), (2, None, "Activo"),
            (None, "7.10", "Cancelado"), (None, "1.15", "activo"), (3, "2.00", None)]
    df = spark.createDataFrame(data, "id_venta long, m string, status_ingreso string").select(
        "id_venta", F.col("m").cast("decimal(10,2)").alias("monto_pagado"), "status_ingreso",
        F.lit("2020-01-01").cast("date").alias("fecha_ingreso"),
    )
    got = M.payments_per_sale(df)
    assert "sum(__amount" in got._jdf.queryExecution().executedPlan().toString()
    assert [got.schema[c].dataType.simpleString() for c in ("total_ingresado", "total_ingresado_activo")] == ["decimal(20,2)"] * 2
    found = {r[0]: tuple(map(str, r[1:4])) for r in got.collect()}
    assert found == {1: ("99999994.95", "100000000.00", "3"), 2: ("0.00", "0.00", "1"),
                     None: ("8.25", "1.15", "2"), 3: ("2.00", "0.00", "1")}
    wider = M.payments_per_sale(df.withColumn("monto_pagado", F.col("monto_pagado").cast("decimal(18,2)")))
    assert {r[0]: tuple(map(str, r[1:4])) for r in wider.collect()} == found


def by_hand(n, d, guard):
    if n is None or d is None or d == 0 or (guard == "positive" and d < 0):
        return None
    with localcontext() as c:
        c.prec = 90
        value = (n * 100 / d).quantize(Decimal("0.01"), ROUND_HALF_UP)
    return value if abs(value) * 100 < Decimal("9.1e18") else None


@pytest.mark.parametrize("guard", ["positive", "nonzero"])
def test_percent_of_small_and_large_amounts(spark, guard):
    rand = random.Random(5)
    edges = [None, *map(Decimal, ("0", "0.01", "-0.01", "1.25", "-8", "1999999999999.99", "-2000000000000", "2000000000000.01", "9" * 28 + ".99"))]
    pairs = [(a, b) for a in edges for b in edges]
    pairs += [tuple(Decimal(rand.randint(-(10**k), 10**k)) / 100 for k in (rand.randint(1, 28), rand.randint(1, 28))) for _ in range(400)]
    df = spark.createDataFrame(pairs, "n decimal(38,2), d decimal(38,2)")
    for n, d, p in df.select("n", "d", percent_half_up("n", "d", guard=guard).alias("p")).collect():
        assert p == by_hand(n, d, guard), (n, d)
    usual = df.select(percent_half_up("n", "d", guard=guard).alias("p"))._jdf.queryExecution().optimizedPlan().toString()
    assert "as bigint" in usual


def test_refreshed_files_have_no_dictionary_of_unlike_values(spark, sf_small):
    files = [f for f in A.table_refresh(spark, sf_small).inputFiles()]
    folder = files[0].removeprefix("file:").rsplit("/", 1)[0]
    meta = [pq.ParquetFile(f).metadata for f in glob.glob(f"{folder}/*.parquet")]
    used = {}
    for m in meta:
        for g in range(m.num_row_groups):
            for c in range(m.num_columns):
                col = m.row_group(g).column(c)
                used.setdefault(col.path_in_schema, set()).update(col.encodings)
    dictionary = {c for c, e in used.items() if any("DICTIONARY" in x for x in e)}
    assert dictionary.isdisjoint(A._NO_DICTIONARY) and "desarrollo_largo" in dictionary
