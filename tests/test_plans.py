"""Plan-shape checks: pruning and pushdown reach the scan, no Python in any plan,
partial aggregation before shuffles, and a hot key handled exactly."""

import datetime as dt
import re
from decimal import Decimal

import pytest

from estrella.plans import QUERIES


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_evaluation_in_plans(spark, sf_small, key):
    plan = physical(QUERIES[key](spark, sf_small))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|MapInPandas|FlatMapGroupsInPandas", plan)


def _read_schema(plan: str, table: str) -> set[str]:
    m = re.search(rf"{table}\.parquet\][^\n]*ReadSchema: struct<([^>]*)>", plan)
    assert m, f"no scan of {table} in plan"
    return {f.split(":")[0] for f in m.group(1).split(",")}


def test_column_pruning_reaches_the_scan(spark, sf_small):
    plan = physical(QUERIES["exclude_list"](spark, sf_small))
    assert _read_schema(plan, "orders") == {"o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"}
    plan = physical(QUERIES["distinct_per_key"](spark, sf_small))
    assert _read_schema(plan, "orders") <= {"o_orderkey", "o_custkey"}


def test_filters_pushed_into_the_scan(spark, sf_small):
    plan = physical(QUERIES["staging_overdue"](spark, sf_small))
    assert re.search(r"lineitem\.parquet\][^\n]*PushedFilters: \[[^\]]*EqualTo\(l_returnflag,R\)", plan)


def test_partial_aggregation_before_shuffle(spark, sf_small):
    plan = physical(QUERIES["collections_mart"](spark, sf_small))
    assert "partial_sum" in plan and "partial_count" in plan


def test_hot_key_collections_match_brute_force(spark):
    """A third of the payments belong to one sale and some have no sale id at all."""
    from estrella.plans.marts import collections_by_sale

    from pyspark.sql import functions as F

    from estrella.plans.marts import COLLECTION_SALE_COLS, UNIT_COLS

    sales = spark.createDataFrame(
        [(1, "u", Decimal("100.00")), (2, "u", Decimal("0.00")), (3, None, Decimal("50.00"))],
        "id_venta bigint, unidad_key string, precio_venta decimal(18,2)",
    ).withColumns({c: F.lit(None).cast("string") for c in COLLECTION_SALE_COLS if c != "precio_venta"})
    units = spark.createDataFrame(
        [("u", *UNIT_COLS)], "unidad_key string, " + ", ".join(f"{c} string" for c in UNIT_COLS)
    )
    pay = []
    for i in range(300):
        sale = 1 if i % 3 == 0 else (None if i % 3 == 1 else 3)
        pay.append((sale, Decimal("1.25"), "Activo" if i % 2 else "Cancelado", dt.date(2020, 2, 1 + i % 28)))
    payments = spark.createDataFrame(
        pay, "id_venta bigint, monto_pagado decimal(18,2), status_ingreso string, fecha_ingreso date"
    ).repartition(7)
    got = {r.id_venta: r for r in collections_by_sale(sales, units, payments).collect()}
    for sid, price in [(1, Decimal("100.00")), (2, Decimal("0.00")), (3, Decimal("50.00"))]:
        rows = [p for p in pay if p[0] == sid]
        active = sum((p[1] for p in rows if p[2] == "Activo"), Decimal("0"))
        r = got[sid]
        assert r.numero_movimientos_ingreso == len(rows)
        assert r.total_ingresado_bruto == sum((p[1] for p in rows), Decimal("0"))
        assert r.total_ingresado_activo == active
        assert r.saldo_estimado == price - active
        expect_pct = None if price <= 0 else (active / price * 100).quantize(Decimal("0.01"))
        assert r.porcentaje_cobrado == expect_pct
    assert set(got) == {1, 2, 3}  # payments without a sale never create a sale row


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _exchanges(plan: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan))


def _scans(plan: str, table: str) -> int:
    return len(re.findall(rf"FileScan parquet[^\n]*/{table}\.parquet", plan))


@pytest.mark.parametrize(
    "key,most", [("dash_rebuilt", 48), ("commercial_mart", 36), ("collection_status", 26),
                 ("conflict_audit", 6), ("party_key_conflicts", 12), ("period_mart", 20)]
)
def test_exchanges_at_scale(spark, sf_small, no_broadcast, key, most):
    plan = physical(QUERIES[key](spark, sf_small))
    assert _exchanges(plan) <= most
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_audits_compute_their_input_once(spark, sf_small, no_broadcast):
    assert _scans(physical(QUERIES["conflict_audit"](spark, sf_small)), "orders") == 1
    assert _scans(physical(QUERIES["unit_conflicts"](spark, sf_small)), "orders") == 1
    orphans = physical(QUERIES["orphan_count"](spark, sf_small))
    assert _scans(orphans, "lineitem") == 1 and _scans(orphans, "orders") == 1
