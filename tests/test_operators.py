"""Operators against brute force on small fixtures (nulls, blanks, fan-out, duplicates)."""

import datetime as dt
import os
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from estrella.operators import (
    Check,
    attach,
    bounded_broadcast,
    check_expression,
    check_not_null,
    check_relationship,
    check_unique,
    check_unique_combination,
    coverage,
    date_dim,
    date_spine,
    date_spine_covering,
    distinct_value_conflicts,
    drop_blank_rows,
    exclude_values,
    find_duplicates,
    no_key_coverage,
    orphan_count,
    orphans,
    quality_report,
    reconcile,
    require_present,
    survivor_max,
)
from estrella.operators.calendar import day_count


def _nulls_first(t):
    return tuple((x is not None, x) for x in t)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_nulls_first)


def test_survivor_max_mixes_rows_and_is_lexicographic(spark):
    df = spark.createDataFrame(
        [(1, "x", 1, "9"), (1, "y", 0, "10"), (2, None, None, None)], "k int, a string, b int, t string"
    )
    out = survivor_max(df, ["k"], ["a", "b", "t"], {"a_low": F.lower("a")})
    assert rows(out, "k", "a", "b", "t", "a_low") == [(1, "y", 1, "9", "y"), (2, None, None, None, None)]


_vals = st.one_of(st.none(), st.sampled_from(["", " ", "a", "A", " a", "b"]))


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), _vals, _vals), max_size=40))
def test_distinct_value_conflicts_equals_brute_force(spark, data):
    df = spark.createDataFrame(data or [(0, None, None)], "k int, x string, y string")
    if not data:
        data = [(0, None, None)]
    got = distinct_value_conflicts(
        df, ["k"], {"x": F.col("x"), "y": F.nullif(F.trim("y"), F.lit(""))}
    )
    xs, ys = defaultdict(set), defaultdict(set)
    for k, x, y in data:
        if x is not None:
            xs[k].add(x)
        yn = None if y is None or y.strip(" ") == "" else y.strip(" ")
        if yn is not None:
            ys[k].add(yn)
    keys = {k for k, _, _ in data}
    expect = sorted(
        ((k, len(xs[k]), len(ys[k])) for k in keys if len(xs[k]) > 1 or len(ys[k]) > 1),
        key=_nulls_first,
    )
    assert rows(got, "k", "x", "y") == expect


def test_find_duplicates_nulls_form_a_group(spark):
    df = spark.createDataFrame(
        [(1, None, "s1"), (1, None, "s2"), (2, 1, "s1"), (2, 2, "s1")], "a int, b int, s string"
    )
    out = find_duplicates(df, ["a", "b"], "n", {"ds": "s"})
    assert rows(out, "a", "b", "n", "ds") == [(1, None, 2, 2)]


@settings(max_examples=20, deadline=None)
@given(
    st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=30),
    st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=30),
)
def test_coverage_equals_left_join_counts(spark, child_keys, parent_keys):
    child = spark.createDataFrame([(k,) for k in child_keys] or [(None,)], "k int")
    if not child_keys:
        child_keys = [None]
    parent = spark.createDataFrame([(k,) for k in parent_keys], "k int")
    got = coverage(child, parent, "k", "k", "c -> p", "t").first()
    mult = Counter(k for k in parent_keys if k is not None)
    total = sum(max(mult[k], 1) if k is not None else 1 for k in child_keys)
    matched = sum(mult[k] for k in child_keys if k is not None)
    assert (got.total_registros, got.con_relacion, got.sin_relacion) == (total, matched, total - matched)
    pct = round(matched / total * 100, 2) if total else None
    assert got.cobertura_pct == pct


def test_no_key_coverage_typed_nulls(spark):
    r = no_key_coverage(spark.range(3), "x", "sin_llave").first()
    assert (r.total_registros, r.con_relacion, r.cobertura_pct) == (3, None, None)


def test_filters(spark):
    df = spark.createDataFrame(
        [(1, "1-URGENT", "a"), (2, None, None), (3, "2-HIGH", ""), (4, "5-LOW", "x")],
        "k int, p string, s string",
    )
    assert rows(exclude_values(df, "p", ["1-URGENT", "5-LOW"]), "k") == [(3,)]
    assert rows(require_present(df, "p", "s"), "k") == [(1,), (3,), (4,)]
    assert rows(drop_blank_rows(df, ["p", "s"]), "k") == [(1,), (3,), (4,)]
    assert rows(drop_blank_rows(df.select("s")), "s") == [("a",), ("x",)]


def test_orphans_and_attach(spark):
    child = spark.createDataFrame([(1, 5), (2, 6), (None, 7)], "k int, v int")
    parent = spark.createDataFrame([(1,), (1,)], "k int")
    assert rows(orphans(child, parent, "k"), "v") == [(6,), (7,)]
    assert orphan_count(child, parent, "k", "k", "n").first().n == 2
    agg = spark.createDataFrame([(1, 10)], "k int, total int")
    out = attach(child, agg, "k", {"total": 0})
    assert rows(out, "v", "total") == [(5, 10), (6, 0), (7, 0)]


def test_reconcile_flags_missing(spark):
    rep = spark.createDataFrame([(1, 10), (2, 20)], "id int, a int")
    reb = spark.createDataFrame([(1, 7)], "id int, b int")
    out = reconcile(rep, reb, "id", {"diff": ("a", "mine", "b", "theirs")}, "missing")
    assert rows(out, "id", "mine", "theirs", "diff", "missing") == [
        (1, 10, 7, 3, False), (2, 20, None, None, True)]


def test_quality_checks_and_report(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, None, 1), (None, "b", -1), (None, "c", None)], "k int, s string, v int"
    )
    parent = spark.createDataFrame([(2,)], "k int")
    assert check_not_null(df, "s").count() == 1
    assert rows(check_unique(df, "k"), "k", "n_records") == [(1, 2)]
    assert rows(check_unique_combination(df.select("k"), ["k"]), "k", "n_records") == [
        (None, 2), (1, 2)]
    assert rows(check_expression(df, F.col("v") >= 0), "k", "v") == [(None, -1)]
    assert check_relationship(df, "k", parent, "k").count() == 2
    report = quality_report([
        Check("a", "error", check_not_null(df, "s")),
        Check("b", "warn", check_unique(df, "k")),
        Check("c", "error", check_unique(parent, "k")),
    ])
    assert rows(report, "check_name", "failures", "status") == [
        ("a", 1, "fail"), ("b", 1, "warn"), ("c", 0, "pass")]


def test_default_calendar(spark):
    cal = date_dim(spark)
    assert cal.count() == 4748 == day_count("2018-01-01", "2030-12-31")
    got = {r.date_day: r for r in cal.collect()}
    for d in [dt.date(2018, 1, 1), dt.date(2024, 2, 29), dt.date(2030, 12, 31)]:
        r = got[d]
        assert r.year == d.year and r.month == d.month and r.day_of_month == d.day
        assert r.quarter == (d.month - 1) // 3 + 1
        assert r.day_of_week == (d.isoweekday() % 7) + 1  # 1 = Sunday
        assert r.is_weekend == (d.isoweekday() in (6, 7))
        assert r.week_of_year == d.isocalendar()[1]
        assert r.month_name == d.strftime("%B") and r.day_name == d.strftime("%A")


def test_spine_covering_the_data(spark):
    df = spark.createDataFrame(
        [(dt.date(2020, 1, 3),), (None,), (dt.date(2020, 1, 1),)], "d date"
    )
    assert rows(date_spine_covering(df, "d"), "date_day") == [
        (dt.date(2020, 1, 1),), (dt.date(2020, 1, 2),), (dt.date(2020, 1, 3),)]
    assert date_spine_covering(df.where("d IS NULL"), "d").count() == 0
    assert date_spine(spark, "2020-01-01", "2020-01-10").count() == 10


def test_bounded_broadcast_only_below_bound(spark):
    df = spark.range(10)
    small = spark.range(100).join(bounded_broadcast(df, 10), "id")
    big = spark.range(100).join(bounded_broadcast(df, 10**9), "id")
    assert "broadcast" in small._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in big._jdf.queryExecution().analyzed().toString().lower()


def test_income_by_period_pre_aggregation_matches_naive(spark):
    from decimal import Decimal

    from estrella.plans.marts import PERIOD_KEYS, income_by_period

    pay = spark.createDataFrame(
        [("u1", dt.date(2020, 1, 5), "B", "F", "C", "S", Decimal("1.50")),
         ("u1", dt.date(2020, 1, 5), "B", "F", "C", "S", Decimal("2.00")),
         ("u2", None, "B", "F", "C", "S", Decimal("3.00")),
         ("u3", dt.date(2020, 2, 1), None, "F", "C", "S", None)],
        "unidad_key string, fecha_ingreso date, banco string, forma_pago string, concepto string, "
        "status_ingreso string, monto_pagado decimal(18,2)",
    )
    # u1 repeats in the units dimension (grain break): its payments fan out
    units = spark.createDataFrame(
        [("u1", "D1", "C1", "E1"), ("u1", "D1", "C2", "E1"), ("u2", "D2", "C1", None)],
        "unidad_key string, desarrollo_largo string, desarrollo_corto string, etapa string",
    )
    cal = date_dim(spark, "2020-01-01", "2020-01-31")
    got = income_by_period(pay, units, cal)
    naive = (
        pay.join(units, "unidad_key", "left")
        .join(cal, F.col("fecha_ingreso") == F.col("date_day"), "left")
        .groupBy(*PERIOD_KEYS)
        .agg(F.count(F.lit(1)).alias("numero_movimientos"),
             F.sum("monto_pagado").cast("decimal(38,2)").alias("total_ingresado"))
    )
    cols = [*PERIOD_KEYS, "numero_movimientos", "total_ingresado"]
    assert rows(got, *cols) == rows(naive, *cols)


def test_seed_csv_reader(spark, tmp_path):
    from estrella.sources import read_seed_csv

    p = tmp_path / "seed.csv"
    p.write_text(
        "GRUPO,DESARROLLO_CORTO,DESARROLLO_LARGO,GRUPO_2\n"
        "Santamar,SANTA  MAR,SANTA MARÍA,SANTAMAR\nSANTAMAR,SM,SANTA MARIA II,SANTAMAR\n",
        encoding="utf-8",
    )
    df = read_seed_csv(spark, str(p))
    assert df.columns == ["grupo", "desarrollo_corto", "desarrollo_largo", "grupo_2"]
    assert rows(df, "desarrollo_largo") == [("SANTA MARIA II",), ("SANTA MARÍA",)]


def test_layer_routing_and_publish(spark, tmp_path):
    from estrella.sources import layer_location, publish, schema_name

    assert schema_name("dev", "dev_x", "marts") == "dev_x"
    assert schema_name("ci", "ci", "marts") == "ci"
    assert schema_name("prod", "default", " marts ") == "marts"
    assert schema_name("prod", "default", None) == "default"
    assert layer_location("/r", "marts", "t", "prod", "default") == os.path.join("/r", "marts", "t")
    df = spark.range(5)
    root = str(tmp_path)
    assert publish(df, "marts", "t", root).count() == 5
    # full refresh replaces the table
    assert publish(df.where("id < 2"), "marts", "t", root).count() == 2
    view = publish(df, "staging", "v", root)
    assert spark.table("staging__v").count() == 5 and view.count() == 5
    assert publish(df, "int", "e", root) is df


def test_table_report_counts_like_the_single_checks(spark):
    from estrella.operators import TableChecks, table_report
    from estrella.operators.quality import with_status

    df = spark.createDataFrame(
        [(1, "a", 1), (1, None, 1), (None, "b", -1), (None, "c", None), (2, "=", 5), (2, "", 5)],
        "k int, s string, v int",
    )
    parent = spark.createDataFrame([(2,), (None,)], "k int")
    checks = TableChecks(
        not_null=("k", "s"), unique=("k", "s"), combinations=(("k",), ("k", "v"), ("s",)),
        expressions=("v >= 0",), relationships=(("k", "parent", "k"),), severity="warn",
    )
    got = {r.check_name: r.failures for r in table_report("t", checks, {"t": df, "parent": parent}).collect()}
    assert list(got) == checks.names("t") or set(got) == set(checks.names("t"))
    assert got == {
        "not_null_t_k": check_not_null(df, "k").count(),
        "not_null_t_s": check_not_null(df, "s").count(),
        "expression_t_1": check_expression(df, F.col("v") >= 0).count(),
        "unique_t_k": check_unique(df, "k").count(),
        "unique_t_s": check_unique(df, "s").count(),
        "unique_combination_t_k": check_unique_combination(df, ["k"]).count(),
        "unique_combination_t_k_v": check_unique_combination(df, ["k", "v"]).count(),
        "unique_combination_t_s": check_unique_combination(df, ["s"]).count(),
        "relationship_t_k": check_relationship(df, "k", parent, "k").count(),
    }
    empty = table_report("t", checks, {"t": df.limit(0), "parent": parent})
    assert {r.status for r in with_status(empty).collect()} == {"pass"}


def test_conflicting_keys_are_the_audit_s_keys(spark):
    from estrella.operators import conflicting_keys

    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "y", 1), ("b", "x", None), ("b", None, 2), (None, "x", 1), (None, "x", 2), ("c", None, None)],
        "k string, s string, n int",
    )
    values = {"s": F.col("s"), "n": F.col("n")}
    audit = distinct_value_conflicts(df, ["k"], values)
    assert rows(audit, "k", "s", "n") == [(None, 1, 2), ("a", 2, 1)]
    assert rows(conflicting_keys(df, ["k"], values), "k") == [(None,), ("a",)]
