"""Uniqueness over written tables: only checks with a digest that occurs again count their keys."""

import pytest
from pyspark.sql import functions as F

from estrella.operators import TableChecks, suspect_checks, table_report
from estrella.plans import staging as S
from estrella.sources.tables import Tables

CHECKS = TableChecks(not_null=("x",), unique=("x", "y"), combinations=(("x", "y"), ("x", "z")))


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([("a", 1, 1), ("b", 1, 1), (None, 2, 3), (None, 3, 3), ("c", None, 9)], "x string, y int, z int")


def _found(report):
    return {r["check_name"]: r["failures"] for r in report.collect()}


def test_suspects_and_their_report(df):
    tables = {"t": df, "none": df}
    found = suspect_checks({"t": CHECKS, "none": TableChecks(not_null=("x",))}, tables)
    assert found == {"t": {1, 3}, "none": set()}  # y; (x, z), where nulls compare equal
    assert _found(table_report("t", CHECKS, tables, found["t"])) == _found(table_report("t", CHECKS, tables))


def test_tables_without_repeats_do_not_shuffle_their_keys(df):
    checks = TableChecks(unique=("x",), combinations=(("x", "y"),))
    tables = {"t": df}
    assert suspect_checks({"t": checks}, tables) == {"t": set()}
    report = table_report("t", checks, tables, set())
    assert "Exchange" not in report._jdf.queryExecution().toString()
    assert set(_found(report).values()) == {0}


def test_digests_that_meet_are_told_apart_by_the_keys(df, monkeypatch):
    exact = _found(table_report("t", CHECKS, {"t": df}))
    monkeypatch.setattr(F, "xxhash64", lambda *cols: F.lit(7).cast("bigint"))
    found = suspect_checks({"t": CHECKS}, {"t": df})["t"]
    assert found == {0, 1, 2, 3} and _found(table_report("t", CHECKS, {"t": df}, found)) == exact


def test_co_owner_report_is_that_of_the_raw_report(spark, sf_small):
    t = Tables(spark, sf_small)
    raw = S.stage_parties(S.raw_co_owner_report(t), S.ROLE_CO_OWNER, False)
    made = S.co_owner_report(t)
    assert made.columns == raw.columns and made.count() == raw.count()
    assert made.exceptAll(raw).count() == 0 == raw.exceptAll(made).count()
