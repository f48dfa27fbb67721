"""Publish gate, frames written once, joins with missing keys, uniqueness in two passes."""

import collections
import re

import pytest
from pyspark.sql import functions as F

from estrella.operators import TableChecks, left_join_spread, table_report
from estrella.operators.quality import with_status
from estrella.plans import marts as M
from estrella.plans import warehouse as W
from estrella.plans.build import build_all
from estrella.sources import shared
from estrella.sources.gate import PublishBlocked, publish_checked
from estrella.sources.sinks import layer_location
from estrella.sources.tables import Tables
from estrella.sources.versions import read_version, replace_table, stage, versions


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, table):
    return len(re.findall(rf"FileScan parquet[^\n]*/{table}\.parquet", physical(df)))


# ---- gate


def checked(candidates, checks):
    report = None
    for name, c in checks.items():
        one = table_report(name, c, {n: x.read() for n, x in candidates.items()})
        report = one if report is None else report.unionByName(one)
    return publish_checked(candidates, with_status(report))


def test_a_failed_error_check_leaves_the_old_tables(spark, tmp_path):
    at = {n: str(tmp_path / n) for n in ("a", "b")}
    good = spark.createDataFrame([(1, "x"), (2, "y")], "id long, v string")
    for path in at.values():
        replace_table(good, path)
    bad = spark.createDataFrame([(1, "x"), (1, "z"), (None, "y")], "id long, v string")
    candidates = {"a": stage(good.where("id = 1"), at["a"]), "b": stage(bad, at["b"])}
    with pytest.raises(PublishBlocked) as blocked:
        checked(candidates, {"a": TableChecks(not_null=("id",)), "b": TableChecks(not_null=("id",), unique=("id",))})
    assert {(o.check_name, o.failures) for o in blocked.value.failed} == {("not_null_b_id", 1), ("unique_b_id", 1)}
    assert all(rows(read_version(spark, path)) == rows(good) for path in at.values())
    assert versions(spark, at["a"]) == [1]


def test_warnings_are_reported_and_publish(spark, tmp_path):
    at = str(tmp_path / "t")
    candidate = stage(spark.createDataFrame([(None,)], "id long"), at)
    outcomes = checked({"t": candidate}, {"t": TableChecks(not_null=("id",), severity="warn")})
    assert [(o.status, o.failures) for o in outcomes] == [("warn", 1)]
    assert read_version(spark, at).count() == 1


def test_a_gated_build_publishes_nothing_when_checks_fail(spark, sf_small, tmp_path):
    old = replace_table(spark.range(3), layer_location(str(tmp_path), "marts", "period_mart", "prod", "default"))
    with pytest.raises(PublishBlocked) as blocked:  # the test tables have findings of severity error
        build_all(spark, sf_small, str(tmp_path), audits=False, gate=True)
    assert any(o.status == "warn" for o in blocked.value.outcomes) and len(blocked.value.outcomes) == 103
    at = layer_location(str(tmp_path), "marts", "period_mart", "prod", "default")
    assert rows(read_version(spark, at)) == rows(old) and versions(spark, at) == [1]
    assert versions(spark, layer_location(str(tmp_path), "warehouse", "fct_sales", "prod", "default")) == []


# ---- frames with several readers

BUILDS = {
    "dash_rebuilt": M.rebuilt_dashboard_of,
    "overdue_mart": lambda t: M.overdue_by_sale(
        W.fact_overdue(M.staged_overdue(t)), W.units_dimension(t), W.sales_fact_of(t)
    ),
    "reconcile": lambda t: M.reconcile_dashboards(
        M.legacy_dashboard(M.staged_dashboard(t), None, W.units_dimension(t)), M.rebuilt_collections_of(t)
    ),
}


@pytest.mark.parametrize("key", sorted(BUILDS))
def test_shared_frames_are_written_once_and_give_the_same_rows(spark, sf_small, key):
    plain = BUILDS[key](Tables(spark, sf_small))
    once = shared.build_shared(spark, sf_small, BUILDS[key], least_bytes=0)
    for table in ("orders", "customer", "lineitem", "supplier", "nation"):
        assert scans(once, table) <= 2, table
    assert scans(once, "orders") < scans(plain, "orders")
    assert rows(once) == rows(plain)


def test_small_inputs_are_computed_again(spark, sf_small):
    df = shared.build_shared(spark, sf_small, M.rebuilt_dashboard_of)
    assert scans(df, "orders") > 2
    assert shared.input_bytes(df) > 10_000


def test_readers_are_counted_without_those_inside(spark, sf_small):
    calls = []

    @shared.named
    def inner(t):
        calls.append("inner")
        return t.orders.select("o_orderkey")

    @shared.named
    def outer(t, times=1):
        return inner(t).withColumn("n", F.lit(times))

    def build(t):
        a = outer(t).unionAll(outer(t)).unionAll(outer(t, times=2))
        return a

    assert shared.readers(spark, sf_small, build) == {"outer": 2, "outer-times=2": 1, "inner": 2}
    n = spark.read.parquet(f"{sf_small}/orders.parquet").count()
    got = shared.build_shared(spark, sf_small, build, least_bytes=0)
    assert got.groupBy("n").count().collect() and got.count() == 3 * n and scans(got, "orders") == 0


# ---- missing keys


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_rows_without_a_key_are_dealt_evenly(spark, no_broadcast):
    left = spark.range(0, 9000, 1, 4).select(
        F.when(F.col("id") % 3 != 0, (F.col("id") % 700).cast("string")).alias("k"), "id"
    )
    right = spark.range(500).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("x"))
    right = right.unionAll(spark.createDataFrame([(None, -1)], "k string, x long"))
    got = left_join_spread(left, right, "k", ["id"])
    assert rows(got) == rows(left.join(right, "k", "left"))
    sizes = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2]
    plain = left.join(right, "k", "left").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))
    assert max(r["n"] for r in plain.collect()) >= 3000
    two = left_join_spread(left.withColumn("j", F.lit(1)), right.withColumn("j", F.lit(1)), ["k", "j"], ["id"])
    assert rows(two.drop("j")) == rows(got)
    assert left_join_spread(left.limit(0), right, "k", ["id"]).collect() == []


def test_overdue_mart_reads_the_lines_once(spark, sf_small):
    plan = M.overdue_mart(spark, sf_small)
    assert scans(plan, "lineitem") == 1 and "Union" not in physical(plan)


# ---- uniqueness


def test_uniqueness_of_odd_keys_and_of_digests_that_meet(spark, monkeypatch):
    data = [("a", "b", 1), ("a", "b", 1), ("ab", "", 2), ("a", None, 3), ("a", None, 4), (None, None, None), (None, None, None)]
    df = spark.createDataFrame(data, "x string, y string, z long")
    checks = TableChecks(unique=("x", "y", "z"), combinations=(("x", "y"), ("y", "x", "z")))

    def by_hand():
        out = []
        for cols, nulls in (("x", False), ("y", False), ("z", False), ("xy", True), ("yxz", True)):
            at = ["xyz".index(c) for c in cols]
            keys = collections.Counter(tuple(r[i] for i in at) for r in data)
            out.append(sum(n > 1 and (nulls or k[0] is not None) for k, n in keys.items()))
        return out

    def failures():
        found = {r["check_name"]: r["failures"] for r in table_report("t", checks, {"t": df}).collect()}
        return [found[n] for n in checks.names("t")]

    assert failures() == by_hand()
    # every digest the same: the second pass tells the keys apart
    monkeypatch.setattr(F, "xxhash64", lambda *cols: F.lit(7).cast("bigint"))
    assert failures() == by_hand()
