"""What is joined to narrow rows and what the wide ones are spared, and tables written side by side."""

import datetime as dt
import re
import threading

import pytest
from pyspark.sql import functions as F

from estrella.plans import audits as A
from estrella.plans import build as B
from estrella.plans import marts as M
from estrella.plans import staging as S
from estrella.plans import warehouse as W
from estrella.plans.roles import EXCLUDED_SHORT_NAMES
from estrella.session import SCAN_BYTES, sized_session
from estrella.sources import shared
from estrella.sources.tables import SCHEMAS, Tables


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Sales, customers and suppliers that come twice, are unknown or have no key, customers without
    name or nation, and two of one name in two segments (a unit with two rows)."""
    folder = tmp_path_factory.mktemp("narrow")
    day = dt.datetime(2020, 1, 5)
    orders = [*((i, i % 47, "FOP"[i % 3]) for i in range(1, 400)), (7, 7, "P"), (None, 3, "P"), (9, None, "O"), (None, None, "F")]
    rows = {
        "region": [(0, "ASIA"), (1, "MIDDLE EAST")],
        "nation": [(k, f"NATION_{k}", k % 2) for k in range(8)],
        "customer": [(k, None if k % 11 == 0 else f"c{k // 2}", None if k % 9 == 0 else k % 4, float(k % 3 - 1), f"m{k % 3}")
                     for k in [*range(1, 45), 3, 5]] + [(None, "nobody", 1, 0.0, "m0")],
        "supplier": [(k, f"s{k}", 1, -1.0) for k in [*range(1, 30), 2, None]],
        "orders": [(k, c, s, 10.0 * (c or 1), day + dt.timedelta(days=(k or 0) % 90), "1-URGENT") for k, c, s in orders],
        "lineitem": [
            (o, 1 + i % 50, s, 1 + i % 4, 1.0, 3.25 * (i % 7), 0.0, 0.0, "NAR"[i % 3], "OF"[i % 2], day + dt.timedelta(days=i % 200))
            for i, (o, s) in enumerate([*((i % 90, i % 33) for i in range(600)), (5, None), (5, 900), (None, 2), (None, 2)])
        ],
        "events": [(i, day + dt.timedelta(hours=i), i % 50, ("error", "view", "click", "signup", "purchase")[i % 5], 1.0, "{}")
                   for i in range(300)],
    }
    for name, values in rows.items():
        spark.createDataFrame(values, SCHEMAS[name]).write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


@pytest.fixture
def shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def rows(df):
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, table):
    return len(re.findall(rf"FileScan parquet[^\n]*/{table}\.parquet", physical(df)))


def outermost_join(df):
    return re.search(r"Join \[([^\]]*)\]", physical(df)).group(1)


# ---- dashboards and marts by the sale


def test_units_and_schedule_are_joined_before_the_sales_grow_wide(spark, odd, shuffled):
    t = Tables(spark, odd)
    for df in (M.rebuilt_dashboard_of(t), M.rebuilt_collections_of(t), M.collections_of(t)):
        assert "__sale" in outermost_join(df)


def test_units_first_gives_the_same_rows(spark, odd):
    t = Tables(spark, odd)
    core, units, pay, over = W.matched_core_of(t), W.units_dimension(t), W.with_match(W.payment_measures(t)), W.with_match(W.overdue_measures(t))
    last = M.rebuilt_dashboard(core, units, M._parties_of(t), pay, over, M.schedule_of(t), excluded=EXCLUDED_SHORT_NAMES, key=W.MATCH)
    first = M.rebuilt_dashboard_of(t)
    assert first.columns == last.columns and rows(first) == rows(last)
    assert first.groupBy("id_venta").count().where("count > 1").count() > 0  # units of two rows
    by_key = M.collections_by_sale(W.fact_of_core(core, *W.MATCH), units, pay, key=W.MATCH)
    assert rows(M.collections_of(t)) == rows(by_key)


def test_natural_links_are_those_of_the_whole_party_rows(spark, odd):
    t = Tables(spark, odd)
    whole = W.require_present(W.sale_parties_of(t, distinct=False), "id_venta")
    links = W.natural_links(t)
    assert rows(links) == rows(whole.select(*links.columns).distinct())
    assert links.where("persona_natural_key = ''").count() > 0  # parties that no table knows


def test_parties_per_sale_of_odd_roles(spark):
    bridge = spark.createDataFrame(
        [(1, "a", "cliente_principal"), (1, "b", "cliente_principal"), (1, "c", "copropietario"), (2, "c", "copropietario"),
         (2, "d", "copropietario"), (3, "x", "cliente_principal"), (4, "a", None), (5, "a", "otro")],
        "id_venta long, persona_key string, rol_persona_en_venta string",
    )
    dim = spark.createDataFrame(
        [(k, f"n{k}", f"e{k}", f"t{k}") for k in "abcd"], "persona_key string, nombre_completo string, email string, telefono_celular string"
    )
    got = {r[0]: tuple(r)[1:] for r in M.parties_per_sale(bridge, dim).collect()}
    none = (None, None, None)
    assert got == {1: ("nb", "eb", "tb", 1), 2: (*none, 2), 3: (*none, 0), 4: (*none, 0), 5: (*none, 0)}


def test_co_owners_are_not_joined_to_the_party_dimension(spark, odd, shuffled):
    t = Tables(spark, odd)
    plan = M._parties_of(t)._jdf.queryExecution().optimizedPlan().toString()
    top = plan.index("Aggregate [persona_natural_key")  # the dimension; the links joined to it follow or precede
    assert "copropietario AS" not in plan[:top]
    assert "sum(__amount" in physical(M._income_per_sale(W.payments_fact_of(t), "activo"))


def test_narrow_frames_are_written_for_their_size(spark, odd):
    df = shared.build_shared(spark, odd, M.rebuilt_dashboard_of, 0, also=M.NARROW)
    assert scans(df, "events") == 0 and scans(df, "customer") == 0
    assert rows(df) == rows(M.rebuilt_dashboard_of(Tables(spark, odd)))


# ---- legacy dashboard


def test_legacy_rows_are_made_distinct_where_their_unit_is(spark, odd):
    t = Tables(spark, odd)
    plain = M.legacy_dashboard(S.staged_dashboard(t), M.schedule_of(t), W.units_dimension(t), EXCLUDED_SHORT_NAMES)
    dealt = M.legacy_dashboard_of(t)
    assert dealt.columns == plain.columns and rows(dealt) == rows(plain)
    assert dealt.where("unidad is null").count() > 0
    assert dealt.where("unidad is null and estatus_cronograma_actual is not null").count() > 0  # missing meets missing


def test_legacy_rows_move_once(spark, odd, shuffled):
    plan = physical(M.legacy_dashboard_of(Tables(spark, odd)))
    wide = [x for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan) if "comision_empresa" in x]
    assert not wide  # no exchange for the distinct rows of its own
    spread = re.findall(r"Exchange hashpartitioning\(__unit[^\n]*", plan)
    assert sum("REPARTITION" in x for x in spread) == 1 and len(spread) == 3  # the rows, the schedule, the units


def test_decisions_share_frames_and_store_candidates_small(spark, odd, monkeypatch):
    staged = {}
    stage = A.stage

    def seen(df, location, **how):
        staged[location.rsplit("/", 1)[1]] = (df, how)
        return stage(df, location, **how)

    expected = rows(A.publish_decisions(spark, odd))
    monkeypatch.setattr(A, "stage", seen)
    monkeypatch.setattr(M, "COLLECTIONS_SHARE_BYTES", 0)
    assert rows(A.publish_decisions(spark, odd)) == expected
    assert {n: scans(df, "customer") for n, (df, _) in staged.items()} == dict.fromkeys(A._GATED, 0)
    assert all(how["options"]["compression"] == "zstd" for _, how in staged.values())


# ---- full refresh


def test_refresh_writes_side_by_side_and_joins_orders_to_units_once(spark, odd, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "COLLECTIONS_SHARE_BYTES", 0)
    met, together, frames = threading.Barrier(2), [], {}

    class Lazy:
        def __init__(self, df):
            self.read = lambda: df

    def stage(df, location, **how):
        name = location.rsplit("/", 1)[1]
        frames[name] = df
        if name in ("stg_main_report", "stg_co_owner_report"):
            met.wait(30)  # each waits for the other: in a row they would never meet
            together.append(name)
        return Lazy(df)

    monkeypatch.setattr(B, "stage", stage)
    monkeypatch.setattr(B, "commit", lambda candidate: None)
    B.build_all(spark, odd, str(tmp_path), audits=False)
    assert len(together) == 2 and len(frames) == 26
    for name in ("stg_sale_list", "stg_main_report", "stg_dashboard", "stg_payments", "stg_overdue"):
        assert scans(frames[name], "orders") == 0, name


def test_a_failed_table_fails_the_refresh(spark, odd, tmp_path, monkeypatch):
    def stage(df, location, **how):
        raise RuntimeError("no room")

    monkeypatch.setattr(B, "stage", stage)
    with pytest.raises(RuntimeError, match="no room"):
        B.build_all(spark, odd, str(tmp_path), audits=False)


def test_scans_are_bounded_and_smaller_bounds_stay(spark):
    bound = "spark.sql.files.maxPartitionBytes"
    assert sized_session(spark, 1).conf.get(bound) == f"{SCAN_BYTES}b"
    before = spark.conf.get(bound)
    spark.conf.set(bound, "1m")
    try:
        assert sized_session(spark, 1).conf.get(bound) == f"{1 << 20}b"
    finally:
        spark.conf.set(bound, before)


def test_keys_are_counted_by_sixteen_bytes(spark):
    from estrella.operators.quality import _rows_of_keys, _uniqueness, _values
    from estrella.operators import TableChecks

    df = spark.createDataFrame([("a" * 40, "1"), ("a", "1a"), ("a1", "a"), (None, "-")], "x string, y string")
    found = _rows_of_keys(df, _uniqueness(TableChecks(unique=("x",), combinations=(("x", "y"),))), _values)
    assert {len(r["k"]) for r in found.collect()} == {16} and found.where("i = 0").count() == 3
    assert found.where("i = 1").select("k").distinct().count() == 4
    assert "ArrayFilter" not in physical(found) and "lambdafunction" not in physical(found)
