"""Mart and warehouse functions on hand-made fixtures (FIXTURES.md §3 branches)."""

import datetime as dt
from decimal import Decimal

from estrella.plans import marts as M
from estrella.plans import warehouse as W
from estrella.plans.audits import main_customer_count_audit, party_key_conflicts_of

D = dt.date


def test_role_pivot_and_main_customer_audit(spark):
    # sale v0: no parties; v1: one main + 3 co-owners; v2: two main customers
    bridge = spark.createDataFrame(
        [("v1", "p1", "cliente_principal"), ("v1", "c1", "copropietario"),
         ("v1", "c2", "copropietario"), ("v1", "c3", "copropietario"),
         ("v2", "p1", "cliente_principal"), ("v2", "p2", "cliente_principal")],
        "venta_key string, persona_key string, rol_persona_en_venta string",
    )
    dim = spark.createDataFrame(
        [("p1", "ANA", "a@x", "55"), ("p2", "ZOE", None, "56"), ("c1", "C", "c@x", None)],
        "persona_key string, nombre_completo string, email string, telefono_celular string",
    )
    per_sale = {r.venta_key: r for r in M.parties_per_sale(bridge, dim, "venta_key").collect()}
    assert per_sale["v1"].cliente_principal == "ANA" and per_sale["v1"].numero_copropietarios == 3
    # two main customers: max() picks one silently; the audit exposes the sale
    assert per_sale["v2"].cliente_principal == "ZOE" and per_sale["v2"].email_cliente_principal == "a@x"
    assert per_sale["v2"].numero_copropietarios == 0
    sales = spark.createDataFrame([("v0", 0), ("v1", 1), ("v2", 2)], "venta_key string, id_venta int")
    flagged = {(r.venta_key, r.clientes_principales) for r in main_customer_count_audit(sales, bridge).collect()}
    assert flagged == {("v0", 0), ("v2", 2)}


def test_party_identity_dim_and_conflicts(spark):
    rows = [
        # same curp with two rfcs and two e-mails -> one party, flagged
        (1, "CURP1", "RFC1", "A@X.com", "ANA", "P", None, "55", "MEXICO"),
        (2, "CURP1", "RFC2", "b@x.com", "ANA", "P", None, "55", "USA"),
        # e-mail identity, mixed case collapses
        (3, None, "", "Mixed@Case.com", "LUIS", None, None, None, None),
        # nothing at all -> natural key ''
        (4, None, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(
        rows,
        "id_venta int, curp string, rfc string, email string, nombre_cliente string, "
        "apellido_paterno string, apellido_materno string, telefono_celular string, pais string",
    )
    from pyspark.sql import functions as F

    missing = [c for c in W.PARTY_DIM_ATTRS if c not in df.columns and c != "nombre_completo"]
    df = df.withColumns({c: F.lit(None).cast("string") for c in missing})
    parties = W.with_party_identity(df)
    keys = {r.id_venta: r.persona_natural_key for r in parties.collect()}
    assert keys == {1: "CURP1", 2: "CURP1", 3: "mixed@case.com", 4: ""}
    dim = {r.persona_natural_key: r for r in W.dim_parties(parties).collect()}
    assert dim["CURP1"].rfc == "RFC2" and dim["CURP1"].email == "b@x.com" and dim["CURP1"].pais == "USA"
    assert dim[""].nombre_completo == ""
    conflicts = {r.persona_natural_key: r for r in party_key_conflicts_of(parties).collect()}
    assert set(conflicts) == {"CURP1"}
    assert (conflicts["CURP1"].rfcs_distintos, conflicts["CURP1"].emails_distintos) == (2, 2)


def _schedule_rows(spark, rows):
    cols = ["desarrollo_largo", "desarrollo_corto", "unidad", "asesor", "cliente", "campania",
            *M.MILESTONE_COLS, "equipo"]
    rows = [(*r, "E") for r in rows]
    schema = ", ".join(f"{c} {'date' if c in M.MILESTONE_COLS else 'string'}" for c in cols)
    return spark.createDataFrame(rows, schema)


def test_schedule_ladder_gaps_and_null_units(spark):
    n = [None] * 7
    rows = [
        ("D", "d", "U1", "a", "c", "x", None, D(2020, 1, 1), D(2020, 1, 5), None, None, None, None),
        ("D", "d", "U1", "b", "c", "x", None, D(2020, 1, 3), None, None, None, D(2020, 2, 1), None),
        ("D", "d", "U2", "a", "c", "x", D(2020, 1, 1), *[None] * 6),
        ("D", "d", "U3", "a", "c", "x", *n),
        ("D", "d", None, "a", "c", "x", None, None, None, None, None, None, D(2021, 1, 1)),
    ]
    snap = {r.unidad: r for r in M.schedule_snapshot(_schedule_rows(spark, rows)).collect()}
    u1 = snap["U1"]
    assert u1.estatus_cronograma_actual == "finalizado"
    assert u1.fecha_proceso == D(2020, 1, 3) and u1.asesor == "b"  # independent maxima
    assert u1.dias_proceso_a_esperando_autorizacion == 2  # signed: 2020-01-05 - 2020-01-03
    assert u1.dias_proceso_a_finalizado == 29 and u1.dias_aprobado_juridico_a_finalizado is None
    assert snap["U2"].estatus_cronograma_actual == "rechazado"
    assert snap["U3"].estatus_cronograma_actual == "sin_estatus"
    # a null unit is its own group, and its key is the same hash as any other null unit
    assert snap[None].estatus_cronograma_actual == "finalizado_liquidado"
    import hashlib

    from estrella.functions.keys import SURROGATE_NULL_TOKEN

    expect = hashlib.md5(("D-" + SURROGATE_NULL_TOKEN).encode()).hexdigest()
    assert snap[None].unidad_key == expect


def _core(spark, rows):
    """A sale core with the given (id, development, unit, price); other columns null."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        rows, "id_venta int, desarrollo_largo string, unidad string, precio_venta decimal(18,2)"
    )
    rest = [c for c in W.SALE_FACT_COLS if c != "precio_venta"]
    return df.withColumns({c: F.lit(None).cast("string") for c in rest})


def test_collection_status_and_price_edges(spark):
    sales = _core(
        spark,
        [(1, "D", "U", Decimal("100.00")), (2, "D", "U", Decimal("0.00")), (3, "D", "U", None),
         (4, "D", "U", Decimal("-50.00")), (5, "D", "U", Decimal("80.00")),
         (6, "D", "U", Decimal("90.00")), (7, "X", None, Decimal("90.00")),
         (None, "D", "U", Decimal("10.00"))],
    )
    units = spark.createDataFrame(
        [("u", "G", "D", "S", "E", "U", "M"), ("ux", "G", "X", M.EXCLUDED_DEVELOPMENTS[0], "E", None, "M")],
        "unidad_key string, grupo string, desarrollo_largo string, desarrollo_corto string, "
        "etapa string, unidad string, modelo string",
    )
    pay = spark.createDataFrame(
        [(1, Decimal("100.00"), "Activo", D(2020, 1, 1)), (1, Decimal("5.00"), "Cancelado", D(2020, 1, 2)),
         (2, Decimal("10.00"), "ACTIVO", D(2020, 1, 1)), (3, Decimal("10.00"), "Activo", D(2020, 1, 1)),
         (4, Decimal("10.00"), "Activo", D(2020, 1, 1)), (5, Decimal("20.00"), "Activo", D(2020, 1, 1)),
         (7, Decimal("20.00"), "Activo", D(2020, 1, 1)), (None, Decimal("4.00"), "Activo", D(2020, 1, 1))],
        "id_venta int, monto_pagado decimal(18,2), status_ingreso string, fecha_ingreso date",
    )
    over = spark.createDataFrame(
        [(5, Decimal("7.00"), 3, D(2020, 1, 1)), (None, Decimal("9.00"), 1, D(2020, 1, 1))],
        "id_venta int, monto_vencido decimal(18,2), dias_atraso int, fecha_pago date",
    )
    got = {f"k{r.id_venta}": r for r in M.rebuilt_collections(sales, units, pay, over).collect()}
    # a missing sale id matches a missing one (equal hashes) for payments, never for overdue rows
    assert got["kNone"].total_cobrado == Decimal("4.00") and got["kNone"].total_vencido == 0
    assert "k7" not in got  # excluded development
    assert got["k1"].estatus_cobranza_estimado == "cobrado_total"
    assert got["k1"].porcentaje_cobrado == Decimal("100.00") and got["k1"].total_cobrado_bruto == Decimal("105.00")
    assert got["k2"].porcentaje_cobrado is None and got["k2"].estatus_cobranza_estimado == "cobrado_total"
    assert got["k3"].porcentaje_cobrado is None and got["k3"].saldo_total_estimado is None
    assert got["k3"].estatus_cobranza_estimado == "cobranza_al_corriente"
    assert got["k4"].porcentaje_cobrado == Decimal("-20.00")  # negative price: still computed
    assert got["k5"].estatus_cobranza_estimado == "con_vencido" and got["k5"].numero_pagos_vencidos == 1
    assert got["k6"].estatus_cobranza_estimado == "sin_ingresos" and got["k6"].total_cobrado == 0


def test_payment_fact_filters_and_keys(spark):
    cols = W.PAYMENT_KEY_COLS + ["desarrollo_largo", "unidad", "status_tercero", "nombre_tercero",
                                 "cliente"]
    schema = ", ".join(
        f"{c} {'bigint' if c == 'id_venta' else 'decimal(10,2)' if c == 'monto_pagado' else 'date' if c.startswith('fecha') else 'string'}"
        for c in cols
    )
    base = {c: None for c in cols}
    rows = [
        {**base, "id_venta": 1, "monto_pagado": Decimal("5.00"), "folio": "F1"},
        {**base, "id_venta": 1, "monto_pagado": None, "folio": "F2"},  # no amount: dropped
        {**base},  # all blank: dropped
        {**base, "monto_pagado": Decimal("1.00")},  # no sale id: kept, key hashes the null token
    ]
    df = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schema)
    out = W.fact_payments(df).collect()
    assert len(out) == 2
    assert {r.venta_key for r in out} == {
        spark.range(1).selectExpr("md5('1')").first()[0],
        spark.range(1).selectExpr("md5('_dbt_utils_surrogate_key_null_')").first()[0],
    }


def test_legacy_dashboard_exclusion_drops_null_short_names(spark):
    def row(i, corto):
        return (str(i), "D", "U", corto)

    schema = "id_venta string, desarrollo_largo string, unidad string, desarrollo_corto string"
    dash = spark.createDataFrame([row(1, "S"), row(2, None), row(3, M.EXCLUDED_DEVELOPMENTS[1])], schema)
    units = spark.createDataFrame([], "unidad_key string, grupo string")
    assert [r.id_venta for r in M.legacy_dashboard(dash, None, units).collect()] == ["1"]
    kept = M.legacy_dashboard(dash, None, units, excluded=["S"]).collect()
    assert [r.id_venta for r in kept] == ["3"]


def test_overdue_rows_without_keys_go_around_the_joins(spark):
    rows = [("v1", 1, "u1"), ("v1", 1, None), (None, None, "u1"), (None, None, None), ("v9", 9, "u9")]
    cols = ["cliente", "email", "telefono_celular", "telefono_local"]
    fact = spark.createDataFrame(
        [(*r, *cols, Decimal("1.00"), 2, D(2020, 1, 1)) for r in rows],
        "venta_key string, id_venta int, unidad_key string, " + ", ".join(f"{c} string" for c in cols)
        + ", monto_vencido decimal(18,2), dias_atraso int, fecha_pago date",
    )
    units = spark.createDataFrame(
        [("u1", "L", "C", "G", "U")],
        "unidad_key string, desarrollo_largo string, desarrollo_corto string, grupo string, unidad string",
    )
    sales = spark.createDataFrame([("v1", "E1"), (None, "never")], "venta_key string, equipo string")
    got = {(r.venta_key, r.unidad_key): (r.equipo, r.grupo) for r in M.overdue_by_sale(fact, units, sales).collect()}
    assert got == {("v1", "u1"): ("E1", "G"), ("v1", None): ("E1", None), (None, "u1"): (None, "G"),
                   (None, None): (None, None), ("v9", "u9"): (None, None)}
