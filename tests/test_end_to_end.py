"""Raw report rows through staging and facts to the marts, with expected values worked out
by hand, so that a misread rule cannot hide in a query and its SQL twin alike."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from estrella.functions import percent_half_up, repair_mojibake
from estrella.plans import marts as M
from estrella.plans import staging as S
from estrella.plans import warehouse as W
from estrella.plans.audits import CATALOGUE, SINGULAR

D = dt.date


def raw(spark, rows, columns):
    """Rows as dicts over upper-case text columns; what a row leaves out is null."""
    schema = ", ".join(f"`{c}` {t}" for c, t in columns.items())
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], schema)


TEXT = "string"
SALE_RAW = dict(id_venta="bigint", DESARROLLO_LARGO=TEXT, DESARROLLO_CORTO=TEXT, UNIDAD=TEXT, MODELO=TEXT,
                STATUSUNIDAD=TEXT, EQUIPO=TEXT, STATUSVENTA=TEXT, PLAN=TEXT, PRECIOVENTA="decimal(18,2)",
                FECHAPRIMERENGANCHE=TEXT, FECHAULTIMOPAGOENGANCHE=TEXT)
PARTY_RAW = {c: TEXT for c in (
    "DESARROLLO_LARGO DESARROLLO_CORTO UNIDAD ETAPA ASESOR STATUSVENTA FECHACONTRATO FECHAFIRMACONTRATO PLAN "
    "STATUSESCRITURA FECHAESCRITURA VALORESCRITURA FECHAPROSPECTACION FECHAREGISTROVENTA FECHAAPROBACIONJD "
    "FECHAREGISTROCARGACONTRATO ENTRODV NOMBRECLIENTE APELLIDOPATERNO APELLIDOMATERNO EDAD LUGARNACIMIENTO RFC "
    "CURP CALLE NOEXTERIOR NOINTERIOR COLONIA CODIGOPOSTAL LOCALIDAD ESTADO PAIS NACIONALIDAD OCUPACION EMAIL "
    "TELEFONOCELULAR TELEFONOLOCAL IDENTIFICACION NOIDENTIFICACION SEXO ESTADOCIVIL REGIMEN").split()}
PARTY_RAW |= dict(id_venta="bigint", NOMENSUALIDADES="int", PRECIOVENTA="decimal(18,2)", ENGANCHE="decimal(18,2)",
                  FINANCIAMIENTO="decimal(18,2)", DIAPAGO="int")
PAYMENT_RAW = {c: TEXT for c in (
    "STATUSVENTA CONCEPTO DESARROLLOLARGO DESARROLLOCORTO UNIDAD ETAPA CLIENTE STATUS_TERCERO NOMBRETERCERO "
    "STATUSINGRESO FOLIO FECHA_INGRESO FECHA_ARMOTIZACION BANCO FORMAPAGO REFERENCIAINGRESOS MONTOPAGADO "
    "FECHA_CAPTURA").split()} | dict(id_venta="bigint")
DASH_RAW = {c: TEXT for c in (
    "EQUIPO DESARROLLO_LARGO DESARROLLO_CORTO UNIDAD MODELO ETAPA PRECIOLISTA PRECIOM2 ASESOR STATUSUNIDAD "
    "STATUSVENTA CLIENTE CAMPANIA VENDEDOREXTERNO FECHADESTATUS PLAN PRECIOVENTA PRECIOM2V ENGANCHE "
    "FINANCIAMIENTO TOTAL_COBRADO SALDOTOTAL TOTALVENCIDO SIELTOTALCOBRADOESMENORQUEELENGANCHE "
    "REQUIERE_FACTURA FECHAPRIMERENGANCHE FECHAULTIMOPAGOENGANCHE MONTODELPRIMERENGANCHE COMISIONASESOR "
    "COMISIONCASA").split()} | dict(id_venta="bigint", NUMEROMENSUALIDES="int", NUMEROENGANCHES="int")


@pytest.fixture(scope="module")
def star(spark):
    sales = S.stage_sales(raw(spark, [
        dict(id_venta=1, DESARROLLO_LARGO=" mar ", DESARROLLO_CORTO="m", UNIDAD="a-1", PRECIOVENTA=Decimal("100"),
             FECHAULTIMOPAGOENGANCHE=" NULL ", PLAN="48 MEESES x", STATUSVENTA=" VENDIDO "),
        dict(id_venta=2, DESARROLLO_LARGO="Mar", UNIDAD="A-2", PRECIOVENTA=Decimal("50"),
             FECHAULTIMOPAGOENGANCHE="2024-02-01", FECHAPRIMERENGANCHE="NULL"),
        dict(id_venta=3, DESARROLLO_LARGO="MAR", UNIDAD="A-3", PRECIOVENTA=Decimal("80")),
        dict(id_venta=4, DESARROLLO_LARGO="MAR", UNIDAD="A-4", PRECIOVENTA=Decimal("70")),
        dict(id_venta=5, PRECIOVENTA=Decimal("70")),  # a sale without a unit stays in the facts
    ], SALE_RAW))
    main = S.stage_parties(raw(spark, [
        dict(id_venta=1, DESARROLLO_LARGO="mar", DESARROLLO_CORTO="M", UNIDAD="A-1", ETAPA=" E1 ", ASESOR="ana",
             FECHACONTRATO=" 2024-01-05 ", VALORESCRITURA="NULL", CALLE=" Calle  Sol ", PLAN="CONTADO 5%",
             NOMBRECLIENTE="luz", CURP="c1", EDAD="CUARENTA Y DOS", ENGANCHE=Decimal("9"), DIAPAGO=3),
        dict(id_venta=2, DESARROLLO_LARGO="mar", DESARROLLO_CORTO="M", UNIDAD="A-2", VALORESCRITURA=" NULL ",
             NOMBRECLIENTE="sol", RFC="r2", EMAIL="X@y.z"),
        dict(id_venta=3, DESARROLLO_LARGO="mar", DESARROLLO_CORTO="M", UNIDAD="A-3"),
        dict(id_venta=4, DESARROLLO_LARGO="mar", DESARROLLO_CORTO="M", UNIDAD="A-4"),
    ], PARTY_RAW), S.ROLE_MAIN, False)
    co = S.stage_parties(raw(spark, [dict(id_venta=1, NOMBRECLIENTE="paz", CURP="c9", VALORESCRITURA=" NULL ")],
                             PARTY_RAW), S.ROLE_CO_OWNER, False)
    pay = W.fact_payments(S.stage_payments(raw(spark, [
        dict(id_venta=1, STATUSINGRESO=" Activo ", MONTOPAGADO="100", FOLIO="1"),
        dict(id_venta=1, STATUSINGRESO="Cancelado", MONTOPAGADO="30", FOLIO="2"),
        dict(id_venta=2, STATUSINGRESO="ACTIVO", MONTOPAGADO="20.005", FOLIO="3"),
        dict(id_venta=2, STATUSINGRESO="Activo", MONTOPAGADO="1,234.50", FOLIO="4"),
        dict(id_venta=3, STATUSINGRESO="activo", MONTOPAGADO="8", FOLIO="5"),
        dict(id_venta=5, STATUSINGRESO="Activo", MONTOPAGADO="7", FOLIO="6"),
    ], PAYMENT_RAW)))
    over = W.fact_overdue(S.stage_overdue(raw(spark, [
        dict(id_venta=2, DIASATRASO=5, NOPAGO=1, FECHAPAGO="2024-03-01", MONTOVENCIDO=Decimal("4"), TIPOPAGO="x"),
    ], {c: TEXT for c in "EQUIPO DESARROLLOLARGO DESARROLLOCORTO UNIDAD CLIENTE CORREOELECTRONICO TELEFONOCELULAR "
        "TELEFONOLOCAL FECHAPAGO TIPOPAGO".split()} | dict(id_venta="bigint", DIASATRASO="int", NOPAGO="int",
                                                           MONTOVENCIDO="decimal(18,2)"))))
    dash = S.stage_dashboard(raw(spark, [dict(id_venta=1, PRECIOM2V="12", REQUIERE_FACTURA="SI", COMISIONCASA="NULL",
                                              DESARROLLO_CORTO="DEMO 2024")] * 2, DASH_RAW), "COMISIONCASA", "comision_casa")
    seed = spark.createDataFrame([("MAR", "M", "COSTA")], "desarrollo_largo string, desarrollo_corto string, grupo_2 string")
    units = W.dim_units(sales, W.unit_attributes(main), seed)
    core = W.sale_core(sales, W.sale_attributes(main), dash)
    parties = W.sale_parties(main, co)
    per_sale = M.parties_per_sale(W.bridge_sale_party(parties, W.sale_keys_of(sales)), W.dim_parties(parties))
    return dict(sales=sales, main=main, co=co, pay=pay, over=over, dash=dash, units=units, core=core, per_sale=per_sale)


def test_all_four_collection_statuses_with_active_income(star):
    got = {r.id_venta: r for r in M.rebuilt_collections(star["core"], star["units"], star["pay"], star["over"]).collect()}
    assert {k: r.estatus_cobranza_estimado for k, r in got.items()} == {
        1: "cobrado_total", 2: "con_vencido", 3: "cobranza_al_corriente", 4: "sin_ingresos"}
    assert got[1].total_cobrado == Decimal("100.00") and got[1].total_cobrado_bruto == Decimal("130.00")
    # an amount with a thousands separator is no number; a third decimal is rounded
    assert got[2].total_cobrado == Decimal("20.01") and got[2].numero_movimientos_ingreso == 1
    assert got[3].porcentaje_cobrado == Decimal("10.00")


def test_collections_mart_keeps_every_sale(star):
    mart = M.collections_by_sale(W.fact_of_core(star["core"]), star["units"], star["pay"])
    got = {r.id_venta: r for r in mart.collect()}
    assert set(got) == {1, 2, 3, 4, 5}
    assert (got[1].total_ingresado_bruto, got[1].total_ingresado_activo) == (Decimal("130.00"), Decimal("100.00"))
    assert got[1].saldo_estimado == 0 and got[1].unidad == "A-1" and got[1].etapa == "E1" and got[1].asesor == "ANA"
    assert got[5].unidad is None and got[5].total_ingresado_activo == Decimal("7.00")


def test_commercial_mart_from_raw_rows(star):
    got = {r.id_venta: r for r in M.commercial_sales(star["core"], star["units"], star["per_sale"]).collect()}
    one = got[1]
    assert (one.cliente_principal, one.numero_copropietarios, one.tiene_copropietarios) == ("LUZ", 1, True)
    assert (one.plan, one.fecha_contrato, one.dia_pago, one.enganche) == ("48 MESES", D(2024, 1, 5), 3, Decimal("9"))
    assert one.fecha_ultimo_pago_enganche is None and got[2].fecha_ultimo_pago_enganche == D(2024, 2, 1)
    assert got[2].email_cliente_principal == "x@y.z" and got[2].numero_copropietarios == 0
    assert set(got) == {1, 2, 3, 4, 5} and got[5].cliente_principal is None


def test_cleaning_of_each_party_report(spark, star):
    assert {r.id_venta: r.valor_escritura for r in star["main"].collect()} == {1: None, 2: " NULL ", 3: None, 4: None}
    assert star["co"].first().valor_escritura is None
    canceled = S.stage_parties(raw(spark, [dict(id_venta=1, VALORESCRITURA="NULL", FECHACONTRATO="2024-01-05")],
                                   PARTY_RAW), S.ROLE_MAIN, True).first()
    assert canceled.valor_escritura == "NULL" and canceled.es_venta_cancelada
    one = star["main"].where("id_venta = 1").first()
    assert one.calle == " Calle  Sol " and one.edad == 42 and one.etapa == "E1"


def test_invoice_folio_keeps_its_case(spark):
    cols = {c: TEXT for c in "FOLIOGENERAL_FACTURA UUID UUI_DRELACIONADO RFC_EMISOR RFC_RECEPTOR RAZON_SOCIAL_EMISOR "
            "RAZON_SOCIAL_RECEPTOR FECHA_TIMBRADO TIPO_FACTURA TOTAL_FACTURA FOLIO_SEGUIMIENTO TIPO_PAGO".split()}
    rows = raw(spark, [dict(FOLIOGENERAL_FACTURA=" f-1 "), dict(FOLIOGENERAL_FACTURA="F-1")], cols)
    got = W.fact_invoices(S.stage_invoices(rows)).collect()
    assert [r.folio_general for r in got] == ["f-1", "F-1"] and got[0].factura_key != got[1].factura_key


def test_repeated_report_rows_are_one_dashboard_row(star):
    rows = star["dash"].collect()
    assert len(rows) == 1 and rows[0].comision_casa is None and len(rows[0]) == 33
    assert M.legacy_dashboard(star["dash"], None, star["units"]).count() == 0  # a demo development


def test_output_columns(star):
    assert len(star["main"].columns) == 50 and len(W.fact_of_core(star["core"]).columns) == 27
    commercial = M.commercial_sales(star["core"], star["units"], star["per_sale"]).columns
    assert commercial == """venta_key id_venta desarrollo_largo desarrollo_corto etapa unidad modelo status_venta
        status_unidad status_escritura plan equipo asesor cliente_principal email_cliente_principal
        telefono_cliente_principal numero_copropietarios tiene_copropietarios fecha_contrato fecha_firma_contrato
        fecha_primer_enganche fecha_ultimo_pago_enganche fecha_escritura fecha_prospectacion fecha_registro_venta
        precio_venta enganche financiamiento valor_escritura num_mensualidades dia_pago entro_dv""".split()


def test_line_separators_at_the_end_do_not_fail_the_repair(spark):
    texts = ["a\u2028", "a\u2029", "MÃ©XICO\u2028", "\u2028", "é\n", "MÃ©X\n", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(repair_mojibake(F.col("t"))).collect()] == [
        "a\u2028", "a\u2029", "MÃ©XICO\u2028", "\u2028", "é\n", "MéX\n", None]


def test_percent_of_very_large_sums(spark):
    df = spark.createDataFrame(
        [(Decimal("5000000000000.00"), Decimal("0.01")), (Decimal("9" * 30), Decimal("0.01")),
         (Decimal("-1.00"), Decimal("3.00"))],
        "n decimal(38,2), d decimal(18,2)",
    )
    got = [r[0] for r in df.select(percent_half_up("n", "d")).collect()]
    assert got[0] == Decimal("50000000000000000.00") and got[1] is None and got[2] == Decimal("-33.33")


def test_catalogue_is_complete():
    generic = sum(len(c.names(t)) for t, c in CATALOGUE.items())
    assert (generic, len(SINGULAR)) == (96, 7)
    assert [n for n, sev, _ in SINGULAR if sev == "warn"] == [
        "conflictos_persona_natural_key", "unidades_sin_grupo", "ventas_con_mas_de_un_cliente_principal"]


def test_written_tables_need_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace as N

    from estrella.session import ensure_checkpoint_dir

    conf = N(get=lambda key, default=None: default)
    context = N(getConf=lambda: conf, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(N(sparkContext=context, conf=conf))
