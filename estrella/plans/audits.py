"""Data-quality checks, singular audits and ad-hoc analyses; sinks round trip.

Every audit returns its finding rows (empty = pass) over whole tables.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrella.functions import blank_normalised
from estrella.operators import (
    TableChecks,
    check_expression,
    check_not_null,
    check_relationship,
    check_unique,
    check_unique_combination,
    conflicting_keys,
    coverage,
    distinct_value_conflicts,
    find_duplicates,
    no_key_coverage,
    orphan_count,
    require_present,
    suspect_checks,
    table_report,
)
from estrella.operators.quality import with_status
from estrella.plans import marts as M
from estrella.plans import warehouse as W
from estrella.plans.basics import SQL_NULLABLE_ORDERS, _nullable_orders
from estrella.plans.registry import ORACLE_SQL, register
from estrella.plans.roles import SQL_GROUP_SEED, group_seed, sql_listed_times
from estrella.plans.staging import (
    ROLE_MAIN,
    SQL_CO_OWNER_REPORT,
    SQL_MAIN_REPORT,
    SQL_STAGE_DASHBOARD,
    SQL_STAGED_SALE_ROWS,
    SQL_STAGING_INVOICES,
    SQL_STAGING_OVERDUE,
    SQL_STAGING_PAYMENTS,
    SQL_STAGING_SCHEDULE,
    main_report,
    raw_payments,
    raw_sales,
    stage_payments,
    stage_sales,
    staged_dashboard,
    staged_overdue,
    staged_sale_rows,
    staged_schedule,
)
from estrella.sources.gate import PublishBlocked, publish_checked
from estrella.sources.lookup import read_seed_csv, seed_findings
from estrella.sources.ordered import read_ordered, write_ordered
from estrella.sources.sinks import layer_location, publish, shared_scratch_root
from estrella.sources.shared import build_shared, written_frames
from estrella.sources.tables import Tables
from estrella.sources.versions import read_version, replace_table, stage

# ---------------------------------------------------------------------------
# Generic checks (each returns failing rows)


@register(
    "check_not_null",
    f"SELECT * FROM ({SQL_NULLABLE_ORDERS}) WHERE status_venta IS NULL",
)
def check_not_null_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_not_null(_nullable_orders(Tables(spark, sf_dir)), "status_venta")


@register(
    "check_unique",
    """SELECT l_orderkey, count(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL
       GROUP BY l_orderkey HAVING count(*) > 1""",
)
def check_unique_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique(Tables(spark, sf_dir).lineitem.select("l_orderkey"), "l_orderkey")


@register(
    "check_unique_combo",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def check_unique_combo_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = Tables(spark, sf_dir).lineitem
    return check_unique_combination(l, ["l_orderkey", "l_linenumber"])


@register(
    "check_expression",
    f"SELECT * FROM ({W.SQL_FACT_OVERDUE}) WHERE NOT (dias_atraso >= 0)",
)
def check_expression_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overdue payments dated before their sale (``dias_atraso >= 0`` is false)."""
    fact = W.fact_overdue(staged_overdue(Tables(spark, sf_dir)))
    return check_expression(fact, F.col("dias_atraso") >= 0)


@register(
    "check_relationship",
    f"""
    SELECT c.unidad_key, c.desarrollo_largo, c.unidad
    FROM ({M.SQL_SCHEDULE_SNAPSHOT}) c
    WHERE c.unidad_key IS NOT NULL
      AND c.unidad_key NOT IN (SELECT unidad_key FROM ({W.SQL_DIM_UNITS}) WHERE unidad_key IS NOT NULL)
""",
)
def check_relationship_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schedule units with no row in the units dimension."""
    t = Tables(spark, sf_dir)
    schedule = M.schedule_of(t).select("unidad_key", "desarrollo_largo", "unidad")
    return check_relationship(schedule, "unidad_key", W.units_dimension(t), "unidad_key")


# ---------------------------------------------------------------------------
# Singular audits

# Output names of the sale-attribute audit.
CONFLICT_TEXT_COLS = {
    "desarrollos_largos_distintos": "desarrollo_largo",
    "desarrollos_cortos_distintos": "desarrollo_corto",
    "unidades_distintas": "unidad",
    "etapas_distintas": "etapa",
    "asesores_distintos": "asesor",
    "status_venta_distintos": "status_venta",
    "status_escritura_distintos": "status_escritura",
    "planes_distintos": "plan",
}
CONFLICT_RAW_COLS = {
    "enganches_distintos": "enganche",
    "financiamientos_distintos": "financiamiento",
    "precios_venta_distintos": "precio_venta",
}


def sale_attribute_values() -> dict:
    """The eleven audited attributes; a blank text counts as missing."""
    values = {n: blank_normalised(c) for n, c in CONFLICT_TEXT_COLS.items()}
    return values | {n: F.col(c) for n, c in CONFLICT_RAW_COLS.items()}


def sale_attribute_conflicts(report: DataFrame) -> DataFrame:
    """Sales whose main-customer report rows disagree on any attribute."""
    return distinct_value_conflicts(
        require_present(report, "id_venta"), ["id_venta"], sale_attribute_values()
    )


def _sql_conflicts(keys: list[str], exprs: dict[str, str], source: str, where: str) -> str:
    counts = [f"count(DISTINCT {e}) AS {n}" for n, e in exprs.items()]
    having = " OR ".join(f"count(DISTINCT {e}) > 1" for e in exprs.values())
    k = ", ".join(keys)
    source = source if source.startswith("FROM ") else f"FROM ({source})"
    return f"""SELECT {k}, {", ".join(counts)} {source} WHERE {where}
               GROUP BY {k} HAVING {having}"""


_CONFLICT_SQL_EXPRS = {n: f"nullif(trim({c}), '')" for n, c in CONFLICT_TEXT_COLS.items()}
_CONFLICT_SQL_EXPRS.update(CONFLICT_RAW_COLS)


@register(
    "conflict_audit",
    _sql_conflicts(["id_venta"], _CONFLICT_SQL_EXPRS, SQL_STAGED_SALE_ROWS, "id_venta IS NOT NULL"),
)
def conflict_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sale_attribute_conflicts(staged_sale_rows(Tables(spark, sf_dir)))


_MILESTONES = M.MILESTONE_COLS


@register(
    "schedule_conflicts",
    _sql_conflicts(
        ["desarrollo_largo", "unidad"], {f"{m}_distintos": m for m in _MILESTONES},
        SQL_STAGING_SCHEDULE, "desarrollo_largo IS NOT NULL AND unidad IS NOT NULL",
    ),
)
def schedule_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units with more than one distinct date for any milestone."""
    s = require_present(staged_schedule(Tables(spark, sf_dir)), "desarrollo_largo", "unidad")
    return distinct_value_conflicts(
        s, ["desarrollo_largo", "unidad"], {f"{m}_distintos": F.col(m) for m in _MILESTONES}
    )


_PARTY_CONFLICT_SQL = {
    "rfcs_distintos": "nullif(trim(rfc), '')",
    "curps_distintos": "nullif(trim(curp), '')",
    "emails_distintos": "nullif(lower(trim(email)), '')",
}


def party_values() -> dict:
    return {
        "rfcs_distintos": blank_normalised("rfc"),
        "curps_distintos": blank_normalised("curp"),
        "emails_distintos": blank_normalised("email", lower=True),
    }


def party_key_conflicts_of(parties: DataFrame) -> DataFrame:
    p = require_present(parties, "persona_natural_key")
    return distinct_value_conflicts(p, ["persona_natural_key"], party_values())


@register(
    "party_key_conflicts",
    _sql_conflicts(
        ["persona_natural_key"], _PARTY_CONFLICT_SQL, W.SQL_SALE_PARTIES,
        "persona_natural_key IS NOT NULL",
    ),
)
def party_key_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Party natural keys carrying more than one RFC, CURP or e-mail."""
    return party_key_conflicts_of(W.party_profiles(Tables(spark, sf_dir)))


def unit_values() -> dict:
    return {
        "desarrollos_cortos_distintos": blank_normalised("desarrollo_corto"),
        "etapas_distintas": blank_normalised("etapa"),
    }


@register(
    "unit_conflicts",
    _sql_conflicts(
        ["desarrollo_largo", "unidad"],
        {"desarrollos_cortos_distintos": "nullif(trim(desarrollo_corto), '')",
         "etapas_distintas": "nullif(trim(etapa), '')"},
        SQL_STAGED_SALE_ROWS, "desarrollo_largo IS NOT NULL AND unidad IS NOT NULL",
    ),
)
def unit_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units that the main-customer report gives more than one short name or stage."""
    rows = require_present(staged_sale_rows(Tables(spark, sf_dir)), "desarrollo_largo", "unidad")
    return distinct_value_conflicts(rows, ["desarrollo_largo", "unidad"], unit_values())


@register(
    "missing_group_audit",
    f"""SELECT desarrollo_largo, desarrollo_corto, count(*) AS total_unidades
        FROM ({W.SQL_DIM_UNITS}) WHERE grupo IS NULL
        GROUP BY desarrollo_largo, desarrollo_corto ORDER BY total_unidades DESC""",
)
def missing_group_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Developments without a group in the seed, by number of units (largest first)."""
    units = W.units_dimension(Tables(spark, sf_dir))
    return (
        units.where(F.col("grupo").isNull())
        .groupBy("desarrollo_largo", "desarrollo_corto")
        .agg(F.count(F.lit(1)).alias("total_unidades"))
        .orderBy(F.desc("total_unidades"))
    )


def main_customer_count_audit(sales_fact: DataFrame, bridge: DataFrame) -> DataFrame:
    """Sales with zero or several main customers."""
    j = sales_fact.select("venta_key", "id_venta").join(
        bridge.select("venta_key", "persona_key", "rol_persona_en_venta"), "venta_key", "left"
    )
    main = F.when(F.col("rol_persona_en_venta") == ROLE_MAIN, F.col("persona_key"))
    return (
        j.groupBy("venta_key", "id_venta")
        .agg(F.count_distinct(main).alias("clientes_principales"))
        .where(F.col("clientes_principales") != 1)
    )


@register(
    "exactly_one_audit",
    f"""
    SELECT v.venta_key, v.id_venta,
           count(DISTINCT CASE WHEN b.rol_persona_en_venta = '{ROLE_MAIN}' THEN b.persona_key END)
               AS clientes_principales
    FROM ({W.SQL_FACT_SALES}) v LEFT JOIN ({W.SQL_BRIDGE}) b ON v.venta_key = b.venta_key
    GROUP BY v.venta_key, v.id_venta
    HAVING count(DISTINCT CASE WHEN b.rol_persona_en_venta = '{ROLE_MAIN}'
                               THEN b.persona_key END) <> 1
""",
)
def exactly_one_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    # the audit groups by sale and counts distinct parties, so the sale list's keys
    # stand for the whole sales fact
    sale_keys = W.sale_keys_of(W.sales_list(t))
    bridge = W.bridge_sale_party(W.sale_parties_of(t, distinct=False), sale_keys)
    return main_customer_count_audit(sale_keys, bridge)


# ---------------------------------------------------------------------------
# Analyses


@register(
    "conflict_detail",
    f"""
    WITH p AS ({W.SQL_SALE_PARTIES}),
    conflictos AS ({_sql_conflicts(["persona_natural_key"], _PARTY_CONFLICT_SQL, "SELECT * FROM p",
                                   "persona_natural_key IS NOT NULL")})
    SELECT p.persona_natural_key, p.id_venta, p.rol_persona_en_venta, p.nombre_completo, p.rfc,
           p.curp, lower(trim(p.email)) AS email, p.telefono_celular
    FROM p JOIN conflictos c ON p.persona_natural_key = c.persona_natural_key
    ORDER BY p.persona_natural_key, p.nombre_completo, p.id_venta
""",
)
def conflict_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every party row of a conflicting natural key, sorted for review."""
    return conflict_rows(Tables(spark, sf_dir)).orderBy("persona_natural_key", "nombre_completo", "id_venta")


def conflict_rows(t: Tables) -> DataFrame:
    """``conflict_detail`` without its order."""
    conflicts = party_key_conflicts_of(W.party_profiles(t)).select("persona_natural_key")
    rows = []
    for links, profiles, role in W.profiled_links(t):
        # the key is the party's own, so its profiles are chosen before the sales join them; a
        # party that no table knows has no value and cannot be in conflict
        chosen = W.with_party_identity(profiles).join(conflicts, "persona_natural_key", "left_semi")
        rows.append(review_columns(W.profiles_of_links(links, chosen.select(*profiles.columns), role, "inner")))
    return functools.reduce(DataFrame.unionByName, rows)


def conflict_rows_of(parties: DataFrame, conflicts: DataFrame) -> DataFrame:
    """The rows of ``parties`` whose natural key is in ``conflicts``."""
    keys = conflicts.select("persona_natural_key")
    # the key set is unique; an inner join, unlike a semi-join, is not copied into the union
    return review_columns(parties.join(keys, "persona_natural_key"))


def review_columns(parties: DataFrame) -> DataFrame:
    return parties.select(
        "persona_natural_key", "id_venta", "rol_persona_en_venta", "nombre_completo", "rfc",
        "curp", F.lower(F.trim("email")).alias("email"), "telefono_celular",
    )


REVIEW_ORDER = [
    "persona_natural_key", "nombre_completo", "id_venta", "rol_persona_en_venta", "rfc", "curp", "email",
    "telefono_celular",
]


@register(
    "conflict_report",
    f"""
    SELECT *, row_number() OVER (ORDER BY {", ".join(f"{c} NULLS FIRST" for c in REVIEW_ORDER)}) AS position
    FROM ({ORACLE_SQL["conflict_detail"]})
""",
)
def conflict_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review list written once in its order, in numbered ranges, and read back in it with
    every row's position; the read neither sorts nor shuffles."""
    location = shared_scratch_root(spark, f"estrella-review-{uuid.uuid4().hex}")
    write_ordered(conflict_rows(Tables(spark, sf_dir)), location, REVIEW_ORDER)
    return read_ordered(spark, location, position="position")


_DUPLICATE_COLS = ["id_venta", "nombre_cliente", "apellido_paterno", "apellido_materno", "rfc", "curp"]


@register(
    "duplicate_audit",
    f"""SELECT {", ".join(_DUPLICATE_COLS)}, count(*) AS total_filas,
              count(DISTINCT pais) AS paises_distintos
       FROM ({SQL_MAIN_REPORT}) GROUP BY {", ".join(_DUPLICATE_COLS)} HAVING count(*) > 1""",
)
def duplicate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main customers that the report repeats for one sale, with their countries."""
    report = main_report(Tables(spark, sf_dir)).select(*_DUPLICATE_COLS, "pais")
    return find_duplicates(report, _DUPLICATE_COLS, "total_filas", {"paises_distintos": "pais"})


@register(
    "repeated_sales",
    f"""SELECT id_venta, count(*) AS total
        FROM ({W.SQL_SALES_LIST}) CROSS JOIN (VALUES (1), (2), (3)) AS times(n)
        WHERE {sql_listed_times("id_venta")}
        GROUP BY id_venta HAVING count(*) > 1""",
)
def repeated_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sale ids that a delivery of the staged sale list repeats."""
    delivered = stage_sales(raw_sales(Tables(spark, sf_dir), repeated=True))
    return find_duplicates(delivered, ["id_venta"], "total")


@register(
    "orphan_count",
    f"""SELECT count(*) AS ingresos_sin_venta
        FROM (SELECT * FROM ({SQL_STAGING_PAYMENTS}) WHERE NOT es_venta_cancelada) i
        LEFT JOIN ({W.SQL_SALES_LIST}) v ON i.id_venta = v.id_venta
        WHERE v.id_venta IS NULL""",
)
def orphan_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments whose sale is not in the sale list (one row)."""
    t = Tables(spark, sf_dir)
    # the sale's columns are not needed: payments without the lookups, and the ids of the sale
    # list, which its lookups neither add nor remove
    payments = stage_payments(raw_payments(t, enrich=False))
    return orphan_count(payments, W.sale_keys(t), "id_venta", "id_venta", "ingresos_sin_venta")


# Labels of the relation-coverage report (relation names and audit types).
REL_PAYMENTS_SALES = "fct_ingresos -> fct_ventas"
REL_OVERDUE_SALES = "fct_pagos_vencidos -> fct_ventas"
REL_SCHEDULE_UNITS = "fct_cronograma_unidades -> dim_unidades"
REL_INVOICES_SALES = "fct_facturas -> fct_ventas"
AUDIT_OPTIONAL = "auditoria_no_obligatoria"
AUDIT_NO_KEY = "sin_llave_confiable"


def relation_coverage(t: Tables) -> DataFrame:
    # only ids and their multiplicity are compared: a sale occurs in the fact once for each
    # dashboard row of its id, and its hashed key stands for its id
    dashboard = require_present(staged_dashboard(t), "id_venta").select("id_venta")
    ids = W.sale_keys(t).select("id_venta")
    sales = ids.join(dashboard, "id_venta", "left")
    null_token = lambda df: df.select(F.coalesce(F.col("id_venta").cast("string"), F.lit("")).alias("id"))
    branches = [
        coverage(null_token(W.payment_measures(t)), null_token(sales), "id", "id",
                 REL_PAYMENTS_SALES, AUDIT_OPTIONAL),
        coverage(W.overdue_measures(t), sales, "id_venta", "id_venta",
                 REL_OVERDUE_SALES, AUDIT_OPTIONAL),
        coverage(M.schedule_of(t), W.units_dimension(t), "unidad_key", "unidad_key",
                 REL_SCHEDULE_UNITS, AUDIT_OPTIONAL),
        no_key_coverage(W.fact_invoices(W.stage_invoices(W.raw_invoices(t))),
                        REL_INVOICES_SALES, AUDIT_NO_KEY),
    ]
    return functools.reduce(DataFrame.unionByName, branches)


def coverage_of(
    payments: DataFrame, overdue: DataFrame, schedule: DataFrame, invoices: DataFrame,
    sales_fact: DataFrame, units: DataFrame,
) -> DataFrame:
    """The same report over written facts and dimensions."""
    branches = [
        coverage(payments, sales_fact, "venta_key", "venta_key", REL_PAYMENTS_SALES, AUDIT_OPTIONAL),
        coverage(overdue, sales_fact, "venta_key", "venta_key", REL_OVERDUE_SALES, AUDIT_OPTIONAL),
        coverage(schedule, units, "unidad_key", "unidad_key", REL_SCHEDULE_UNITS, AUDIT_OPTIONAL),
        no_key_coverage(invoices, REL_INVOICES_SALES, AUDIT_NO_KEY),
    ]
    return functools.reduce(DataFrame.unionByName, branches)


def _sql_coverage(child: str, parent: str, key: str, relation: str) -> str:
    return f"""
    SELECT '{relation}' AS relacion, count(*) AS total_registros, count(p.{key}) AS con_relacion,
           count(*) - count(p.{key}) AS sin_relacion,
           round(CAST(count(p.{key}) AS DOUBLE) / nullif(count(*), 0) * 100, 2) AS cobertura_pct,
           '{AUDIT_OPTIONAL}' AS tipo_auditoria
    FROM ({child}) c LEFT JOIN ({parent}) p ON c.{key} = p.{key}"""


@register(
    "coverage_audit",
    " UNION ALL ".join(
        [
            _sql_coverage(W.SQL_FACT_PAYMENTS, W.SQL_FACT_SALES, "venta_key", REL_PAYMENTS_SALES),
            _sql_coverage(W.SQL_FACT_OVERDUE, W.SQL_FACT_SALES, "venta_key", REL_OVERDUE_SALES),
            _sql_coverage(M.SQL_SCHEDULE_SNAPSHOT, W.SQL_DIM_UNITS, "unidad_key", REL_SCHEDULE_UNITS),
            f"""SELECT '{REL_INVOICES_SALES}' AS relacion, count(*) AS total_registros,
                       CAST(NULL AS BIGINT) AS con_relacion, CAST(NULL AS BIGINT) AS sin_relacion,
                       CAST(NULL AS DOUBLE) AS cobertura_pct, '{AUDIT_NO_KEY}' AS tipo_auditoria
                FROM ({W.SQL_FACT_INVOICES})""",
        ]
    ),
)
def coverage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relation coverage: total, matched, unmatched and % for three weak relations."""
    return build_shared(spark, sf_dir, relation_coverage)


# ---------------------------------------------------------------------------
# Quality report: one row per declared check

# The declared checks of every table (96 generic ones; all of severity error).
CATALOGUE: dict[str, TableChecks] = {
    "stg_sale_list": TableChecks(
        not_null=("id_venta",), unique=("id_venta",), combinations=(("desarrollo_largo", "unidad"),)),
    "stg_main_report": TableChecks(not_null=("id_venta",)),
    "stg_co_owner_report": TableChecks(not_null=("id_venta",)),
    "stg_payments": TableChecks(expressions=("monto_pagado >= 0",)),
    "stg_schedule": TableChecks(not_null=("desarrollo_largo", "unidad")),
    "stg_invoices": TableChecks(not_null=("uuid",), unique=("uuid",)),
    "stg_dashboard": TableChecks(not_null=("id_venta",), unique=("id_venta",)),
    "stg_overdue": TableChecks(not_null=("monto_vencido", "fecha_pago", "no_pago")),
    "dim_units": TableChecks(
        not_null=("unidad_key",), unique=("unidad_key",), combinations=(("desarrollo_largo", "unidad"),)),
    "fct_sales": TableChecks(
        not_null=("venta_key", "id_venta", "unidad_key"), unique=("venta_key", "id_venta"),
        expressions=("fecha_ultimo_pago_enganche >= fecha_primer_enganche",),
        relationships=(("unidad_key", "dim_units", "unidad_key"),)),
    "fct_overdue": TableChecks(
        not_null=("pago_vencido_key", "no_pago", "fecha_pago", "monto_vencido", "dias_atraso"),
        unique=("pago_vencido_key",),
        combinations=(("id_venta", "no_pago", "fecha_pago", "tipo_pago"),)),
    "fct_schedule": TableChecks(
        not_null=("cronograma_unidad_key", "unidad_key", "desarrollo_largo", "unidad"),
        unique=("cronograma_unidad_key",), combinations=(("desarrollo_largo", "unidad"),)),
    "dim_parties": TableChecks(
        not_null=("persona_key", "persona_natural_key"), unique=("persona_key", "persona_natural_key")),
    "bridge": TableChecks(
        not_null=("venta_key", "persona_key"),
        combinations=(("venta_key", "persona_key", "rol_persona_en_venta"),),
        relationships=(("venta_key", "fct_sales", "venta_key"), ("persona_key", "dim_parties", "persona_key"))),
    "fct_payments": TableChecks(not_null=("ingreso_key", "monto_pagado"), unique=("ingreso_key",)),
    "fct_invoices": TableChecks(
        not_null=("factura_key", "total_factura", "uuid"), unique=("factura_key", "uuid")),
    "dim_date": TableChecks(not_null=("date_day",), unique=("date_day",)),
    "commercial_mart": TableChecks(
        not_null=("venta_key", "id_venta", "precio_venta"), unique=("venta_key", "id_venta")),
    "collections_mart": TableChecks(
        not_null=("venta_key", "id_venta", "total_ingresado_bruto", "total_ingresado_activo", "saldo_estimado"),
        unique=("venta_key", "id_venta")),
    "dash_legacy": TableChecks(
        not_null=("id_venta", "unidad_key", "unidad", "desarrollo_largo", "desarrollo_corto", "precio_venta"),
        unique=("id_venta",)),
    "overdue_mart": TableChecks(
        not_null=("total_vencido", "numero_pagos_vencidos"),
        combinations=(("venta_key", "id_venta", "unidad_key"),)),
    "period_mart": TableChecks(
        not_null=("numero_movimientos", "total_ingresado"), combinations=(tuple(M.PERIOD_KEYS),)),
    "invoice_mart": TableChecks(
        not_null=("factura_key", "uuid", "total_factura"), unique=("factura_key", "uuid")),
    "dash_rebuilt": TableChecks(
        not_null=("venta_key", "id_venta", "unidad_key", "precio_venta", "total_cobrado", "total_vencido",
                  "saldo_total_estimado"),
        unique=("venta_key", "id_venta")),
}

# The singular audits: name, severity, tables read, finding rows.
SINGULAR = [
    ("conflictos_cronograma_unidades", "error", lambda t: conflicting_keys(
        require_present(t["stg_schedule"], "desarrollo_largo", "unidad"), ["desarrollo_largo", "unidad"],
        {m: F.col(m) for m in _MILESTONES})),
    ("conflictos_persona_natural_key", "warn", lambda t: conflicting_keys(
        require_present(t["party_rows"], "persona_natural_key"), ["persona_natural_key"], party_values())),
    ("conflictos_unidades_atributos", "error", lambda t: conflicting_keys(
        require_present(t["stg_main_report"], "desarrollo_largo", "unidad"), ["desarrollo_largo", "unidad"],
        unit_values())),
    ("conflictos_ventas_atributos", "error", lambda t: conflicting_keys(
        require_present(t["stg_main_report"], "id_venta"), ["id_venta"], sale_attribute_values())),
    ("distintos_asesores", "error", lambda t: conflicting_keys(
        t["stg_main_report"], ["id_venta"], {"asesor": F.col("asesor")})),
    ("unidades_sin_grupo", "warn", lambda t: t["dim_units"].where("grupo is null").select(
        "desarrollo_largo", "desarrollo_corto").distinct()),
    ("ventas_con_mas_de_un_cliente_principal", "warn",
     lambda t: main_customer_count_audit(t["fct_sales"], t["bridge"])),
]


def catalogue_report(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per declared check over ``tables`` (best: written ones, see ``plans.build``)."""
    suspects = suspect_checks(CATALOGUE, tables)
    parts = [table_report(name, checks, tables, suspects[name]) for name, checks in CATALOGUE.items()]
    parts += [
        find(tables).agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), "failures")
        for name, severity, find in SINGULAR
    ]
    return with_status(functools.reduce(DataFrame.unionByName, parts))


_SQL_TABLES = {
    "stg_sale_list": W.SQL_SALES_LIST,
    "stg_main_report": SQL_MAIN_REPORT,
    "stg_co_owner_report": SQL_CO_OWNER_REPORT,
    "stg_payments": f"SELECT * FROM ({SQL_STAGING_PAYMENTS}) WHERE NOT es_venta_cancelada",
    "stg_schedule": SQL_STAGING_SCHEDULE,
    "stg_invoices": SQL_STAGING_INVOICES,
    "stg_dashboard": SQL_STAGE_DASHBOARD,
    "stg_overdue": SQL_STAGING_OVERDUE,
    "party_rows": W.SQL_SALE_PARTIES,
    "dim_units": W.SQL_DIM_UNITS,
    "fct_sales": W.SQL_FACT_SALES,
    "fct_overdue": W.SQL_FACT_OVERDUE,
    "fct_schedule": M.SQL_SCHEDULE_SNAPSHOT,
    "dim_parties": W.SQL_DIM_PARTIES,
    "bridge": W.SQL_BRIDGE,
    "fct_payments": W.SQL_FACT_PAYMENTS,
    "fct_invoices": W.SQL_FACT_INVOICES,
    "dim_date": W.sql_date_attributes(W.SQL_DATA_SPINE),
    "commercial_mart": M.SQL_COMMERCIAL,
    "collections_mart": M.SQL_COLLECTIONS,
    "dash_legacy": M.SQL_DASH_LEGACY,
    "overdue_mart": M.SQL_OVERDUE_MART,
    "period_mart": M.SQL_PERIOD_MART,
    "invoice_mart": M.SQL_INVOICE_MART,
    "dash_rebuilt": M.SQL_DASH_REBUILT,
}
_SQL_SINGULAR = {
    "conflictos_cronograma_unidades": _sql_conflicts(
        ["desarrollo_largo", "unidad"], {m: m for m in _MILESTONES}, "FROM stg_schedule",
        "desarrollo_largo IS NOT NULL AND unidad IS NOT NULL"),
    "conflictos_persona_natural_key": _sql_conflicts(
        ["persona_natural_key"], _PARTY_CONFLICT_SQL, "FROM party_rows", "persona_natural_key IS NOT NULL"),
    "conflictos_unidades_atributos": _sql_conflicts(
        ["desarrollo_largo", "unidad"],
        {"c": "nullif(trim(desarrollo_corto), '')", "e": "nullif(trim(etapa), '')"},
        "FROM stg_main_report", "desarrollo_largo IS NOT NULL AND unidad IS NOT NULL"),
    "conflictos_ventas_atributos": _sql_conflicts(
        ["id_venta"], _CONFLICT_SQL_EXPRS, "FROM stg_main_report", "id_venta IS NOT NULL"),
    "distintos_asesores": _sql_conflicts(["id_venta"], {"a": "asesor"}, "FROM stg_main_report", "TRUE"),
    "unidades_sin_grupo": "SELECT DISTINCT desarrollo_largo, desarrollo_corto FROM dim_units WHERE grupo IS NULL",
    "ventas_con_mas_de_un_cliente_principal": f"""
        SELECT s.id_venta FROM fct_sales s LEFT JOIN bridge b USING (venta_key)
        GROUP BY s.venta_key, s.id_venta
        HAVING count(DISTINCT b.persona_key) FILTER (b.rol_persona_en_venta = '{ROLE_MAIN}') <> 1""",
}


def _sql_findings(table: str, c: TableChecks) -> list[tuple[str, str, str]]:
    """(check name, severity, SQL of its findings) of a table's declared checks."""
    found = [f"SELECT 1 FROM {table} WHERE {x} IS NULL" for x in c.not_null]
    found += [f"SELECT 1 FROM {table} WHERE NOT ({x})" for x in c.expressions]
    found += [f"SELECT {x} FROM {table} WHERE {x} IS NOT NULL GROUP BY {x} HAVING count(*) > 1" for x in c.unique]
    found += [f"SELECT 1 FROM {table} GROUP BY {', '.join(x)} HAVING count(*) > 1" for x in c.combinations]
    found += [
        f"SELECT 1 FROM {table} c WHERE {x} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{field} = c.{x})"
        for x, parent, field in c.relationships
    ]
    return [(name, c.severity, sql) for name, sql in zip(c.names(table), found)]


def _sql_catalogue() -> str:
    rows = [x for table, c in CATALOGUE.items() for x in _sql_findings(table, c)]
    rows += [(name, severity, _SQL_SINGULAR[name]) for name, severity, _ in SINGULAR]
    ctes = ", ".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in _SQL_TABLES.items())
    return f"WITH {ctes} " + " UNION ALL ".join(
        f"""SELECT '{name}' AS check_name, '{sev}' AS severity, count(*) AS failures,
               CASE WHEN count(*) = 0 THEN 'pass' WHEN '{sev}' = 'warn' THEN 'warn' ELSE 'fail' END
                   AS status
        FROM ({sql})"""
        for name, sev, sql in rows
    )


@register("quality_report", _sql_catalogue())
def quality_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared check, over the tables of a full refresh written to the shared folder."""
    from estrella.plans.build import build_all

    root = shared_scratch_root(spark, f"estrella-quality-{uuid.uuid4().hex}")
    return catalogue_report(build_all(spark, sf_dir, root, audits=False))


# ---------------------------------------------------------------------------
# Sinks: table (overwrite twice), view and ephemeral materialisations


@register("sink_roundtrip", M.SQL_COLLECTIONS)
def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the collections mart through layer routing and read it back.

    The table goes under the cluster's shared checkpoint folder (a fresh
    sub-folder per call, left there for the returned frame to read). The returned frame reads the written table, passed once through a view
    registration and once through the ephemeral (inline) path.
    """
    mart = M.collections_mart(spark, sf_dir)
    root = shared_scratch_root(spark, f"estrella-sinks-{uuid.uuid4().hex}")
    table = publish(mart, "marts", "collections_by_sale", root)
    view = publish(table, "staging", "collections_by_sale_view", root)
    return publish(view, "int", "collections_by_sale_inline", root)


# Columns of the collections mart whose values hardly repeat: a Parquet dictionary of them is built
# in vain, and costs a good part of the writing.
_NO_DICTIONARY = ("venta_key", "id_venta", "precio_venta", "total_ingresado_bruto", "total_ingresado_activo", "saldo_estimado")
_COLLECTIONS_FILES = {f"parquet.enable.dictionary#{c}": "false" for c in _NO_DICTIONARY}


@register("table_refresh", M.SQL_COLLECTIONS)
def table_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collections mart published, then refreshed from a read of itself: a later version
    may read the one it replaces. The result is what readers see after the second switch."""
    root = shared_scratch_root(spark, f"estrella-refresh-{uuid.uuid4().hex}")
    mart = M.collections_mart(spark, sf_dir)
    first = publish(mart, "marts", "collections_mart", root, options=_COLLECTIONS_FILES)
    publish(first.where("venta_key is not null"), "marts", "collections_mart", root, options=_COLLECTIONS_FILES)
    return read_version(spark, layer_location(root, "marts", "collections_mart", "prod", "default"))


@register("partition_refresh", M.SQL_PERIOD_MART)
def partition_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The period mart partitioned by year, first without the amounts of its last year; then
    that year alone is written again, and the other years keep their files."""
    root = shared_scratch_root(spark, f"estrella-refresh-{uuid.uuid4().hex}")
    mart = M.period_mart(spark, sf_dir)
    whole = publish(mart, "staging", "period_mart", root, materialized="table")
    last = whole.agg(F.max("year")).first()[0]  # one number
    late = F.col("year").eqNullSafe(F.lit(last))
    blanked = whole.withColumn("total_ingresado", F.when(~late, F.col("total_ingresado")))
    publish(blanked, "marts", "period_mart", root, partition_by=["year"])
    return publish(whole.where(late), "marts", "period_mart", root, partition_by=["year"], replace="partitions")


# Candidates hold many hashed keys in hex digits, which zstd stores in half the room of snappy.
_CANDIDATE_FILES = {"compression": "zstd"}
# What is checked before it is published, by the tables' own declared checks.
_GATED = ["collections_mart", "dash_legacy", "invoice_mart", "stg_sale_list"]


def _sql_publish_decisions() -> str:
    parts = []
    for table in _GATED:
        found = _sql_findings(table, CATALOGUE[table])
        counts = " UNION ALL ".join(f"SELECT count(*) AS n FROM ({sql})" for _, _, sql in found)
        parts.append(
            f"""SELECT '{table}' AS table_name, CAST({len(found)} AS BIGINT) AS checks, f.failed,
                       f.failed = 0 AS published,
                       CASE WHEN f.failed = 0 THEN (SELECT count(*) FROM {table}) ELSE 0 END AS rows_visible
                FROM (SELECT count(*) FILTER (n > 0) AS failed FROM ({counts})) f"""
        )
    ctes = ", ".join(f"{name} AS MATERIALIZED ({_SQL_TABLES[name]})" for name in _GATED)
    return f"WITH {ctes} " + " UNION ALL ".join(parts)


@register("publish_decisions", _sql_publish_decisions())
def publish_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write, audit, publish: each table is written as a candidate, its declared checks run on
    the candidate, and readers see it only if none of severity ``error`` fails. One row for
    each table: checks, failed ones, whether it was published, and the rows readers see."""
    # the orders with their units, and the narrow sides of the marts' joins, are made once for all
    t = written_frames(spark, sf_dir, {"order_units", *M.NARROW}, M.COLLECTIONS_SHARE_BYTES)
    made = {
        "collections_mart": M.collections_of,
        "dash_legacy": M.legacy_dashboard_of,
        "invoice_mart": M.invoices_of,
        "stg_sale_list": W.sales_list,
    }
    root = shared_scratch_root(spark, f"estrella-gate-{uuid.uuid4().hex}")
    rows = []
    for name in _GATED:
        location = f"{root}/{name}"
        df = made[name](t)
        replace_table(df.limit(0), location)  # what readers had before: an empty table
        candidate = stage(df, location, options=_CANDIDATE_FILES)
        checks, written = CATALOGUE[name], {name: candidate.read()}
        suspects = suspect_checks({name: checks}, written)[name]
        report = with_status(table_report(name, checks, written, suspects))
        try:
            outcomes, published = publish_checked({name: candidate}, report), True
        except PublishBlocked as blocked:
            outcomes, published = blocked.outcomes, False
        failed = sum(o.status == "fail" for o in outcomes)
        rows.append((name, len(outcomes), failed, published, read_version(spark, location).count()))
    schema = "table_name string, checks bigint, failed bigint, published boolean, rows_visible bigint"
    return spark.createDataFrame(rows, schema)


@register("seed_lookup", W.SQL_DIM_UNITS)
def seed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The units dimension with its group seed read from a header CSV.

    The seed (development long / short name -> group) is derived from the nation
    and region tables, written as a CSV seed file under the shared checkpoint
    folder and read back with the declared seed schema - the path a maintained
    CSV lookup takes.
    """
    t = Tables(spark, sf_dir)
    path = shared_scratch_root(spark, f"estrella-seed-{uuid.uuid4().hex}")
    seed = group_seed(t).select(
        F.initcap(F.col("grupo_2")).alias("GRUPO"),
        F.col("desarrollo_corto").alias("DESARROLLO_CORTO"),
        F.col("desarrollo_largo").alias("DESARROLLO_LARGO"),
        F.col("grupo_2").alias("GRUPO_2"),
    )
    seed.write.mode("overwrite").option("header", True).csv(path)
    lookup = read_seed_csv(spark, path)
    return W.dim_units(W.sales_list(t), W.unit_attributes(W.units_report(t)), lookup)


# The seed with faults: some pairs again, padded and with the group in another spelling, and
# some short names left out.
_SQL_FAULTY_SEED = f"""
    SELECT desarrollo_largo, desarrollo_corto, grupo_2 FROM ({SQL_GROUP_SEED})
    UNION ALL
    SELECT ' ' || lower(desarrollo_largo), desarrollo_corto || '  ', lower(grupo_2)
    FROM ({SQL_GROUP_SEED}) WHERE length(desarrollo_largo) % 2 = 0
    UNION ALL
    SELECT desarrollo_largo, ' ', grupo_2 FROM ({SQL_GROUP_SEED}) WHERE length(desarrollo_largo) % 3 = 0"""


@register(
    "seed_findings",
    f"""
    WITH s AS ({_SQL_FAULTY_SEED}),
    f AS (SELECT *, upper(trim(desarrollo_largo)) AS a, nullif(upper(trim(desarrollo_corto)), '') AS b,
                 upper(trim(grupo_2)) AS g FROM s)
    SELECT 'blank' AS problem, desarrollo_largo, desarrollo_corto, grupo_2, CAST(1 AS BIGINT) AS n FROM f
    WHERE b IS NULL
    UNION ALL
    SELECT 'repeated_pair', desarrollo_largo, desarrollo_corto, grupo_2, m.n
    FROM f JOIN (SELECT a, b, count(*) AS n FROM f WHERE b IS NOT NULL GROUP BY a, b HAVING count(*) > 1) m USING (a, b)
    UNION ALL
    SELECT 'group_spelling', desarrollo_largo, desarrollo_corto, grupo_2, m.n
    FROM f JOIN (SELECT g, count(DISTINCT grupo_2) AS n FROM f GROUP BY g HAVING count(DISTINCT grupo_2) > 1) m USING (g)
""",
)
def seed_findings_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faults of a seed CSV: blank parts, pairs that come again, groups in several spellings."""
    seed = group_seed(Tables(spark, sf_dir))
    size = F.length("desarrollo_largo")
    again = seed.where(size % 2 == 0).select(
        F.concat(F.lit(" "), F.lower("desarrollo_largo")).alias("desarrollo_largo"),
        F.concat("desarrollo_corto", F.lit("  ")).alias("desarrollo_corto"), F.lower("grupo_2").alias("grupo_2"),
    )
    short = seed.where(size % 3 == 0).withColumn("desarrollo_corto", F.lit(" "))
    faulty = seed.unionByName(again).unionByName(short).select(
        F.initcap("grupo_2").alias("GRUPO"), F.col("desarrollo_corto").alias("DESARROLLO_CORTO"),
        F.col("desarrollo_largo").alias("DESARROLLO_LARGO"), F.col("grupo_2").alias("GRUPO_2"),
    )
    path = shared_scratch_root(spark, f"estrella-seed-{uuid.uuid4().hex}")
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "quoteAll": "true"}
    faulty.write.options(header=True, **keep).csv(path)
    lookup = read_seed_csv(spark, path).drop("grupo")
    return seed_findings(lookup, ("desarrollo_largo", "desarrollo_corto"), "grupo_2").select(
        "problem", "desarrollo_largo", "desarrollo_corto", "grupo_2", "n"
    )
