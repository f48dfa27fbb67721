"""Warehouse: keys, calendar, dimensions, bridge and facts.

Dimensions and facts are functions of staged frames; the registered queries
build them from the role-mapped test tables. Grain rules:

* units: one row per distinct (development, short name, stage, unit, model) -
  the key covers (development, unit) only, as in the source design;
* parties: one row per natural key (independent max of every attribute);
* bridge: distinct (sale, party, role) for parties of existing sales.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrella.functions import (
    all_present,
    fallback_key,
    full_name,
    guarded_key,
    money,
    natural_key,
    surrogate_key,
)
from estrella.functions.keys import SURROGATE_NULL_TOKEN
from estrella.operators import (
    date_spine_covering,
    distinct_count_above,
    require_present,
    survivor_max,
    with_date_attributes,
)
from estrella.plans.registry import register
from estrella.plans.roles import (
    SQL_GROUP_SEED,
    group_seed,
    maybe_null,
)
from estrella.plans.staging import (
    SALE_ATTRIBUTES,
    SQL_CO_OWNER_REPORT,
    SQL_MAIN_REPORT,
    SQL_SALES_LIST,
    SQL_STAGE_DASHBOARD,
    SQL_STAGED_SALE_ROWS,
    SQL_STAGING_INVOICES,
    SQL_STAGING_OVERDUE,
    SQL_STAGING_PARTIES,
    SQL_STAGING_PAYMENTS,
    SQL_STAGING_SCHEDULE,
    ROLE_CO_OWNER,
    ROLE_MAIN,
    co_owner_links,
    co_owner_pairs,
    dashboard_columns,
    main_links,
    party_report,
    raw_invoices,
    raw_payments,
    sales_list,
    stage_invoices,
    stage_payments,
    staged_overdue,
    staged_sale_rows,
    staged_schedule,
    staged_customers,
    staged_suppliers,
)
from estrella.sources.shared import named
from estrella.sources.tables import Tables


def sql_sk(*exprs: str) -> str:
    """SQL twin of ``surrogate_key``."""
    parts = [f"coalesce(CAST({e} AS VARCHAR), '{SURROGATE_NULL_TOKEN}')" for e in exprs]
    if len(parts) == 1:
        return f"md5({parts[0]})"
    return "md5(concat_ws('-', " + ", ".join(parts) + "))"


# ---------------------------------------------------------------------------
# Keys


@register(
    "surrogate_key",
    f"""
SELECT o_orderkey,
       {sql_sk("o_orderkey")} AS venta_key,
       {sql_sk("o_custkey", "o_orderstatus")} AS cliente_status_key,
       {sql_sk("CASE WHEN o_custkey % 7 <> 0 THEN o_custkey END", "CAST(o_orderdate AS DATE)",
               "CAST(o_totalprice AS DECIMAL(18,2))")} AS mixto_key
FROM orders
""",
)
def surrogate_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """md5 keys over one column, two columns, and nullable int + date + decimal."""
    o = Tables(spark, sf_dir).orders
    return o.select(
        "o_orderkey",
        surrogate_key("o_orderkey").alias("venta_key"),
        surrogate_key("o_custkey", "o_orderstatus").alias("cliente_status_key"),
        surrogate_key(
            maybe_null(F.col("o_custkey"), F.col("o_custkey")),
            F.col("o_orderdate").cast("date"),
            money("o_totalprice"),
        ).alias("mixto_key"),
    )


OVERDUE_FACT_COLS = [
    "id_venta", "equipo", "desarrollo_largo", "desarrollo_corto", "unidad", "cliente", "email",
    "telefono_celular", "telefono_local", "dias_atraso", "no_pago", "fecha_pago", "monto_vencido",
    "tipo_pago",
]


def fact_overdue(staged: DataFrame) -> DataFrame:
    """Overdue payments with a row key and two keys guarded by their parts."""
    return require_present(staged, "monto_vencido").select(
        surrogate_key("id_venta", "no_pago", "fecha_pago", "tipo_pago").alias("pago_vencido_key"),
        guarded_key(all_present("id_venta"), "id_venta").alias("venta_key"),
        guarded_key(all_present("desarrollo_largo", "unidad"), "desarrollo_largo", "unidad").alias(
            "unidad_key"
        ),
        *OVERDUE_FACT_COLS,
    )


SQL_FACT_OVERDUE = f"""
    SELECT {sql_sk("id_venta", "no_pago", "fecha_pago", "tipo_pago")} AS pago_vencido_key,
           CASE WHEN id_venta IS NOT NULL THEN {sql_sk("id_venta")} END AS venta_key,
           CASE WHEN desarrollo_largo IS NOT NULL AND unidad IS NOT NULL
                THEN {sql_sk("desarrollo_largo", "unidad")} END AS unidad_key,
           {", ".join(OVERDUE_FACT_COLS)}
    FROM ({SQL_STAGING_OVERDUE}) WHERE monto_vencido IS NOT NULL"""


@register("guarded_key", SQL_FACT_OVERDUE)
def guarded_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_overdue(staged_overdue(Tables(spark, sf_dir)))


INVOICE_COLS = [
    "uuid", "uuid_relacionado", "folio_general", "folio_seguimiento", "rfc_emisor",
    "rfc_receptor", "razon_social_emisor", "razon_social_receptor", "fecha_timbrado",
    "tipo_factura", "tipo_pago", "total_factura",
]


def fact_invoices(staged: DataFrame) -> DataFrame:
    """Invoices keyed by uuid when present, else by a 4-column fallback."""
    return staged.select(
        fallback_key(
            "uuid", "folio_general", "folio_seguimiento", "fecha_timbrado", "total_factura"
        ).alias("factura_key"),
        *INVOICE_COLS,
    )


SQL_FACT_INVOICES = f"""
    SELECT CASE WHEN uuid IS NOT NULL AND uuid <> '' THEN {sql_sk("uuid")}
                ELSE {sql_sk("folio_general", "folio_seguimiento", "fecha_timbrado", "total_factura")}
           END AS factura_key,
           {", ".join(INVOICE_COLS)}
    FROM ({SQL_STAGING_INVOICES})"""


@register("fallback_key", SQL_FACT_INVOICES)
def fallback_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_invoices(stage_invoices(raw_invoices(Tables(spark, sf_dir))))


NAME_PARTS = ["nombre_cliente", "apellido_paterno", "apellido_materno"]


def with_party_identity(df: DataFrame) -> DataFrame:
    """Add ``nombre_completo`` and the ``persona_natural_key`` cascade."""
    return df.withColumns(
        {
            "nombre_completo": full_name(*NAME_PARTS),
            "persona_natural_key": natural_key(
                "curp", "rfc", "email", [*NAME_PARTS, "telefono_celular"]
            ),
        }
    )


SQL_PARTY_IDENTITY = """
           concat_ws(' ', nombre_cliente, apellido_paterno, apellido_materno) AS nombre_completo,
           CASE WHEN curp IS NOT NULL AND curp <> '' THEN curp
                WHEN rfc IS NOT NULL AND rfc <> '' THEN rfc
                WHEN email IS NOT NULL AND email <> '' THEN lower(email)
                ELSE concat_ws('|', nombre_cliente, apellido_paterno, apellido_materno,
                               telefono_celular) END AS persona_natural_key"""


@register(
    "natural_key",
    f"""
SELECT id_venta, rol_persona_en_venta, es_venta_cancelada, {SQL_PARTY_IDENTITY}
FROM ({SQL_STAGING_PARTIES})
""",
)
def natural_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from estrella.plans.staging import staging_parties

    staged = staging_parties(spark, sf_dir)
    return with_party_identity(staged).select(
        "id_venta", "rol_persona_en_venta", "es_venta_cancelada", "nombre_completo",
        "persona_natural_key",
    )


# ---------------------------------------------------------------------------
# Calendar over the span of the data (orders and payments)


def activity_dates(t: Tables) -> DataFrame:
    return (
        t.orders.select(F.col("o_orderdate").cast("date").alias("d"))
        .unionByName(t.lineitem.select(F.col("l_shipdate").cast("date").alias("d")))
    )


SQL_DATA_SPINE = """
    SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_day
    FROM (SELECT min(d) AS lo, max(d) AS hi FROM (
        SELECT CAST(o_orderdate AS DATE) AS d FROM orders
        UNION ALL SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem)) b
    WHERE lo IS NOT NULL"""


def sql_date_attributes(spine_sql: str) -> str:
    return f"""
    SELECT date_day, CAST(year(date_day) AS INTEGER) AS year,
           CAST(quarter(date_day) AS INTEGER) AS quarter, CAST(month(date_day) AS INTEGER) AS month,
           strftime(date_day, '%B') AS month_name, CAST(day(date_day) AS INTEGER) AS day_of_month,
           CAST(dayofweek(date_day) + 1 AS INTEGER) AS day_of_week,
           strftime(date_day, '%A') AS day_name,
           CAST(weekofyear(date_day) AS INTEGER) AS week_of_year,
           dayofweek(date_day) IN (0, 6) AS is_weekend
    FROM ({spine_sql})"""


def data_calendar(t: Tables) -> DataFrame:
    return with_date_attributes(date_spine_covering(activity_dates(t), "d"))


@register("date_spine", SQL_DATA_SPINE)
def date_spine_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day from the first order date to the last payment date."""
    return date_spine_covering(activity_dates(Tables(spark, sf_dir)), "d")


@register("date_dim", sql_date_attributes(SQL_DATA_SPINE))
def date_dim_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data_calendar(Tables(spark, sf_dir))


# ---------------------------------------------------------------------------
# Joins with defaults and coalesced sources


@register(
    "join_left",
    """
WITH l AS (SELECT l_orderkey, count(*) AS n_lineas, max(l_returnflag) AS bandera
           FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey, c.c_name, c.c_mktsegment,
       CAST(coalesce(l.n_lineas, 0) AS BIGINT) AS n_lineas,
       coalesce(CASE WHEN o.o_orderkey % 7 <> 0 THEN o.o_orderpriority END, l.bandera)
           AS prioridad_o_bandera
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN l ON o.o_orderkey = l.l_orderkey
""",
)
def join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales keep every row; customer and per-sale line summary attach when present."""
    t = Tables(spark, sf_dir)
    o, c = t.orders, t.customer
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lineas"), F.max("l_returnflag").alias("bandera")
    )
    j = o.join(c, o.o_custkey == c.c_custkey, "left").join(
        lines, o.o_orderkey == lines.l_orderkey, "left"
    )
    return j.select(
        "o_orderkey",
        "c_name",
        "c_mktsegment",
        F.coalesce(F.col("n_lineas"), F.lit(0)).cast("bigint").alias("n_lineas"),
        F.coalesce(maybe_null(F.col("o_orderkey"), F.col("o_orderpriority")), F.col("bandera"))
        .alias("prioridad_o_bandera"),
    )


# ---------------------------------------------------------------------------
# Units dimension


def unit_attributes(units_report: DataFrame) -> DataFrame:
    """One row per (development, unit): independent max of short name and stage."""
    present = require_present(units_report, "desarrollo_largo", "unidad")
    return survivor_max(present, ["desarrollo_largo", "unidad"], ["desarrollo_corto", "etapa"])


def dim_units(sales: DataFrame, attributes: DataFrame, seed: DataFrame) -> DataFrame:
    """Distinct units of the sales, completed from attributes, grouped by the seed."""
    v = require_present(sales, "desarrollo_largo", "unidad").select(
        "desarrollo_largo", "desarrollo_corto", "unidad", "modelo"
    )
    a = attributes.select(
        "desarrollo_largo", "unidad",
        F.col("desarrollo_corto").alias("__a_corto"), F.col("etapa"),
    )
    base = (
        v.join(a, ["desarrollo_largo", "unidad"], "left")
        .select(
            "desarrollo_largo",
            F.coalesce(F.col("desarrollo_corto"), F.col("__a_corto")).alias("desarrollo_corto"),
            "etapa",
            "unidad",
            "modelo",
        )
        .distinct()
    )
    g = seed.select("desarrollo_largo", "desarrollo_corto", F.col("grupo_2").alias("grupo"))
    return base.join(g, ["desarrollo_largo", "desarrollo_corto"], "left").select(
        surrogate_key("desarrollo_largo", "unidad").alias("unidad_key"),
        "desarrollo_largo",
        "desarrollo_corto",
        "grupo",
        "etapa",
        "unidad",
        "modelo",
    )


def units_report(t: Tables) -> DataFrame:
    """Unit attributes as the main-customer report states them."""
    return staged_sale_rows(t).select("desarrollo_largo", "desarrollo_corto", "unidad", "etapa")


@named
def units_dimension(t: Tables) -> DataFrame:
    return dim_units(sales_list(t), unit_attributes(units_report(t)), group_seed(t))


SQL_DIM_UNITS = f"""
    WITH v AS (SELECT desarrollo_largo, desarrollo_corto, unidad, modelo FROM ({SQL_SALES_LIST})
               WHERE desarrollo_largo IS NOT NULL AND unidad IS NOT NULL),
    a AS (SELECT desarrollo_largo, unidad, max(desarrollo_corto) AS desarrollo_corto,
                 max(etapa) AS etapa
          FROM ({SQL_STAGED_SALE_ROWS})
          WHERE desarrollo_largo IS NOT NULL AND unidad IS NOT NULL
          GROUP BY desarrollo_largo, unidad),
    base AS (SELECT DISTINCT v.desarrollo_largo,
                    coalesce(v.desarrollo_corto, a.desarrollo_corto) AS desarrollo_corto,
                    a.etapa, v.unidad, v.modelo
             FROM v LEFT JOIN a ON v.desarrollo_largo = a.desarrollo_largo AND v.unidad = a.unidad)
    SELECT {sql_sk("u.desarrollo_largo", "u.unidad")} AS unidad_key, u.desarrollo_largo,
           u.desarrollo_corto, g.grupo_2 AS grupo, u.etapa, u.unidad, u.modelo
    FROM base u LEFT JOIN ({SQL_GROUP_SEED}) g
      ON u.desarrollo_largo = g.desarrollo_largo AND u.desarrollo_corto = g.desarrollo_corto"""


@register("lookup_group", SQL_DIM_UNITS)
def lookup_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units_dimension(Tables(spark, sf_dir))


# ---------------------------------------------------------------------------
# Hash-key join where null parts match


def schedule_per_unit_summary(schedule: DataFrame) -> DataFrame:
    return schedule.groupBy("desarrollo_largo", "unidad").agg(
        F.count(F.lit(1)).alias("n_eventos_cronograma"),
        F.max("proceso").alias("ultima_fecha_proceso"),
    ).select(
        surrogate_key("desarrollo_largo", "unidad").alias("unidad_key"),
        "n_eventos_cronograma",
        "ultima_fecha_proceso",
    )


@register(
    "null_key_join",
    f"""
WITH s AS (SELECT {sql_sk("desarrollo_largo", "unidad")} AS unidad_key,
                  count(*) AS n_eventos_cronograma, max(proceso) AS ultima_fecha_proceso
           FROM ({SQL_STAGING_SCHEDULE}) GROUP BY desarrollo_largo, unidad),
p AS (SELECT id_venta, no_pago, desarrollo_largo, unidad,
             {sql_sk("desarrollo_largo", "unidad")} AS unidad_key
      FROM ({SQL_STAGING_OVERDUE}))
SELECT p.id_venta, p.no_pago, p.desarrollo_largo, p.unidad, p.unidad_key,
       s.n_eventos_cronograma, s.ultima_fecha_proceso
FROM p LEFT JOIN s ON p.unidad_key = s.unidad_key
""",
)
def null_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overdue rows joined to the schedule on the hashed unit key (null unit = null unit)."""
    t = Tables(spark, sf_dir)
    p = staged_overdue(t).select(
        "id_venta", "no_pago", "desarrollo_largo", "unidad",
        surrogate_key("desarrollo_largo", "unidad").alias("unidad_key"),
    )
    s = schedule_per_unit_summary(staged_schedule(t))
    return p.join(s, "unidad_key", "left").select(
        "id_venta", "no_pago", "desarrollo_largo", "unidad", "unidad_key",
        "n_eventos_cronograma", "ultima_fecha_proceso",
    )


# ---------------------------------------------------------------------------
# Survivor dedup, distinct rows, distinct values per key


def sale_attributes(report: DataFrame) -> DataFrame:
    """Per sale, the independent max of each of the 22 attributes of the main-customer
    report (text max is lexicographic)."""
    return survivor_max(require_present(report, "id_venta"), ["id_venta"], SALE_ATTRIBUTES)


@named
def sale_attributes_of(t: Tables) -> DataFrame:
    return sale_attributes(staged_sale_rows(t))


SQL_SALE_ATTRIBUTES = f"""
    SELECT id_venta, {", ".join(f"max({c}) AS {c}" for c in SALE_ATTRIBUTES)}
    FROM ({SQL_STAGED_SALE_ROWS}) WHERE id_venta IS NOT NULL GROUP BY id_venta"""


@register("survivor_max", SQL_SALE_ATTRIBUTES)
def survivor_max_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sale_attributes_of(Tables(spark, sf_dir))


@register(
    "distinct_rows",
    """
SELECT DISTINCT c_nationkey, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS segmento
FROM customer
""",
)
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-row distinct; null equals null."""
    c = Tables(spark, sf_dir).customer
    return c.select(
        "c_nationkey", maybe_null(F.col("c_custkey"), F.col("c_mktsegment")).alias("segmento")
    ).distinct()


@register(
    "distinct_per_key",
    f"""
SELECT id_venta, count(DISTINCT asesor) AS distintos_asesores
FROM ({SQL_STAGED_SALE_ROWS}) GROUP BY id_venta HAVING count(DISTINCT asesor) > 1
""",
)
def distinct_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales that the main-customer report gives several agents."""
    rows = staged_sale_rows(Tables(spark, sf_dir)).select("id_venta", "asesor")
    return distinct_count_above(rows, "id_venta", "asesor", "distintos_asesores")


# ---------------------------------------------------------------------------
# Parties per sale: main customer of each order + suppliers of its lines


PARTY_COLS = [
    "id_venta", "rol_persona_en_venta", "nombre_cliente", "apellido_paterno", "apellido_materno",
    "edad", "lugar_nacimiento", "rfc", "curp", "calle", "no_exterior", "no_interior", "colonia",
    "codigo_postal", "localidad", "estado", "pais", "nacionalidad", "ocupacion", "email",
    "telefono_celular", "telefono_local", "identificacion", "no_identificacion", "sexo",
    "estado_civil", "regimen", "es_venta_cancelada",
]


def party_reports_by_sale(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Main-customer and co-owner reports, party columns only: one row per (sale, party).
    Sale attributes, and the lookups they need, are left out."""
    return (
        _with_role(party_report(main_links(t), staged_customers(t)), ROLE_MAIN),
        _with_role(party_report(co_owner_pairs(t), staged_suppliers(t)), ROLE_CO_OWNER),
    )


def _with_role(parties: DataFrame, role: str) -> DataFrame:
    return parties.withColumns({"rol_persona_en_venta": F.lit(role), "es_venta_cancelada": F.lit(False)})


def sale_parties(main: DataFrame, co_owners: DataFrame, distinct: bool = True) -> DataFrame:
    """Union of both party reports, identity columns, sales present, distinct rows.

    ``distinct=False`` skips the whole-row distinct for readers that do not depend
    on row multiplicity: a reader that projects and then de-duplicates (the
    bridge), takes per-key maxima (the party dimension) or counts distinct values
    (conflict audits) gets the same result, and without the distinct Catalyst can
    prune the ~30 staged columns down to the ones the reader uses.
    """
    union = main.select(*PARTY_COLS).unionByName(co_owners.select(*PARTY_COLS))
    prepared = with_party_identity(require_present(union, "id_venta"))
    return prepared.distinct() if distinct else prepared


def sale_parties_of(t: Tables, distinct: bool = True) -> DataFrame:
    if distinct:
        return functools.reduce(DataFrame.unionByName, [profiles_of_links(*x) for x in profiled_links(t)])
    return sale_parties(*party_reports_by_sale(t), distinct=False)


def profiled_links(t: Tables) -> list[tuple[DataFrame, DataFrame, str]]:
    """For each role: (id_venta, profile) without repeats, and every profile's columns once.

    Whole rows of a sale's party are equal where the sale, the role and the party's columns are,
    so rows are told apart by a digest of these columns, which is made once for a party: what
    is shuffled by the sale is narrow. A party that no table knows has no profile (null).
    """
    out = []
    for links, parties, role in (
        (main_links(t), staged_customers(t), ROLE_MAIN),
        (co_owner_pairs(t), staged_suppliers(t), ROLE_CO_OWNER),
    ):
        own = [c for c in parties.columns if c not in ("party_id", "v")]
        digest = F.substring(F.unhex(F.sha2(F.to_json(F.struct(*own)), 256)), 1, 16)
        told = parties.withColumn("profile", digest)
        pairs = party_report(require_present(links, "id_venta"), told.select("party_id", "v", "profile"))
        out.append((pairs.distinct(), told.drop("party_id", "v").dropDuplicates(["profile"]), role))
    return out


def profiles_of_links(links: DataFrame, profiles: DataFrame, role: str, how: str = "left") -> DataFrame:
    """The party rows of (id_venta, profile) links, with their identity."""
    rows = _with_role(links.join(profiles, "profile", how), role)
    return with_party_identity(rows.select(*PARTY_COLS))


def party_profiles(t: Tables, pairs: DataFrame | None = None) -> DataFrame:
    """One staged row per (role, party) that takes part in at least one sale.

    For readers that aggregate per natural key - the party dimension (max of each
    attribute) and the party-key conflict audit (distinct values) - these rows give
    the same result as the (sale, party) union: a party's attributes and natural key
    do not depend on the sale, so its repeats across sales add nothing. The sales only
    say which parties appear; a party that no table knows has null columns. ``pairs``
    stands for the co-owners' links where the caller has them without repeats.
    """
    profiles = []
    for links, parties, role in (
        (main_links(t), staged_customers(t), ROLE_MAIN),
        (co_owner_links(t) if pairs is None else pairs, staged_suppliers(t), ROLE_CO_OWNER),
    ):
        seen = require_present(links, "id_venta").select("party_id", "v").distinct()
        profiles.append(_with_role(party_report(seen, parties), role))
    return with_party_identity(functools.reduce(DataFrame.unionByName, profiles))


def natural_links(t: Tables) -> DataFrame:
    """Distinct (id_venta, persona_natural_key, rol_persona_en_venta) of the sales' parties.

    The natural key is the party's own, so it is made once for a party, and only the key is
    joined to the links; a party that no table knows has the key of no values, an empty text.
    """
    rows = []
    for links, parties, role in (
        (main_links(t), staged_customers(t), ROLE_MAIN),
        (co_owner_links(t), staged_suppliers(t), ROLE_CO_OWNER),
    ):
        keys = with_party_identity(parties).select("party_id", "v", "persona_natural_key")
        keyed = party_report(require_present(links, "id_venta"), keys)
        natural = F.coalesce(F.col("persona_natural_key"), F.lit("")).alias("persona_natural_key")
        rows.append(keyed.select("id_venta", natural, F.lit(role).alias("rol_persona_en_venta")))
    return functools.reduce(DataFrame.unionByName, rows).distinct()


SQL_SALE_PARTIES = f"""
    SELECT DISTINCT *, {SQL_PARTY_IDENTITY}
    FROM (
        SELECT {", ".join(PARTY_COLS)} FROM ({SQL_MAIN_REPORT})
        UNION ALL
        SELECT {", ".join(PARTY_COLS)} FROM ({SQL_CO_OWNER_REPORT})
    ) WHERE id_venta IS NOT NULL"""


@register("party_union", SQL_SALE_PARTIES)
def party_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sale_parties_of(Tables(spark, sf_dir))


PARTY_DIM_ATTRS = [
    "nombre_completo", "nombre_cliente", "apellido_paterno", "apellido_materno", "edad", "rfc",
    "curp", "telefono_celular", "telefono_local", "sexo", "estado_civil", "regimen", "ocupacion",
    "nacionalidad", "lugar_nacimiento", "calle", "no_exterior", "no_interior", "colonia",
    "codigo_postal", "localidad", "estado", "pais", "identificacion", "no_identificacion",
]


def dim_parties(parties: DataFrame) -> DataFrame:
    """One row per natural key: independent max of each attribute, e-mail lower-cased."""
    present = require_present(parties, "persona_natural_key")
    merged = survivor_max(
        present, ["persona_natural_key"], PARTY_DIM_ATTRS, {"email": F.lower("email")}
    )
    return merged.select(
        surrogate_key("persona_natural_key").alias("persona_key"), "persona_natural_key",
        *PARTY_DIM_ATTRS, "email",
    )


SQL_DIM_PARTIES = f"""
    SELECT {sql_sk("persona_natural_key")} AS persona_key, persona_natural_key,
           {", ".join(f"max({c}) AS {c}" for c in PARTY_DIM_ATTRS)}, max(lower(email)) AS email
    FROM ({SQL_SALE_PARTIES}) WHERE persona_natural_key IS NOT NULL
    GROUP BY persona_natural_key"""


@register("party_dim", SQL_DIM_PARTIES)
def party_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_parties(party_profiles(Tables(spark, sf_dir)))


def sale_keys(t: Tables) -> DataFrame:
    return t.orders.select(
        surrogate_key("o_orderkey").alias("venta_key"), F.col("o_orderkey").alias("id_venta")
    )


def sale_keys_of(sales: DataFrame) -> DataFrame:
    """(venta_key, id_venta) of the sale list. The bridge ends in a distinct, so
    joining these keys gives the same rows as joining the whole sales fact."""
    return sales.select(surrogate_key("id_venta").alias("venta_key"), "id_venta")


def bridge_sale_party(parties: DataFrame, sales: DataFrame) -> DataFrame:
    """Distinct (sale, party, role) for parties whose sale exists."""
    p = require_present(parties, "id_venta", "persona_natural_key")
    return (
        p.join(sales.select("venta_key", "id_venta"), "id_venta", "inner")
        .select(
            "venta_key",
            surrogate_key("persona_natural_key").alias("persona_key"),
            "id_venta",
            "rol_persona_en_venta",
        )
        .distinct()
    )


SQL_BRIDGE = f"""
    SELECT DISTINCT {sql_sk("o.o_orderkey")} AS venta_key,
           {sql_sk("p.persona_natural_key")} AS persona_key, p.id_venta, p.rol_persona_en_venta
    FROM ({SQL_SALE_PARTIES}) p JOIN orders o ON p.id_venta = o.o_orderkey
    WHERE p.id_venta IS NOT NULL AND p.persona_natural_key IS NOT NULL"""


@register("bridge", SQL_BRIDGE)
def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return bridge_sale_party(sale_parties_of(t, distinct=False), sale_keys(t))


# ---------------------------------------------------------------------------
# Facts


SALE_FACT_COLS = [
    "status_venta", "status_unidad", "plan", "equipo", "asesor", "status_escritura",
    "fecha_primer_enganche", "fecha_ultimo_pago_enganche", "fecha_contrato", "fecha_firma_contrato",
    "fecha_escritura", "fecha_prospectacion", "fecha_registro_venta", "fecha_aprobacion_jd",
    "fecha_registro_carga_contrato", "precio_venta", "precio_m2_venta", "enganche", "financiamiento",
    "valor_escritura", "num_mensualidades", "dia_pago", "entro_dv", "requiere_factura",
]
FROM_SALE = ["status_venta", "status_unidad", "equipo", "fecha_primer_enganche",
              "fecha_ultimo_pago_enganche", "precio_venta"]
_FROM_DASHBOARD = ["precio_m2_venta", "requiere_factura"]
_FROM_ATTRIBUTES = [c for c in SALE_FACT_COLS if c not in ("plan", *FROM_SALE, *_FROM_DASHBOARD)]


# id_venta as two columns without nulls. A join on them matches a missing id with a missing id,
# and aggregations and joins by them leave the rows dealt alike, so nothing moves between them.
MATCH = ["__sale", "__no_sale"]


def with_match(df: DataFrame) -> DataFrame:
    """``df`` with the columns ``MATCH`` of its id_venta."""
    sale = F.col("id_venta")
    return df.withColumns(dict(zip(MATCH, (F.coalesce(sale, F.lit(0).cast("bigint")), sale.isNull()))))


def sale_core(
    sales: DataFrame, attributes: DataFrame, dashboard: DataFrame,
    key: tuple[str, ...] | list[str] = ("id_venta",), more: tuple[str, ...] | list[str] = (),
) -> DataFrame:
    """The sales fact before its keys are hashed: id_venta, the unit's two key columns, ``more``
    columns of ``sales`` and the fact's columns. Both joins are on ``key`` (id_venta, or ``MATCH``,
    which the core then has too), so the sales are shuffled once."""
    key = list(key)
    a = attributes.select(*key, F.col("plan").alias("__a_plan"), *_FROM_ATTRIBUTES)
    d = require_present(dashboard, "id_venta").select(*key, *_FROM_DASHBOARD)
    own = dict.fromkeys([*key, "id_venta", "desarrollo_largo", "unidad", *more])
    s = sales.select(*own, F.col("plan").alias("__plan"), *FROM_SALE)
    j = s.join(a, key, "left").join(d, key, "left")
    return j.withColumn("plan", F.coalesce("__plan", "__a_plan")).select(*own, *SALE_FACT_COLS)


def fact_sales(sales: DataFrame, attributes: DataFrame, dashboard: DataFrame) -> DataFrame:
    """Sales + survivor attributes + two dashboard columns; plan from the sale first."""
    return fact_of_core(sale_core(sales, attributes, dashboard))


def fact_of_core(core: DataFrame, *more: str) -> DataFrame:
    """The sales fact of a sale core: its keys hashed; ``more`` columns of the core come first."""
    return core.select(
        *more,
        surrogate_key("id_venta").alias("venta_key"),
        "id_venta",
        surrogate_key("desarrollo_largo", "unidad").alias("unidad_key"),
        *SALE_FACT_COLS,
    )


def sale_core_of(t: Tables) -> DataFrame:
    return sale_core(sales_list(t), sale_attributes_of(t), dashboard_columns(t, "id_venta", *_FROM_DASHBOARD))


def matched_core_of(t: Tables, sales: DataFrame | None = None, more: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """The sale core with ``MATCH``, for readers that join more by the sale. ``sales`` stands for
    the sale list where the caller has joined ``more`` columns to it."""
    report = with_match(require_present(staged_sale_rows(t), "id_venta"))
    attributes = survivor_max(report, MATCH, SALE_ATTRIBUTES)
    dashboard = dashboard_columns(t, "id_venta", *_FROM_DASHBOARD)
    listed = sales_list(t) if sales is None else sales
    return sale_core(with_match(listed), attributes, with_match(dashboard), MATCH, more)


def sales_fact_of(t: Tables) -> DataFrame:
    return fact_of_core(sale_core_of(t))


def _sql_sale_fact_column(c: str) -> str:
    if c == "plan":
        return "coalesce(v.plan, a.plan) AS plan"
    return ("v." if c in FROM_SALE else "d." if c in _FROM_DASHBOARD else "a.") + c


SQL_FACT_SALES = f"""
    SELECT {sql_sk("v.id_venta")} AS venta_key, v.id_venta,
           {sql_sk("v.desarrollo_largo", "v.unidad")} AS unidad_key,
           {", ".join(map(_sql_sale_fact_column, SALE_FACT_COLS))}
    FROM ({SQL_SALES_LIST}) v
    LEFT JOIN ({SQL_SALE_ATTRIBUTES}) a ON v.id_venta = a.id_venta
    LEFT JOIN (SELECT id_venta, precio_m2_venta, requiere_factura FROM ({SQL_STAGE_DASHBOARD})
               WHERE id_venta IS NOT NULL) d ON v.id_venta = d.id_venta"""


@register("sales_fact", SQL_FACT_SALES)
def sales_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_fact_of(Tables(spark, sf_dir))


PAYMENT_FACT_COLS = [
    "folio", "status_ingreso", "status_venta", "fecha_ingreso", "fecha_amortizacion",
    "fecha_captura", "banco", "forma_pago", "concepto", "referencia_ingresos", "status_tercero",
    "nombre_tercero", "cliente", "monto_pagado",
]
PAYMENT_KEY_COLS = [
    "id_venta", "folio", "status_ingreso", "status_venta", "fecha_ingreso", "fecha_amortizacion",
    "fecha_captura", "referencia_ingresos", "monto_pagado", "concepto", "forma_pago", "banco",
]


def fact_payments(staged: DataFrame) -> DataFrame:
    """Payments with an amount, keyed by 12 columns, plus sale and unit keys.

    A present amount already makes the row non-blank, so the 19-column
    ``concat_ws`` blank test is implied and not evaluated here.
    """
    return require_present(staged, "monto_pagado").select(
        surrogate_key(*PAYMENT_KEY_COLS).alias("ingreso_key"),
        surrogate_key("id_venta").alias("venta_key"),
        "id_venta",
        surrogate_key("desarrollo_largo", "unidad").alias("unidad_key"),
        *PAYMENT_FACT_COLS,
    )


def payments_fact_of(t: Tables) -> DataFrame:
    return fact_payments(stage_payments(raw_payments(t)))


PAYMENT_MEASURES = ["venta_key", "id_venta", "monto_pagado", "status_ingreso", "fecha_ingreso"]
OVERDUE_MEASURES = ["venta_key", "id_venta", "monto_vencido", "dias_atraso", "fecha_pago"]


def payment_measures(t: Tables) -> DataFrame:
    """The payment fact restricted to columns that do not come from the sale / unit
    lookups. Those lookups are left joins on unique keys (one order per order key,
    one unit per customer), so they neither add nor drop payment rows: skipping them
    yields exactly these columns of the full fact without two large joins."""
    return fact_payments(stage_payments(raw_payments(t, enrich=False))).select(*PAYMENT_MEASURES)


def overdue_measures(t: Tables) -> DataFrame:
    """The overdue fact restricted to columns that do not need the unit lookup."""
    return fact_overdue(staged_overdue(t, enrich=False)).select(*OVERDUE_MEASURES)


SQL_FACT_PAYMENTS = f"""
    SELECT {sql_sk(*PAYMENT_KEY_COLS)} AS ingreso_key, {sql_sk("id_venta")} AS venta_key, id_venta,
           {sql_sk("desarrollo_largo", "unidad")} AS unidad_key,
           {", ".join(c for c in PAYMENT_FACT_COLS if c != "monto_pagado")},
           CAST(monto_pagado AS DECIMAL(10,2)) AS monto_pagado
    FROM ({SQL_STAGING_PAYMENTS}) WHERE NOT es_venta_cancelada AND monto_pagado IS NOT NULL"""


@register("payment_fact", SQL_FACT_PAYMENTS)
def payment_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments_fact_of(Tables(spark, sf_dir))
