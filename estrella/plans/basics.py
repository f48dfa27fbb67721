"""Scans, projections, filters and scalar cleaning functions on the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrella.functions import (
    damage_utf8_as_latin1,
    lower_trimmed,
    money,
    normalize_plan,
    null_token,
    null_tokens,
    repair_mojibake,
    safe_date_from_text,
    safe_decimal,
    safe_int_with_words,
    title_case,
    trimmed,
    trimmed_title,
    upper_trimmed,
    zero_to_null,
)
from estrella.operators import drop_blank_rows, exclude_values, require_present
from estrella.plans.registry import register
from estrella.functions.labels import PLAN_RULES
from estrella.plans.roles import dirty_date, maybe_null, plan_label, sql_dirty_date, sql_plan_label
from estrella.sources.tables import Tables

EXCLUDED_PRIORITIES = ["1-URGENT", "5-LOW"]

# DuckDB has no initcap: capitalise each blank-separated word (Spark semantics).
SQL_INITCAP = (
    "array_to_string(list_transform(string_split(lower({x}), ' '), "
    "lambda w: upper(w[1]) || w[2:]), ' ')"
)


def sql_initcap(x: str) -> str:
    return SQL_INITCAP.format(x=x)


# ---------------------------------------------------------------------------


@register(
    "scan_projection",
    """
SELECT o_orderkey AS id_venta, o_custkey AS id_cliente,
       trim(upper(o_orderstatus)) AS status_venta,
       CAST(o_totalprice AS DECIMAL(18,2)) AS precio_venta,
       CAST(o_orderdate AS DATE) AS fecha_venta,
       trim(upper(o_orderpriority)) AS prioridad
FROM orders
""",
)
def scan_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename-and-clean projection of a raw table, retyped at the scan."""
    o = Tables(spark, sf_dir).orders
    return o.select(
        F.col("o_orderkey").alias("id_venta"),
        F.col("o_custkey").alias("id_cliente"),
        upper_trimmed("o_orderstatus").alias("status_venta"),
        money("o_totalprice").alias("precio_venta"),
        F.col("o_orderdate").cast("date").alias("fecha_venta"),
        upper_trimmed("o_orderpriority").alias("prioridad"),
    )


def _nullable_orders(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(
        "o_orderkey",
        maybe_null(F.col("o_orderkey"), F.col("o_orderstatus")).alias("status_venta"),
        maybe_null(F.col("o_custkey"), F.col("o_orderpriority")).alias("prioridad"),
    )


SQL_NULLABLE_ORDERS = """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS status_venta,
           CASE WHEN o_custkey % 7 <> 0 THEN o_orderpriority END AS prioridad
    FROM orders"""


@register(
    "filter_not_null",
    f"SELECT * FROM ({SQL_NULLABLE_ORDERS}) WHERE status_venta IS NOT NULL AND prioridad IS NOT NULL",
)
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return require_present(_nullable_orders(Tables(spark, sf_dir)), "status_venta", "prioridad")


@register(
    "exclude_list",
    f"SELECT * FROM ({SQL_NULLABLE_ORDERS}) WHERE prioridad NOT IN ('1-URGENT', '5-LOW')",
)
def exclude_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``NOT IN``: rows with a null value disappear as well (3-valued logic)."""
    return exclude_values(_nullable_orders(Tables(spark, sf_dir)), "prioridad", EXCLUDED_PRIORITIES)


@register(
    "filter_blank_rows",
    """
SELECT * FROM (
    SELECT s_suppkey,
           CASE WHEN s_suppkey % 7 = 0 THEN (CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE '' END)
                ELSE s_name END AS nombre,
           CASE WHEN s_suppkey % 7 = 0 THEN NULL
                ELSE CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS saldo_texto,
           CASE WHEN s_suppkey % 7 = 0 AND s_suppkey % 3 <> 0 THEN ''
                ELSE CAST(s_nationkey AS VARCHAR) END AS nacion_texto
    FROM supplier)
WHERE concat_ws('', nombre, saldo_texto, nacion_texto) <> ''
""",
)
def filter_blank_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop rows whose payload columns are all null or empty."""
    s = Tables(spark, sf_dir).supplier
    k = F.col("s_suppkey")
    gone = k % 7 == 0
    df = s.select(
        "s_suppkey",
        F.when(gone, F.when(k % 2 == 0, F.lit(None).cast("string")).otherwise(F.lit("")))
        .otherwise(F.col("s_name"))
        .alias("nombre"),
        F.when(~gone, money("s_acctbal").cast("string")).alias("saldo_texto"),
        F.when(gone & (k % 3 != 0), F.lit("")).otherwise(F.col("s_nationkey").cast("string"))
        .alias("nacion_texto"),
    )
    return drop_blank_rows(df, ["nombre", "saldo_texto", "nacion_texto"])


@register(
    "text_clean",
    f"""
SELECT p_partkey, raw, trim(raw) AS recortado, trim(upper(raw)) AS mayusculas,
       lower(trim(raw)) AS minusculas, {sql_initcap("trim(lower(raw))")} AS titulo,
       trim({sql_initcap("raw")}) AS titulo_recortado
FROM (
    SELECT p_partkey,
           CASE WHEN p_partkey % 3 = 0 THEN '  ' || lower(p_name) || ' '
                WHEN p_partkey % 3 = 1 THEN upper(p_name)
                ELSE ' ' || p_name END AS raw
    FROM part)
""",
)
def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Tables(spark, sf_dir).part
    k = F.col("p_partkey")
    raw = (
        F.when(k % 3 == 0, F.concat(F.lit("  "), F.lower("p_name"), F.lit(" ")))
        .when(k % 3 == 1, F.upper("p_name"))
        .otherwise(F.concat(F.lit(" "), F.col("p_name")))
    )
    df = p.select("p_partkey", raw.alias("raw"))
    return df.select(
        "p_partkey",
        "raw",
        trimmed("raw").alias("recortado"),
        upper_trimmed("raw").alias("mayusculas"),
        lower_trimmed("raw").alias("minusculas"),
        title_case("raw").alias("titulo"),
        trimmed_title("raw").alias("titulo_recortado"),
    )


@register(
    "null_tokens",
    f"""
SELECT o_orderkey, fecha_raw,
       nullif(nullif(trim(fecha_raw), 'NULL'), '') AS fecha_texto,
       nullif(trim(upper(localidad_raw)), '0') AS localidad,
       nullif(CAST(o_custkey AS VARCHAR), 'NULL') AS cliente_texto,
       nullif(valor_raw, 'NULL') AS valor_escritura
FROM (
    SELECT o_orderkey, o_custkey,
           {sql_dirty_date("o_orderkey", "CAST(o_orderdate AS DATE)")} AS fecha_raw,
           CASE WHEN o_orderkey % 9 = 0 THEN ' 0 ' ELSE o_orderpriority END AS localidad_raw,
           CASE WHEN o_orderkey % 4 = 0 THEN 'NULL'
                ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS valor_raw
    FROM orders)
""",
)
def null_tokens_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    k = F.col("o_orderkey")
    df = o.select(
        "o_orderkey",
        "o_custkey",
        dirty_date(k, F.col("o_orderdate").cast("date")).alias("fecha_raw"),
        F.when(k % 9 == 0, F.lit(" 0 ")).otherwise(F.col("o_orderpriority")).alias("localidad_raw"),
        F.when(k % 4 == 0, F.lit("NULL"))
        .otherwise(money("o_totalprice").cast("string"))
        .alias("valor_raw"),
    )
    return df.select(
        "o_orderkey",
        "fecha_raw",
        null_tokens("fecha_raw").alias("fecha_texto"),
        zero_to_null("localidad_raw").alias("localidad"),
        null_token("o_custkey").alias("cliente_texto"),
        null_token("valor_raw").alias("valor_escritura"),
    )


@register(
    "safe_cast",
    f"""
SELECT p_partkey, edad_raw,
       CASE WHEN trim(edad_raw) = 'CUARENTA Y DOS' THEN 42
            ELSE try_cast(trim(edad_raw) AS INTEGER) END AS edad,
       monto_raw, try_cast(monto_raw AS DECIMAL(10,2)) AS monto,
       fecha_raw, try_cast(nullif(nullif(trim(fecha_raw), 'NULL'), '') AS DATE) AS fecha,
       CAST(p_size AS VARCHAR) AS tamano_texto, CAST(p_size AS DOUBLE) AS tamano_doble,
       CAST(p_size AS BIGINT) AS tamano_bigint
FROM (
    SELECT p_partkey, p_size,
           CASE WHEN p_partkey % 10 = 0 THEN 'CUARENTA Y DOS' WHEN p_partkey % 10 = 1 THEN 'abc'
                WHEN p_partkey % 10 = 2 THEN ' ' || CAST(p_size AS VARCHAR) || ' '
                WHEN p_partkey % 10 = 3 THEN ''
                ELSE CAST(p_size AS VARCHAR) END AS edad_raw,
           CASE WHEN p_partkey % 10 = 4 THEN '1,234.50' WHEN p_partkey % 10 = 5 THEN '123456789.01'
                ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END AS monto_raw,
           {sql_dirty_date("p_partkey", "(DATE '2020-01-01' + p_size)")} AS fecha_raw
    FROM part)
""",
)
def safe_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad text becomes null: dates, ints with a spelled-out value, decimal(10,2)."""
    p = Tables(spark, sf_dir).part
    k = F.col("p_partkey")
    size_text = F.col("p_size").cast("string")
    df = p.select(
        "p_partkey",
        "p_size",
        F.when(k % 10 == 0, F.lit("CUARENTA Y DOS"))
        .when(k % 10 == 1, F.lit("abc"))
        .when(k % 10 == 2, F.concat(F.lit(" "), size_text, F.lit(" ")))
        .when(k % 10 == 3, F.lit(""))
        .otherwise(size_text)
        .alias("edad_raw"),
        F.when(k % 10 == 4, F.lit("1,234.50"))
        .when(k % 10 == 5, F.lit("123456789.01"))
        .otherwise(money("p_retailprice").cast("string"))
        .alias("monto_raw"),
        dirty_date(k, F.date_add(F.lit("2020-01-01").cast("date"), F.col("p_size"))).alias(
            "fecha_raw"
        ),
    )
    return df.select(
        "p_partkey",
        "edad_raw",
        safe_int_with_words("edad_raw").alias("edad"),
        "monto_raw",
        safe_decimal("monto_raw", 10, 2).alias("monto"),
        "fecha_raw",
        safe_date_from_text("fecha_raw").alias("fecha"),
        F.col("p_size").cast("string").alias("tamano_texto"),
        F.col("p_size").cast("double").alias("tamano_doble"),
        F.col("p_size").cast("bigint").alias("tamano_bigint"),
    )


def sql_plan_chain(col: str) -> str:
    """SQL twin of ``normalize_plan``, from the same rules."""
    rules = " ".join(f"WHEN upper(trim({col})) LIKE '{pattern}' THEN '{label}'" for pattern, label in PLAN_RULES)
    return f"CASE {rules} ELSE trim({col}) END"


@register(
    "plan_normalize",
    f"""
SELECT p_partkey, plan_raw, {sql_plan_chain("plan_raw")} AS plan
FROM (SELECT p_partkey, {sql_plan_label("p_partkey")} AS plan_raw FROM part)
""",
)
def plan_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Tables(spark, sf_dir).part
    df = p.select("p_partkey", plan_label(F.col("p_partkey")).alias("plan_raw"))
    return df.select("p_partkey", "plan_raw", normalize_plan("plan_raw").alias("plan"))


@register("encoding_repair", "SELECT doc_id, text AS texto FROM documents")
def encoding_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage every document as the source does (UTF-8 read as Latin-1), then repair.

    Whole texts are processed; the repaired text must equal the original.
    """
    d = Tables(spark, sf_dir).documents
    return d.select("doc_id", repair_mojibake(damage_utf8_as_latin1(F.col("text"))).alias("texto"))
