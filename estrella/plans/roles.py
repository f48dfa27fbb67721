"""Role mapping: the driver's TPC-H-like tables playing the warehouse's source roles.

Every frame here is a lazy projection / join of the input tables, so all work
grows with them. Each Spark builder has an SQL twin (``SQL_*``) used by the
DuckDB oracle; both compute the same deterministic "dirty" values from the same
columns.

Roles
-----
* sale ............ ``orders`` (``o_orderkey`` = id_venta)
* payment ......... ``lineitem`` (``l_orderkey`` = sale, ``l_linestatus 'O'`` = active)
* overdue payment . ``lineitem`` rows with ``l_returnflag = 'R'``
* unit ............ the sale's customer: development = nation name, unit = customer
  name, short development name = ``'N' || nationkey``, stage = ``'ETAPA ' || regionkey``,
  model = market segment
* group seed ...... ``nation`` x ``region`` (region name = group), region ``MIDDLE EAST``
  absent from the seed
* main customer / co-owner: the order's customer / the suppliers of its lines
* schedule ........ ``events`` of the user whose id equals the customer key; the event
  type (and, where a type stands for two milestones, the parity of the event id) names
  the milestone

Reports are made to disagree by rules on key columns, so that every audit has findings
and non-findings: some orders have no main customer, a second one, or a row repeated
with another country; some payments name a sale that does not exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrella.operators.joins import bounded_broadcast
from estrella.sources.tables import Tables

# Fixed values shared with the SQL twins: raw plan labels (dirt), the developments that
# the test marts exclude, the region left out of the seed and the unparseable date text.
PLAN_LABELS = [
    "CONTADO 5%", "48 MEESES X", "48 MESES. A", "48 MESES", "48 meses. a", "36 MESES.",
    " otro ", None,
]
EXCLUDED_SHORT_NAMES = ["N3", "N7"]
SEED_EXCLUDED_REGION = "MIDDLE EAST"
BAD_DATE_TEXT = "31/12/2020"

def dirty_date(k: Column, d: Column) -> Column:
    """Date text with the source's dirt: 'NULL', '', dd/mm/yyyy, outer blanks."""
    text = d.cast("string")
    return (
        F.when(k % 11 == 0, F.lit("NULL"))
        .when(k % 13 == 0, F.lit(""))
        .when(k % 17 == 0, F.lit(BAD_DATE_TEXT))
        .when(k % 5 == 0, F.concat(F.lit(" "), text, F.lit(" ")))
        .otherwise(text)
    )


def sql_dirty_date(k: str, d: str) -> str:
    t = f"CAST({d} AS VARCHAR)"
    return (
        f"CASE WHEN {k} % 11 = 0 THEN 'NULL' WHEN {k} % 13 = 0 THEN '' "
        f"WHEN {k} % 17 = 0 THEN '{BAD_DATE_TEXT}' WHEN {k} % 5 = 0 THEN ' ' || {t} || ' ' "
        f"ELSE {t} END"
    )


# Rows of the main-customer report per order: 0 the customer, 1 a second main customer
# with other attributes, 2 the first one again with another country.
def report_variants(k: Column) -> Column:
    return F.explode(
        F.array_compact(
            F.array(
                F.when(k % 53 != 0, F.lit(0)), F.when(k % 40 == 0, F.lit(1)), F.when(k % 30 == 0, F.lit(2))
            )
        )
    )


def sql_report_variants(k: str) -> str:
    """Condition on ``v`` (0, 1 or 2) that keeps the rows of ``report_variants``."""
    return f"((v = 0 AND {k} % 53 <> 0) OR (v = 1 AND {k} % 40 = 0) OR (v = 2 AND {k} % 30 = 0))"


# Added to the sale id of every hundred-and-first payment: no such sale exists.
UNKNOWN_SALE = 5_000_000_000


def paid_sale(k: Column, line: Column) -> Column:
    return F.when((k * 7 + line) % 101 == 0, k + UNKNOWN_SALE).otherwise(k).cast("bigint")


def sql_paid_sale(k: str, line: str) -> str:
    return f"CAST(CASE WHEN ({k} * 7 + {line}) % 101 = 0 THEN {k} + {UNKNOWN_SALE} ELSE {k} END AS BIGINT)"


# Every two-hundred-and-eleventh row of the legacy dashboard names a sale that the sale list
# does not have, and a delivery of the sale list has some sales again.
def reported_sale(k: Column) -> Column:
    return F.when(k % 211 == 0, k + UNKNOWN_SALE).otherwise(k).cast("bigint")


def sql_reported_sale(k: str) -> str:
    return f"CAST(CASE WHEN {k} % 211 = 0 THEN {k} + {UNKNOWN_SALE} ELSE {k} END AS BIGINT)"


def listed_times(k: Column) -> Column:
    return F.explode(
        F.when(k % 1000 == 7, F.array(F.lit(1), F.lit(2), F.lit(3)))
        .when(k % 97 == 0, F.array(F.lit(1), F.lit(2)))
        .otherwise(F.array(F.lit(1)))
    )


def sql_listed_times(k: str) -> str:
    """Condition on ``n`` (1, 2 or 3) that keeps the rows of ``listed_times``."""
    return f"(n = 1 OR (n = 2 AND ({k} % 97 = 0 OR {k} % 1000 = 7)) OR (n = 3 AND {k} % 1000 = 7))"


def maybe_null(k: Column, x: Column) -> Column:
    return F.when(k % 7 != 0, x)


def plan_label(k: Column) -> Column:
    expr = None
    for i, label in enumerate(PLAN_LABELS):
        cond = k % len(PLAN_LABELS) == i
        value = F.lit(label).cast("string")
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr


def sql_plan_label(k: str) -> str:
    parts = []
    for i, label in enumerate(PLAN_LABELS):
        v = "NULL" if label is None else "'" + label.replace("'", "''") + "'"
        parts.append(f"WHEN {k} % {len(PLAN_LABELS)} = {i} THEN {v}")
    return "CASE " + " ".join(parts) + " END"


# ---------------------------------------------------------------------------
# Units: customer x nation. The nations are 25 and the regions 5 at every scale of the
# test tables, so their broadcast has a proven bound.
NATION_ROWS = 25


def customer_units(t: Tables, *more: str) -> DataFrame:
    """Each customer's unit, with ``more`` columns of the customer."""
    c, n = t.customer, bounded_broadcast(t.nation, NATION_ROWS)
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        "c_custkey",
        F.col("n_name").alias("desarrollo_largo"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("desarrollo_corto"),
        F.col("c_name").alias("unidad"),
        F.concat(F.lit("ETAPA "), F.col("n_regionkey").cast("string")).alias("etapa"),
        F.col("c_mktsegment").alias("modelo"),
        *more,
    )


SQL_CUSTOMER_UNITS = """
    SELECT c.c_custkey, n.n_name AS desarrollo_largo,
           'N' || CAST(c.c_nationkey AS VARCHAR) AS desarrollo_corto,
           c.c_name AS unidad, 'ETAPA ' || CAST(n.n_regionkey AS VARCHAR) AS etapa,
           c.c_mktsegment AS modelo
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""


def group_seed(t: Tables) -> DataFrame:
    """The development-group lookup: (long name, short name) -> group."""
    n, r = t.nation, bounded_broadcast(t.region, NATION_ROWS)
    return (
        n.join(r, n.n_regionkey == r.r_regionkey, "inner")
        .where(F.col("r_name") != SEED_EXCLUDED_REGION)
        .select(
            F.col("n_name").alias("desarrollo_largo"),
            F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("desarrollo_corto"),
            F.col("r_name").alias("grupo_2"),
        )
    )


SQL_GROUP_SEED = f"""
    SELECT n.n_name AS desarrollo_largo, 'N' || CAST(n.n_nationkey AS VARCHAR) AS desarrollo_corto,
           r.r_name AS grupo_2
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
    WHERE r.r_name <> '{SEED_EXCLUDED_REGION}'"""
