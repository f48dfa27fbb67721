"""Join patterns: attach a pre-aggregated side, orphans, coverage, reconciliation.

No helper forces a broadcast of data whose size grows with the input: the
planner broadcasts below ``spark.sql.autoBroadcastJoinThreshold`` (from file
statistics) and AQE converts a sort-merge join to a broadcast join at runtime
when the real shuffle output turns out small. ``bounded_broadcast`` is only for
sides whose row count is known in advance from parameters (a calendar range).
"""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A side is hinted for broadcast only when its provable row bound is below this.
MAX_BROADCAST_ROWS = 1_000_000


def bounded_broadcast(df: DataFrame, row_bound: int, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint when the caller can prove ``df`` has at most ``row_bound`` rows.

    Beyond the limit the frame is returned unchanged and the planner falls back
    to a shuffle join (or AQE's runtime conversion).
    """
    return F.broadcast(df) if 0 <= row_bound <= max_rows else df


def attach(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    defaults: Mapping[str, object] | None = None,
    how: str = "left",
) -> DataFrame:
    """Left-join a per-key side and replace missing metrics by defaults.

    ``right`` must be unique on ``on`` (aggregate first: grain protection);
    ``defaults`` maps a right column to its value for unmatched left rows.
    """
    joined = left.join(right, on=on, how=how)
    if defaults:
        joined = joined.withColumns(
            {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()}
        )
    return joined


def left_join_spread(left: DataFrame, right: DataFrame, on: str | list[str], spread_by: list[str]) -> DataFrame:
    """Left join on ``on`` where the key is missing on many left rows.

    A row with a missing key part cannot match, but as a row of the join it would meet all
    others of its kind in one partition. It gets a stand-in, a hash of its ``spread_by``
    columns, as a second key; rows with a key, and all right rows, have 0 there. So the rows
    without a key are dealt evenly, and one pass over ``left`` serves both kinds.
    """
    keys = [on] if isinstance(on, str) else list(on)
    missing = functools.reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    a = left.withColumn("__stand_in", F.when(missing, F.xxhash64(*spread_by)).otherwise(F.lit(0)).cast("bigint"))
    # zero for every row, but not a constant: the optimizer must not take it out of the join's keys
    zero = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("bigint")
    b = right.select(
        *[F.col(k).alias(f"__on_{i}") for i, k in enumerate(keys)],
        zero.alias("__zero"),
        *[c for c in right.columns if c not in keys],
    )
    same = F.col("__stand_in") == F.col("__zero")
    for i, k in enumerate(keys):
        same &= a[k] == b[f"__on_{i}"]
    return a.join(b, same, "left").drop("__stand_in", "__zero", *[f"__on_{i}" for i in range(len(keys))])


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent (nulls never match)."""
    parent_key = parent_key or child_key
    keys = parent.select(F.col(parent_key).alias("__parent_key")).where(F.col("__parent_key").isNotNull())
    return child.join(keys, child[child_key] == keys["__parent_key"], "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None, name: str) -> DataFrame:
    """One row: number of child rows without a parent."""
    return orphans(child, parent, child_key, parent_key).agg(F.count(F.lit(1)).alias(name))


def coverage(
    child: DataFrame,
    parent: DataFrame,
    child_key: str,
    parent_key: str,
    relation: str,
    audit_type: str,
) -> DataFrame:
    """One-row relation coverage: total, matched, unmatched, % matched.

    Same numbers as ``child LEFT JOIN parent`` counted with ``count(*)`` and
    ``count(parent.key)`` - including the fan-out when a parent key repeats -
    but both sides are first reduced to one row per key with a multiplicity, so
    the shuffle carries distinct keys only and a hot key costs one row.
    """
    c = child.groupBy(F.col(child_key).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    p = (
        parent.where(F.col(parent_key).isNotNull())
        .groupBy(F.col(parent_key).alias("__k"))
        .agg(F.count(F.lit(1)).alias("__m"))
    )
    j = c.join(p, "__k", "left")
    total = F.sum(F.col("__n") * F.coalesce(F.col("__m"), F.lit(1)))
    matched = F.sum(F.col("__n") * F.coalesce(F.col("__m"), F.lit(0)))
    agg = j.agg(
        F.coalesce(total, F.lit(0)).cast("bigint").alias("total_registros"),
        F.coalesce(matched, F.lit(0)).cast("bigint").alias("con_relacion"),
    )
    return agg.select(
        F.lit(relation).alias("relacion"),
        "total_registros",
        "con_relacion",
        (F.col("total_registros") - F.col("con_relacion")).alias("sin_relacion"),
        F.round(
            F.try_divide(
                F.col("con_relacion").cast("double"),
                F.nullif(F.col("total_registros"), F.lit(0)).cast("double"),
            )
            * 100,
            2,
        ).alias("cobertura_pct"),
        F.lit(audit_type).alias("tipo_auditoria"),
    )


def no_key_coverage(df: DataFrame, relation: str, audit_type: str) -> DataFrame:
    """Coverage row for a relation without a reliable key: total only, typed nulls."""
    return df.agg(F.count(F.lit(1)).alias("total_registros")).select(
        F.lit(relation).alias("relacion"),
        "total_registros",
        F.lit(None).cast("bigint").alias("con_relacion"),
        F.lit(None).cast("bigint").alias("sin_relacion"),
        F.lit(None).cast("double").alias("cobertura_pct"),
        F.lit(audit_type).alias("tipo_auditoria"),
    )


def reconcile(
    reported: DataFrame,
    rebuilt: DataFrame,
    key: str,
    metrics: Mapping[str, tuple[str, str, str, str]],
    missing_flag: str,
) -> DataFrame:
    """Compare reported metrics with their rebuilt versions per key.

    ``metrics`` maps a difference column to (reported column, its output name, rebuilt
    column, its output name); differences are reported minus rebuilt, as decimal(38,2). A
    flag marks keys the rebuild does not have.
    """
    r = rebuilt.select(F.col(key).alias("__rk"), *[F.col(b).alias(f"__r_{d}") for d, (_, _, b, _) in metrics.items()])
    j = reported.join(r, reported[key] == r["__rk"], "left")
    cols: list[Column] = [reported[key]]
    for diff, (a, a_name, _, b_name) in metrics.items():
        mine, theirs = reported[a], F.col(f"__r_{diff}")
        cols += [mine.alias(a_name), theirs.alias(b_name), (mine - theirs).cast("decimal(38,2)").alias(diff)]
    return j.select(*cols, F.col("__rk").isNull().alias(missing_flag))
