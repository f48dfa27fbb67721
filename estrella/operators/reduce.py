"""Grouping operators: survivor dedup, conditional aggregates, audits on distinct values.

All of them are hash aggregations with a partial (map-side) phase, so a key that
holds a large share of the rows is reduced to one row per task before the
shuffle and never gathered into a single task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrella.functions.text import col_


def survivor_max(
    df: DataFrame,
    keys: list[str],
    cols: Iterable[str] = (),
    exprs: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per key: the **independent** max of each column.

    Values may come from different source rows (this is not "latest row wins");
    max on text is lexicographic. ``exprs`` adds max of expressions
    (e.g. ``{"email": F.lower("email")}``).
    """
    aggs = [F.max(c).alias(c) for c in cols]
    aggs += [F.max(e).alias(name) for name, e in (exprs or {}).items()]
    return df.groupBy(*keys).agg(*aggs)


def sum_where(value: Column | str, condition: Column) -> Column:
    """``sum(case when cond then value end)`` - null when no row matches."""
    return F.sum(F.when(condition, col_(value)))


def count_where(condition: Column) -> Column:
    """``sum(case when cond then 1 else 0 end)`` - 0 when no row matches."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def max_where(value: Column | str, condition: Column) -> Column:
    """``max(case when cond then value end)`` - the pick-one-per-role pivot."""
    return F.max(F.when(condition, col_(value)))


def distinct_value_conflicts(
    df: DataFrame,
    keys: list[str],
    values: Mapping[str, Column],
    counts_as: Mapping[str, str] | None = None,
) -> DataFrame:
    """Keys where any value expression takes more than one distinct non-null value.

    Output: ``keys`` + one exact ``count(distinct value)`` column per entry
    (named by ``counts_as[name]`` or ``name``), only for the flagged keys.

    One pass: each row becomes its non-null (column, value) pairs, which are made
    distinct with a map-side phase, counted per key and column, and turned back to
    columns. The input is computed once, however many keys turn out to be flagged.
    """
    counts_as = dict(counts_as or {})
    names = list(values)
    pairs = F.array(
        *[
            F.when(e.isNotNull(), F.struct(F.lit(i).alias("i"), e.cast("string").alias("x")))
            for i, e in enumerate(values.values())
        ]
    )
    # a key none of whose values is present has no pair and cannot be flagged
    long = df.select(*[F.col(k) for k in keys], F.explode(F.array_compact(pairs)).alias("__p"))
    long = long.select(*keys, F.col("__p.i").alias("__i"), F.col("__p.x").alias("__x")).distinct()
    counts = [count_where(F.col("__i") == i).alias(counts_as.get(n, n)) for i, n in enumerate(names)]
    flag = None
    for n in names:
        term = F.col(counts_as.get(n, n)) > 1
        flag = term if flag is None else (flag | term)
    return long.groupBy(*keys).agg(*counts).filter(flag)


def conflicting_keys(df: DataFrame, keys: list[str], values: Mapping[str, Column]) -> DataFrame:
    """Keys where any value expression takes more than one non-null value, without counts:
    ``min <> max`` in one plain aggregation."""
    projected = df.select(*[F.col(k) for k in keys], *[e.alias(n) for n, e in values.items()])
    bounds, flag = [], None
    for name in values:
        bounds += [F.min(name).alias(f"__min_{name}"), F.max(name).alias(f"__max_{name}")]
        term = F.col(f"__min_{name}") != F.col(f"__max_{name}")
        flag = term if flag is None else (flag | term)
    return projected.groupBy(*keys).agg(*bounds).filter(flag).select(*keys)


def find_duplicates(
    df: DataFrame,
    cols: list[str],
    count_name: str = "total",
    distinct_of: Mapping[str, str] | None = None,
) -> DataFrame:
    """Groups of ``cols`` (nulls form a group) with more than one row.

    ``distinct_of`` maps output name -> column for an extra exact distinct count.
    """
    aggs = [F.count(F.lit(1)).alias(count_name)]
    aggs += [F.count_distinct(F.col(c)).alias(name) for name, c in (distinct_of or {}).items()]
    return df.groupBy(*cols).agg(*aggs).filter(F.col(count_name) > 1)


def distinct_count_above(
    df: DataFrame, key: str | list[str], value: Column | str, name: str, threshold: int = 1
) -> DataFrame:
    """Keys whose ``count(distinct value)`` exceeds ``threshold`` (nulls not counted)."""
    keys = [key] if isinstance(key, str) else list(key)
    return (
        df.groupBy(*keys)
        .agg(F.count_distinct(col_(value)).alias(name))
        .filter(F.col(name) > threshold)
    )
