"""Values that a forgiving cast loses, kept beside the cleaned rows of the same pass.

A cast that gives null instead of an error hides what was delivered. ``rejects`` collects,
for each row, the raw texts that are there but that their cast could not read; written
with the cleaned columns, one table serves the readers of both.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrella.functions.text import null_tokens
from estrella.sources.versions import replace_table

REJECTS = "__rejects"


@dataclass(frozen=True)
class CastRule:
    """The cleaned column, the raw column it is read from, the cast and a name for the rule."""

    column: str
    raw: str
    cast: Column
    rule: str


def rejects(rules: list[CastRule]) -> Column:
    """Per row, an array of (column_name, raw_text, rule): raw texts that are neither missing,
    blank nor the null token, and whose cast is null."""
    found = [
        F.when(
            null_tokens(r.raw).isNotNull() & (F.upper(null_tokens(r.raw)) != "NULL") & r.cast.isNull(),
            F.struct(
                F.lit(r.column).alias("column_name"),
                F.col(r.raw).cast("string").alias("raw_text"),
                F.lit(r.rule).alias("rule"),
            ),
        )
        for r in rules
    ]
    return F.array_compact(F.array(*found)).alias(REJECTS)


def split_rejects(staged: DataFrame, key: list[str], location: str) -> tuple[DataFrame, DataFrame]:
    """(cleaned rows, rejected values) of ``staged``, which has a column of ``rejects``.

    ``staged`` is computed once, written as the next version of the table at ``location``;
    a reader of the rejects reads the key and that column alone. Every cleaned row stays.
    """
    whole = replace_table(staged, location)
    found = whole.where(F.size(REJECTS) > 0).select(*key, F.explode(REJECTS).alias("r")).select(*key, "r.*")
    return whole.drop(REJECTS), found
