"""Payment-plan label normalisation (first matching rule wins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estrella.functions.text import col_

# Plan-label rules, in evaluation order.
# (pattern on trim(upper(plan)), output label)
PLAN_RULES = [
    ("%CONTADO%", "CONTADO"),
    ("48 MEESES%", "48 MESES"),
    ("48 MESES.%", "48 MESES"),
    ("24 MESES.%", "24 MESES"),
    ("60 MESES.%", "60 MESES"),
    ("12 MESES.%", "12 MESES"),
]


def normalize_plan(c: Column | str) -> Column:
    """Map a raw plan label; unmatched labels keep their case, trimmed.

    ``trim(upper(x))`` is computed once and every rule is a LIKE on it
    (``.`` is literal, ``%`` a wildcard).
    """
    raw = col_(c)
    key = F.trim(F.upper(raw))
    expr = None
    for pattern, label in PLAN_RULES:
        cond = key.like(pattern)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.trim(raw))
