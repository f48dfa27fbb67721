"""Column cleaning helpers (all JVM-side built-ins, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text tokens the source systems use for "no value".
NULL_TEXT_TOKEN = "NULL"
EMPTY_TEXT = ""
ZERO_TOKEN = "0"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    """``trim(x)``: strips blanks (0x20) only; tabs stay."""
    return F.trim(col_(c))


def upper_trimmed(c: Column | str) -> Column:
    """``trim(upper(x))`` - the default cleaning of codes and names."""
    return F.trim(F.upper(col_(c)))


def lower_trimmed(c: Column | str) -> Column:
    return F.lower(F.trim(col_(c)))


def title_case(c: Column | str) -> Column:
    """``initcap(trim(lower(x)))``: words split on blanks only."""
    return F.initcap(F.trim(F.lower(col_(c))))


def trimmed_title(c: Column | str) -> Column:
    """``trim(initcap(x))``."""
    return F.trim(F.initcap(col_(c)))


def empty_to_null(c: Column | str) -> Column:
    """``nullif(trim(x), '')``."""
    return F.nullif(F.trim(col_(c)), F.lit(EMPTY_TEXT))


def null_tokens(c: Column | str) -> Column:
    """``nullif(nullif(trim(x), 'NULL'), '')`` on a value cast to text first.

    Casting first keeps the comparison with the text token legal when the raw
    column turns out to be numeric (ANSI would reject the implicit cast).
    """
    text = col_(c).cast("string")
    return F.nullif(F.nullif(F.trim(text), F.lit(NULL_TEXT_TOKEN)), F.lit(EMPTY_TEXT))


def null_token(c: Column | str) -> Column:
    """``nullif(x, 'NULL')`` with the same string-first guard, no trimming."""
    return F.nullif(col_(c).cast("string"), F.lit(NULL_TEXT_TOKEN))


def zero_to_null(c: Column | str) -> Column:
    """Upper-cased, trimmed text, where a lone zero counts as missing."""
    return F.nullif(upper_trimmed(c), F.lit(ZERO_TOKEN))


def blank_normalised(c: Column | str, lower: bool = False) -> Column:
    """``nullif(trim(x), '')`` (optionally lowered) - used by distinct-value audits."""
    inner = F.trim(col_(c))
    if lower:
        inner = F.lower(inner)
    return F.nullif(inner, F.lit(EMPTY_TEXT))
