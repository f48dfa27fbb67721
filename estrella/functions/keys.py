"""Surrogate, guarded, fallback and natural keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estrella.functions.text import col_

# The surrogate-key convention shared with the reference warehouse
# (md5 over the parts cast to text, nulls replaced by this token, joined by '-').
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"
FULL_NAME_SEPARATOR = " "
NATURAL_KEY_SEPARATOR = "|"


def surrogate_key(*cols: Column | str) -> Column:
    """md5 of the parts as text; a null part becomes a token, so the key is never null.

    Because nulls hash to a token, two rows whose parts are all null get the same
    key and therefore match in key joins (null = null), unlike plain equi-joins.
    Only hash ints, strings, dates and decimals: double-to-text differs between
    engines.
    """
    return F.md5(surrogate_text(*cols))


def surrogate_text(*cols: Column | str) -> Column:
    """The text that ``surrogate_key`` hashes. Texts are equal where the keys are, and take less
    room than their hash where rows are dealt by a key that is not kept."""
    parts = [F.coalesce(col_(c).cast("string"), F.lit(SURROGATE_NULL_TOKEN)) for c in cols]
    return parts[0] if len(parts) == 1 else F.concat_ws(SURROGATE_SEPARATOR, *parts)


def guarded_key(condition: Column, *cols: Column | str) -> Column:
    """Surrogate key only where ``condition`` holds (typically: parts present), else null."""
    return F.when(condition, surrogate_key(*cols))


def all_present(*cols: Column | str) -> Column:
    cond = None
    for c in cols:
        term = col_(c).isNotNull()
        cond = term if cond is None else (cond & term)
    return cond


def fallback_key(primary: Column | str, *fallback: Column | str) -> Column:
    """Key of ``primary`` when it is non-null and non-empty, else of the fallback parts."""
    p = col_(primary)
    return (
        F.when(p.isNotNull() & (p != F.lit("")), surrogate_key(p))
        .otherwise(surrogate_key(*fallback))
    )


def full_name(*parts: Column | str) -> Column:
    """``concat_ws(' ', ...)``: skips nulls, keeps empty strings, never null."""
    return F.concat_ws(FULL_NAME_SEPARATOR, *[col_(p) for p in parts])


def _present(c: Column) -> Column:
    return c.isNotNull() & (c != F.lit(""))


def natural_key(
    curp: Column | str,
    rfc: Column | str,
    email: Column | str,
    name_parts: list[Column | str],
) -> Column:
    """Party identity cascade: curp -> rfc -> lower(email) -> name parts and phone.

    Each id is skipped when null or empty; the last step joins the name parts with
    a bar and is never null (all-null parts give ``''``).
    """
    curp_c, rfc_c, email_c = col_(curp), col_(rfc), col_(email)
    return (
        F.when(_present(curp_c), curp_c)
        .when(_present(rfc_c), rfc_c)
        .when(_present(email_c), F.lower(email_c))
        .otherwise(F.concat_ws(NATURAL_KEY_SEPARATOR, *[col_(p) for p in name_parts]))
    )
