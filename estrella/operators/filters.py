"""Row filters with SQL three-valued-logic semantics made explicit."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrella.functions.text import col_


def require_present(df: DataFrame, *cols: str) -> DataFrame:
    """Keep rows where every column is non-null (pushed to the scan as IsNotNull)."""
    cond = None
    for c in cols:
        term = F.col(c).isNotNull()
        cond = term if cond is None else (cond & term)
    return df.where(cond)


def non_blank_row(cols: Iterable[Column | str]) -> Column:
    """``concat_ws('', c1, ..., cn) != ''``: false only when every column is null or empty."""
    return F.concat_ws("", *[col_(c).cast("string") for c in cols]) != F.lit("")


def drop_blank_rows(df: DataFrame, cols: Iterable[Column | str] | None = None) -> DataFrame:
    """Drop rows whose every column is null or empty text."""
    return df.where(non_blank_row(cols if cols is not None else df.columns))


def exclude_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """``column NOT IN (values)``: rows where ``column`` is null are dropped too."""
    return df.where(~F.col(column).isin(values))
