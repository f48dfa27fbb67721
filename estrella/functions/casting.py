"""Safe casts: malformed text becomes null instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estrella.functions.text import col_, null_tokens

# The one spelled-out age the source writes in words.
AGE_WORDS = {"CUARENTA Y DOS": 42}


def safe_date(c: Column | str) -> Column:
    """A date where the text is one, else null; outer blanks and timestamp text are accepted."""
    return col_(c).try_cast("date")


def safe_date_from_text(c: Column | str) -> Column:
    """A date from trimmed text; the null token, empty text and bad dates are null."""
    return null_tokens(c).try_cast("date")


def safe_int_with_words(c: Column | str) -> Column:
    """An integer from trimmed text, by ``AGE_WORDS`` where it is written in words; null if it is neither."""
    text = F.trim(col_(c).cast("string"))
    expr = None
    for words, value in AGE_WORDS.items():
        cond = text == F.lit(words)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(text.try_cast("int"))


def safe_decimal(c: Column | str, precision: int = 10, scale: int = 2) -> Column:
    """A decimal of the given size: rounded half up; overflow and bad text are null."""
    return col_(c).try_cast(f"decimal({precision},{scale})")


def money(c: Column | str) -> Column:
    """Money columns are carried as decimal(18,2) so sums are exact and order-free."""
    return col_(c).cast("decimal(18,2)")
