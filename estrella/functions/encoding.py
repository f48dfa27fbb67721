"""Repair of UTF-8 text that was decoded as ISO-8859-1 (mojibake)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estrella.functions.text import col_

# \A and \z: a plain $ would also match before a final line separator
_LATIN1_ONLY = r"\A[\x00-\xFF]*\z"


def damage_utf8_as_latin1(c: Column | str) -> Column:
    """Simulate the source bug: UTF-8 bytes read back as ISO-8859-1."""
    return F.decode(F.encode(col_(c), "UTF-8"), "ISO-8859-1")


def repair_mojibake(c: Column | str) -> Column:
    """The text that its Latin-1 bytes spell in UTF-8, where they spell one.

    Spark raises when the value has characters outside ISO-8859-1 or when its
    Latin-1 bytes are not valid UTF-8 (already-clean accented text). The guard
    repairs only values where the round trip is lossless and valid, and returns
    every other value unchanged - so clean, ASCII, non-Latin-1 and null inputs
    pass through and nothing fails at runtime.
    """
    x = col_(c)
    latin1_bytes = F.encode(F.when(x.rlike(_LATIN1_ONLY), x), "ISO-8859-1")
    return F.when(
        x.rlike(_LATIN1_ONLY) & F.is_valid_utf8(latin1_bytes.cast("string")),
        latin1_bytes.cast("string"),
    ).otherwise(x)
