"""Column -> Column helpers built only from ``pyspark.sql.functions``."""

from estrella.functions.casting import (
    money,
    safe_date,
    safe_date_from_text,
    safe_decimal,
    safe_int_with_words,
)
from estrella.functions.dates import date_attributes, datediff_days
from estrella.functions.encoding import damage_utf8_as_latin1, repair_mojibake
from estrella.functions.keys import (
    all_present,
    fallback_key,
    full_name,
    guarded_key,
    natural_key,
    surrogate_key,
    surrogate_text,
)
from estrella.functions.labels import normalize_plan
from estrella.functions.ratios import percent_half_up
from estrella.functions.text import (
    blank_normalised,
    empty_to_null,
    lower_trimmed,
    null_token,
    null_tokens,
    title_case,
    trimmed,
    trimmed_title,
    upper_trimmed,
    zero_to_null,
)

__all__ = [
    "all_present", "blank_normalised", "datediff_days", "damage_utf8_as_latin1", "date_attributes",
    "empty_to_null", "fallback_key", "full_name", "guarded_key", "lower_trimmed", "money",
    "natural_key", "normalize_plan", "null_token", "null_tokens", "percent_half_up",
    "repair_mojibake", "safe_date", "safe_date_from_text", "safe_decimal",
    "safe_int_with_words", "surrogate_key", "surrogate_text", "title_case", "trimmed",
    "trimmed_title", "upper_trimmed", "zero_to_null",
]
