"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estrella.functions.text import col_

# Spark day-of-week numbering has 1 = Sunday and 7 = Saturday.
WEEKEND_DAYS = [1, 7]


def date_attributes(c: Column | str) -> dict[str, Column]:
    """The ten calendar columns of the date dimension, keyed by output name."""
    d = col_(c)
    return {
        "date_day": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": F.dayofweek(d),
        "day_name": F.date_format(d, "EEEE"),
        "week_of_year": F.weekofyear(d),
        "is_weekend": F.coalesce(F.dayofweek(d).isin(WEEKEND_DAYS), F.lit(False)),
    }


def datediff_days(end: Column | str, start: Column | str) -> Column:
    """Signed ``datediff(end, start)`` in days; null when either date is null."""
    return F.datediff(col_(end), col_(start))
