"""DataFrame -> DataFrame building blocks."""

from estrella.operators.calendar import date_dim, date_spine, date_spine_covering, with_date_attributes
from estrella.operators.filters import drop_blank_rows, exclude_values, non_blank_row, require_present
from estrella.operators.joins import (
    attach,
    bounded_broadcast,
    coverage,
    left_join_spread,
    no_key_coverage,
    orphan_count,
    orphans,
    reconcile,
)
from estrella.operators.quality import (
    Check,
    check_expression,
    check_not_null,
    check_relationship,
    check_unique,
    check_unique_combination,
    TableChecks,
    quality_report,
    suspect_checks,
    table_report,
)
from estrella.operators.reduce import (
    conflicting_keys,
    count_where,
    distinct_count_above,
    distinct_value_conflicts,
    find_duplicates,
    max_where,
    sum_where,
    survivor_max,
)

__all__ = [
    "conflicting_keys", "TableChecks", "suspect_checks", "table_report",
    "Check", "attach", "bounded_broadcast", "check_expression", "check_not_null",
    "check_relationship", "check_unique", "check_unique_combination", "count_where", "coverage",
    "date_dim", "date_spine", "date_spine_covering", "distinct_count_above",
    "distinct_value_conflicts", "drop_blank_rows", "exclude_values", "find_duplicates",
    "left_join_spread", "max_where", "no_key_coverage", "non_blank_row", "orphan_count", "orphans", "quality_report",
    "reconcile", "require_present", "sum_where", "survivor_max", "with_date_attributes",
]
