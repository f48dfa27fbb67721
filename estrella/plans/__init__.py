"""Staged pipelines over the role-mapped test tables, one builder per query key.

Importing this package registers every query in ``registry.QUERIES`` /
``registry.ORACLE_SQL``.
"""

from estrella.plans import audits, basics, marts, registry, staging, warehouse  # noqa: F401  (registration)

QUERIES = registry.QUERIES
ORACLE_SQL = registry.ORACLE_SQL
