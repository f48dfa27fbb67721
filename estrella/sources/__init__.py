"""Readers (explicit schemas) and sinks (view / table / ephemeral, layer routing)."""

from estrella.sources.lookup import read_seed_csv
from estrella.sources.ordered import read_ordered, rows_between, write_ordered
from estrella.sources.sinks import LAYERS, layer_location, publish, schema_name, shared_scratch_root
from estrella.sources.tables import SCHEMAS, Tables, read_table
from estrella.sources.versions import commit, read_version, replace_table, stage, vacuum

__all__ = [
    "LAYERS", "SCHEMAS", "Tables", "commit", "layer_location", "publish", "read_ordered", "read_seed_csv",
    "read_table", "read_version", "replace_table", "rows_between", "schema_name", "shared_scratch_root",
    "stage", "vacuum", "write_ordered",
]
