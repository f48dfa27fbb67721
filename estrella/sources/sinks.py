"""Sinks: views, fully refreshed tables, ephemeral frames, and layer routing.

Three materialisations, chosen per layer:

* view      - staging and warehouse models; recomputed on each read
  (``createOrReplaceTempView``);
* table     - marts and the calendar; replaced on each run by a new version, which
  readers see from one atomic step on (``sources.versions``, Parquet);
* ephemeral - intermediate models; just the lazy DataFrame, inlined by Catalyst.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from estrella.sources.versions import replace_table

# Targets that write every layer into the target's own schema.
SINGLE_SCHEMA_TARGETS = ("dev", "ci")

# Materialisation and schema of each layer.
LAYERS = {
    "staging": {"schema": "staging", "materialized": "view"},
    "warehouse": {"schema": "warehouse", "materialized": "view"},
    "int": {"schema": "warehouse", "materialized": "ephemeral"},
    "marts": {"schema": "marts", "materialized": "table"},
    "seeds": {"schema": "seeds", "materialized": "table"},
}


def schema_name(target_name: str, target_schema: str, custom_schema: str | None) -> str:
    """Schema a model is written to.

    ``dev`` and ``ci`` put everything in the target's schema; any other target
    uses the layer's custom schema (trimmed) when one is set, else the target's.
    """
    if target_name in SINGLE_SCHEMA_TARGETS:
        return target_schema
    if custom_schema is not None:
        return custom_schema.strip()
    return target_schema


def layer_location(root: str, layer: str, table: str, target_name: str, target_schema: str) -> str:
    """Storage path ``root/<schema>/<table>`` for a model of ``layer``."""
    custom = LAYERS.get(layer, {}).get("schema")
    return os.path.join(root, schema_name(target_name, target_schema, custom), table)


def publish(
    df: DataFrame,
    layer: str,
    table: str,
    root: str,
    target_name: str = "prod",
    target_schema: str = "default",
    partition_by: list[str] | None = None,
    materialized: str | None = None,
    replace: str = "all",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Materialise ``df`` as its layer says and return the frame readers should use.

    * table: write a new version at the routed location, publish it and return a
      reader of it (this also cuts the lineage, so executor loss later recomputes
      nothing upstream). A failed write leaves the version before, and ``df`` may
      read the table that it replaces; ``read_version`` reads it from elsewhere;
    * view: register a temp view named ``<schema>__<table>`` and return it;
    * ephemeral: return ``df`` itself.

    ``partition_by`` and ``replace="partitions"`` refresh only the partitions that ``df``
    has rows of. ``materialized`` overrides the layer's setting (e.g. write the warehouse layer
    as tables in a full build so every mart reads it instead of recomputing it). ``options``
    go to the writer of a table.
    """
    kind = materialized or LAYERS.get(layer, {}).get("materialized", "view")
    spark = df.sparkSession
    if kind == "table":
        path = layer_location(root, layer, table, target_name, target_schema)
        return replace_table(df, path, partition_by=partition_by or (), replace=replace, options=options)
    if kind == "view":
        schema = schema_name(target_name, target_schema, LAYERS.get(layer, {}).get("schema"))
        name = f"{schema}__{table}"
        df.createOrReplaceTempView(name)
        return spark.table(name)
    return df


def shared_scratch_root(spark: SparkSession, name: str) -> str:
    """A folder under the cluster's shared checkpoint directory for written tables."""
    from estrella.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)
