"""Embedding near-dedup by Euclidean p-stable hashing.

Normalised vectors are projected on Gaussian directions; each table's key joins several
projections quantised to a width. Vectors that share a key in any table are compared by
exact cosine in double precision, as blocks of matrix products; a pair that meets in
several tables counts in the first one only, so links are counted without writing pairs.

The projections per table follow the number of vectors, so that a bucket holds about
``ROOM`` unrelated ones at any size, and the tables follow from the wanted recall: at width 2
one projection agrees with probability 0.82 at cosine 0.9 and 0.49 for unrelated vectors, so
candidate pairs grow with the power 1.27 of the vectors. 8 projections and 32 tables serve
up to 1,300 vectors, 12 and 75 serve 20,000; a pair at the threshold is missed with
probability 0.0006, one at cosine 0.95 with less than 0.000002.

What travels to the buckets first is a vector in one byte a component with its rounding
error. The error bounds the cosine from above, so only vectors that can have a link in a
bucket go there whole, and none with a link is left out.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrella.llm import textbytes as tb
from estrella.llm.common import (
    binary_rows,
    block_pairs,
    by_group,
    by_runs,
    connected_components,
    map_batches,
    materialize,
    small,
    spread,
)

TABLES, HASHES, WIDTH, SEED = 32, 8, 2.0, 11  # tables and projections of a small set
ROOM = 4  # unrelated vectors expected in a bucket
MISS = 0.0006  # share of pairs at the threshold that meet in no table
BLOCK = 1024  # vectors of a hot bucket compared in one task
FEW = 32  # members of a bucket that is compared together with others


def agreement(distance: float, width: float) -> float:
    """Probability that one quantised projection is equal for two points so far apart."""
    if distance <= 0:
        return 1.0
    t = width / distance
    outside = math.erfc(t / math.sqrt(2))
    return 1 - outside - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def table_plan(vectors: int, threshold: float, width: float = WIDTH) -> tuple[int, int]:
    """(tables, projections a table) for so many vectors, as the module's text says."""
    far = agreement(math.sqrt(2), width)
    near = agreement(math.sqrt(max(0.0, 2 - 2 * threshold)), width)
    hashes = max(HASHES, math.ceil(math.log(max(1, vectors) / ROOM) / -math.log(far)))
    met = near**hashes
    return (1 if met >= 1 else math.ceil(math.log(MISS) / math.log1p(-met))), hashes


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision, whatever their magnitude."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def bucket_keys(x: np.ndarray, tables: int, hashes: int, width: float, seed: int) -> np.ndarray:
    """Keys (rows x tables, int32) of unit vectors."""
    rng = np.random.Generator(np.random.PCG64([seed, x.shape[1]]))
    direction = rng.standard_normal((x.shape[1], tables * hashes))
    shift = rng.uniform(0, width, tables * hashes)
    cell = np.floor((x @ direction + shift) / width).astype(np.int64).reshape(len(x), tables, hashes)
    key = np.zeros((len(x), tables), np.uint64)
    for h in range(hashes):
        key = tb.mix(key + cell[:, :, h].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return (key >> np.uint64(32)).astype(np.uint32).view(np.int32)


def coarse(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cells, step, error) of unit vectors: int8 cells whose multiples of ``step`` lie within
    ``error`` (a length) of the vector."""
    step = np.abs(x).max(axis=1) / 127
    cells = np.rint(x / step[:, None]).astype(np.int8)
    lost = x - cells * step[:, None]
    return cells, step, np.sqrt((lost * lost).sum(axis=1)) + 1e-12


def most_cosine(cells: np.ndarray, step: np.ndarray, error: np.ndarray) -> np.ndarray:
    """Upper bounds of all cosines between the vectors behind ``coarse`` rows."""
    x = cells * step[:, None]
    return x @ x.T + error[:, None] + error[None, :] + error[:, None] * error[None, :] + 1e-9


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, dim, cls (hash of the values), vec (values as doubles); the last three are
    null for a vector that is null, empty, zero, or holds a null or non-finite component."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            dim, cls, vec = [], [], []
            valid = np.asarray(lists.is_valid())
            at = lists.offsets.to_numpy()
            values = lists.values
            holes = np.concatenate([[0], np.cumsum(np.asarray(values.is_null()))])
            flat = values.fill_null(0).to_numpy(zero_copy_only=False).astype("<f8") + 0.0
            for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                x = flat[a:b]
                if valid[i] and holes[b] == holes[a] and x.any() and np.isfinite(x).all():
                    raw = x.tobytes()
                    dim.append(b - a)
                    cls.append(hashlib.blake2b(raw, digest_size=16).digest())
                    vec.append(raw)
                else:
                    dim.append(None)
                    cls.append(None)
                    vec.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(dim, pa.int32()), pa.array(cls, pa.binary()), pa.array(vec, pa.binary())],
                ["vec_id", "dim", "cls", "vec"],
            )

    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").transform(
        map_batches, run, "vec_id bigint, dim int, cls binary, vec binary"
    )


def _keyed(classes: DataFrame, tables: int, hashes: int, width: float, seed: int) -> DataFrame:
    """The classes with their key in every table and their vector's coarse form."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            dims = batch.column(2).to_numpy()
            keys = np.zeros((n, tables), np.int32)
            cells, step, error = [b""] * n, np.zeros(n), np.zeros(n)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = unit(binary_rows(batch.column(3).take(pa.array(at)), "<f8"))
                keys[at] = bucket_keys(x, tables, hashes, width, seed)
                c, step[at], error[at] = coarse(x)
                for i, row in zip(at.tolist(), c):
                    cells[i] = row.tobytes()
            listed = pa.ListArray.from_arrays(
                pa.array(np.arange(n + 1, dtype=np.int32) * tables), pa.array(keys.ravel())
            )
            new = [listed, pa.array(cells, pa.binary()), pa.array(step), pa.array(error)]
            names = [*batch.schema.names, "keys", "cells", "step", "error"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names)

    return classes.select("cls", "copies", "dim", "vec").transform(
        map_batches,
        run,
        "cls binary, copies bigint, dim int, vec binary, keys array<int>, cells binary, step double, error double",
    )


BUCKET = ["dim", "tab", "bucket", "bi", "bj"]


def _across(pairs: np.ndarray, key: tuple, rows: pa.Table) -> np.ndarray:
    """``pairs`` without the diagonal and, where two blocks of a bucket meet, within a block."""
    np.fill_diagonal(pairs, False)
    if key[3] != key[4]:
        block = rows["block"].to_numpy()
        pairs &= block[:, None] != block[None, :]
    return pairs


def may_link(rows: pa.Table, starts: np.ndarray, threshold: float) -> np.ndarray:
    """Which ``rows`` may have a cosine >= ``threshold`` with another row of their group; groups
    lie between ``starts``. Small groups are compared row by row further on, all at once, large
    ones as matrices."""
    found = np.zeros(rows.num_rows, bool)
    size = np.diff(starts)
    dims = rows["dim"].to_numpy()
    step, error, block = (rows[c].to_numpy() for c in ("step", "error", "block"))
    apart = rows["bi"].to_numpy() != rows["bj"].to_numpy()
    left = np.repeat(starts[1:], size) - np.arange(rows.num_rows) - 1  # rows of the group that follow
    few = np.repeat((size > 1) & (size <= FEW), size)
    for d in np.unique(dims[few]):
        at = np.flatnonzero(few & (dims == d))  # whole groups, in order
        x = binary_rows(rows["cells"].take(pa.array(at)), np.int8) * step[at][:, None]
        e, l, b, off = error[at], left[at], block[at], apart[at]
        for o in range(1, int(l.max()) + 1):
            i = np.flatnonzero(l >= o)
            i = i[~off[i] | (b[i] != b[i + o])]
            j = i + o
            bound = np.einsum("ij,ij->i", x[i], x[j]) + e[i] + e[j] + e[i] * e[j] + 1e-9
            hit = bound >= threshold
            found[at[i[hit]]] = found[at[j[hit]]] = True
    for g in np.flatnonzero(size > FEW):
        a, z = int(starts[g]), int(starts[g + 1])
        some = rows.slice(a, z - a)
        bound = most_cosine(binary_rows(some["cells"], np.int8), step[a:z], error[a:z])
        key = tuple(some[k][0].as_py() for k in BUCKET)
        found[a:z] = _across(bound >= threshold, key, some).any(axis=1)
    return found


def _met(keyed: DataFrame) -> DataFrame:
    """Buckets' members in coarse form; a bucket of more than BLOCK is dealt into blocks."""
    met = keyed.select("dim", "cls", "cells", "step", "error", F.posexplode("keys").alias("tab", "bucket"))
    sizes = met.groupBy("dim", "tab", "bucket").agg(F.count("*").alias("size"))
    hot = small(materialize(sizes.where(F.col("size") > BLOCK), "hotbuckets"))
    blocks = F.ceil(F.coalesce("size", F.lit(1)) / float(BLOCK)).cast("int")
    return (
        met.join(hot, ["dim", "tab", "bucket"], "left")
        .withColumn("block", F.pmod(F.xxhash64("cls"), blocks).cast("int"))
        .withColumn("p", F.explode(block_pairs(F.coalesce("size", F.lit(1)), F.col("block"), BLOCK)))
        .select("dim", "tab", "bucket", "p.bi", "p.bj", "block", "cls", "cells", "step", "error")
    )


def _bucket_links(keyed: DataFrame, threshold: float) -> DataFrame:
    """(cls, links, root): per table, links not seen in an earlier table, with a class of
    the bucket that stands for all it reaches there."""

    def likely(rows: pa.Table, starts: np.ndarray) -> pa.Table | None:
        some = np.flatnonzero(may_link(rows, starts, threshold))
        return rows.select([*BUCKET, "block", "cls"]).take(pa.array(some)) if some.size else None

    def link(key: tuple, rows: pa.Table) -> pa.Table | None:
        n = rows.num_rows
        if n < 2:
            return None
        x = unit(binary_rows(rows["vec"], "<f8"))
        keys = rows["keys"].combine_chunks().flatten().to_numpy().reshape(n, -1)
        copies = rows["copies"].to_numpy()
        new = _across((x @ x.T) >= threshold, key, rows)
        for t in range(key[1]):
            if not new.any():
                return None
            new &= keys[:, t][:, None] != keys[:, t][None, :]
        some = np.flatnonzero(new.any(axis=1))
        if not some.size:
            return None
        label = spread(new, lambda at, rest: new[at, rest])
        ids = rows["cls"].to_pylist()
        return pa.table(
            {
                "cls": pa.array([ids[i] for i in some], pa.binary()),
                "links": pa.array(new[some] @ copies, pa.int64()),
                "root": pa.array([ids[label[i]] for i in some], pa.binary()),
            }
        )

    place = "dim int, tab int, bucket int, bi int, bj int, block int, cls binary"
    near = by_runs(_met(keyed), BUCKET, likely, place)
    whole = near.join(keyed.select("cls", "copies", "vec", "keys"), "cls").select(
        *BUCKET, "block", "cls", "copies", "vec", "keys"
    )
    return by_group(whole, BUCKET, link, "cls binary, links bigint, root binary")


def embedding_duplicates(
    vectors: DataFrame,
    threshold: float = 0.9,
    tables: int | None = None,
    hashes: int | None = None,
    width: float = WIDTH,
    seed: int = SEED,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors(vec_id, embedding)``.

    Links join vectors of one dimension with cosine >= ``threshold``. n_links counts the
    other rows linked directly, equal vectors among them. A vector that is null, empty,
    zero or holds a null or non-finite component links with nothing (its component is its
    own vec_id). Repeated rows count as rows. A null vec_id takes part but is never the
    smallest. No rows give no rows; other columns are ignored. ``tables`` and ``hashes``
    (projections a table) follow from the number of different vectors unless both are given.
    """
    rows = materialize(usable(vectors), "vectors")
    classes = (
        rows.where("cls is not null")
        .groupBy("cls")
        .agg(
            F.min("vec_id").alias("vec_id"),
            F.count("*").alias("copies"),
            F.first("dim").alias("dim"),
            F.first("vec").alias("vec"),
        )
    )
    classes = materialize(classes, "vecclasses")
    if tables is None or hashes is None:
        tables, hashes = table_plan(classes.count(), threshold, width)
    keyed = materialize(_keyed(classes, tables, hashes, width, seed), "veckeys")
    found = materialize(_bucket_links(keyed, threshold), "veclinks")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")), "vecparts")
    of_class = (
        classes.select("cls", "vec_id", "copies")
        .join(links, "cls", "left")
        .join(parts.select(F.col("node").alias("cls"), "component"), "cls", "left")
        .select(
            "cls",
            "vec_id",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "cls").alias("component"),
        )
    )
    of_class = materialize(of_class, "vecinfo")
    smallest = of_class.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    labels = of_class.join(smallest, "component").select("cls", "n_links", "component_id")
    out = rows.select("vec_id", "cls").join(labels, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


# The same rule in DuckDB SQL, by comparing all pairs.
SQL = """
with recursive v as (
  select vec_id, embedding::double[] e from embeddings
  where embedding is not null and list_count(embedding) = len(embedding)
    and len([x for x in embedding if isfinite(x)]) = len(embedding)
    and len([x for x in embedding if x <> 0]) > 0),
l as (select a.vec_id a, b.vec_id b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
      where list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) as (select a, b from l union select r.a, l.b from reach r join l on r.b = l.a),
part as (select a, min(b) b from reach group by 1),
links as (select a, count(*) n from l group by 1)
select vec_id, coalesce(n, 0)::bigint n_links, least(vec_id, coalesce(b, vec_id)) component_id,
  vec_id = least(vec_id, coalesce(b, vec_id)) kept
from embeddings left join part on part.a = vec_id left join links on links.a = vec_id
"""
