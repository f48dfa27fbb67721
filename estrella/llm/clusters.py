"""Centroid clustering over subvector dictionaries.

Components become integers, and the dimensions are taken in blocks. Vectors are held in
chunks: in a chunk every block has a dictionary of its distinct subvectors, without loss,
and every vector is a row of codes. A round finds the exact squared distance of each
dictionary entry to each centroid's part once, and a vector's distance to a centroid is
the sum of its codes' entries. New centroids come from counts of codes in the same way.
Chunks are written once and read in each round; only sums and centroids leave a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrella.llm.common import map_batches, materialize

BLOCK_DIMS = 2  # dimensions of a block
CHUNK = 8192  # vectors of a chunk
MOST = 1 << 27  # largest magnitude of a component for which all sums fit 64 bits
CHUNK_SCHEMA = "ids array<bigint>, sizes array<int>, subvectors binary, codes binary"


def quantised(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """vec_id and q, the integers floor(scale * x), of the vectors of ``dims`` finite components."""

    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    usable = (F.size("embedding") == dims) & F.forall("embedding", finite)
    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").where(usable).select(
        "vec_id", whole.alias("q")
    )


def encode_chunk(values: np.ndarray, block_dims: int = BLOCK_DIMS) -> tuple[list[np.ndarray], np.ndarray]:
    """(dictionary of each block, codes of shape blocks x vectors) of integer vectors."""
    subs, codes = [], []
    for lo in range(0, values.shape[1], block_dims):
        part = np.ascontiguousarray(values[:, lo : lo + block_dims])
        seen, at = np.unique(part, axis=0, return_inverse=True)
        subs.append(seen)
        codes.append(at.reshape(-1))
    return subs, np.array(codes, np.uint16).reshape(len(subs), len(values))


def distances(subs: list[np.ndarray], codes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance (vectors x centroids, int64) as sums of dictionary entries' distances."""
    total = np.zeros((codes.shape[1], len(centroids)), np.int64)
    lo = 0
    for sub, code in zip(subs, codes):
        gap = sub[:, None, :] - centroids[None, :, lo : lo + sub.shape[1]]
        total += (gap * gap).sum(axis=2)[code]
        lo += sub.shape[1]
    return total


def cluster_sums(subs: list[np.ndarray], codes: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """Componentwise sums (clusters x dimensions) from how often a cluster has each code."""
    out = []
    for sub, code in zip(subs, codes):
        times = np.bincount(cluster * len(sub) + code, minlength=k * len(sub)).reshape(k, len(sub))
        out.append(times @ sub)
    return np.concatenate(out, axis=1)


def encode(kept: DataFrame, dims: int, block_dims: int = BLOCK_DIMS, chunk: int = CHUNK) -> DataFrame:
    """Chunks (``CHUNK_SCHEMA``) of ``kept(vec_id, q)``: no chunk leaves its task."""

    def pack(ids: list, values: list) -> pa.RecordBatch:
        q = np.concatenate(values)
        if q.size and max(int(q.max()), -int(q.min())) > MOST:
            raise ArithmeticError(f"a component beyond {MOST} has no distance in 64 bits")
        subs, codes = encode_chunk(q, block_dims)
        flat = pa.concat_arrays(ids)
        return pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat),
                pa.array([[len(s) for s in subs]], pa.list_(pa.int32())),
                pa.array([np.concatenate([s.ravel() for s in subs]).astype("<i4").tobytes()], pa.binary()),
                pa.array([codes.astype("<u2").tobytes()], pa.binary()),
            ],
            ["ids", "sizes", "subvectors", "codes"],
        )

    def run(batches):
        ids, values, n = [], [], 0
        for batch in batches:
            q = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)
            lo = 0
            while lo < batch.num_rows:
                hi = min(batch.num_rows, lo + chunk - n)
                ids.append(batch.column(0).slice(lo, hi - lo))
                values.append(q[lo:hi])
                n, lo = n + hi - lo, hi
                if n == chunk:
                    yield pack(ids, values)
                    ids, values, n = [], [], 0
        if n:
            yield pack(ids, values)

    return kept.transform(map_batches, run, CHUNK_SCHEMA)


def _chunks(batch: pa.RecordBatch, dims: int, block_dims: int) -> Iterator[tuple[pa.Array, list[np.ndarray], np.ndarray]]:
    """(vec_ids, dictionaries, codes) of each chunk in a batch."""
    for i in range(batch.num_rows):
        ids = batch.column(0).slice(i, 1).flatten()
        sizes = batch.column(1)[i].as_py()
        flat = np.frombuffer(batch.column(2)[i].as_buffer(), "<i4").astype(np.int64)
        subs, at = [], 0
        for b, size in enumerate(sizes):
            width = min(block_dims, dims - b * block_dims)
            subs.append(flat[at : at + size * width].reshape(size, width))
            at += size * width
        yield ids, subs, np.frombuffer(batch.column(3)[i].as_buffer(), "<u2").reshape(len(sizes), len(ids))


def assign(chunks: DataFrame, centroids: np.ndarray, block_dims: int = BLOCK_DIMS) -> DataFrame:
    """vec_id, cluster (the nearest centroid, the smaller number among equals) and distance."""
    dims = centroids.shape[1]

    def run(batches):
        for batch in batches:
            for ids, subs, codes in _chunks(batch, dims, block_dims):
                d = distances(subs, codes, centroids)
                cluster = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(cluster.astype(np.int32)), pa.array(d[np.arange(len(d)), cluster])],
                    ["vec_id", "cluster", "distance"],
                )

    return chunks.transform(map_batches, run, "vec_id bigint, cluster int, distance bigint")


def moved_centroids(chunks: DataFrame, centroids: np.ndarray, block_dims: int = BLOCK_DIMS) -> np.ndarray:
    """The exact floor of every non-empty cluster's mean; an empty cluster's centroid stays.

    A task sends one row of sums for each cluster; the driver gets clusters x dimensions numbers.
    """
    k, dims = centroids.shape

    def run(batches):
        for batch in batches:
            count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
            for _, subs, codes in _chunks(batch, dims, block_dims):
                cluster = distances(subs, codes, centroids).argmin(axis=1)
                count += np.bincount(cluster, minlength=k)
                total += cluster_sums(subs, codes, cluster, k)
            some = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(some.astype(np.int32)),
                    pa.array(count[some]),
                    pa.array(total[some].tolist(), pa.list_(pa.int64())),
                ],
                ["cluster", "n", "sums"],
            )

    wide = "decimal(38,0)"
    sums = (
        chunks.transform(map_batches, run, "cluster int, n bigint, sums array<bigint>")
        .select("cluster", "n", F.posexplode("sums").alias("dim", "s"))
        .groupBy("cluster", "dim")
        .agg(F.sum(F.col("n").cast(wide)).alias("n"), F.sum(F.col("s").cast(wide)).alias("s"))
    )
    out = centroids.copy()
    for r in sums.collect():
        out[r["cluster"], r["dim"]] = int(r["s"]) // int(r["n"])
    return out


def first_centroids(kept: DataFrame, k: int, seed: int, dims: int) -> np.ndarray:
    """The ``k`` vectors of smallest sha256 of ``seed:vec_id``, in that order (fewer if there are fewer)."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.orderBy(name, "q").limit(k).collect()
    return np.array([r["q"] for r in rows], np.int64).reshape(len(rows), dims)


def cluster_vectors(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: int = 64,
    seed: int = 1,
    block_dims: int = BLOCK_DIMS,
    chunk: int = CHUNK,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept row of
    ``vectors(vec_id, embedding)``, after ``rounds`` rounds and a last assignment.

    Kept are vectors of exactly ``dims`` components, none null or non-finite; the others
    give no row. With fewer than ``k`` kept vectors each is a centroid. Ties go to the smaller
    number. A null vec_id takes part (its hash is that of an empty id); repeated rows count
    as rows; no kept vectors give no rows; other columns are not read. A component whose
    integer is beyond 2**27 is an error, as distances are 64-bit integers.
    """
    spark = vectors.sparkSession
    kept = quantised(vectors, dims, scale)
    chunks = materialize(encode(kept, dims, block_dims, chunk), "chunks")
    centroids = first_centroids(kept, k, seed, dims)
    if not len(centroids):
        return spark.createDataFrame(
            [], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        )
    for _ in range(rounds):
        centroids = moved_centroids(chunks, centroids, block_dims)
    placed = materialize(assign(chunks, centroids, block_dims), "assigned")
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    of_cluster = {r["cluster"]: int(r["s"]) for r in sums}
    total = sum(of_cluster.values())
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    info = spark.createDataFrame(
        [(c, s, total, names[c]) for c, s in of_cluster.items()],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return placed.join(F.broadcast(info), "cluster").select(  # at most k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _sql(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64) -> str:
    """The same rule in DuckDB SQL: every component against every centroid's, round by round."""
    steps = []
    for r in range(1, rounds + 2):
        steps.append(
            f"""a{r} as (
  select vec_id, k, s from (
    select vec_id, k, s, row_number() over (partition by vec_id order by s, k) nth
    from (select vec_id, k, sum((x - c) * (x - c)) s from v join c{r - 1} using (d) group by vec_id, k))
  where nth = 1)"""
        )
        if r <= rounds:
            steps.append(
                f"""c{r} as (
  select o.k, o.d, coalesce(m.c, o.c) c from c{r - 1} o left join (
    select k, d, ((t - ((t % n) + n) % n) // n)::bigint c
    from (select k, d, sum(x) t, count(*) n from a{r} join v using (vec_id) group by k, d)) m using (k, d))"""
            )
    last = rounds + 1
    return f"""
with kept as (
  select vec_id, embedding from embeddings
  where len(embedding) = {dims} and list_count(embedding) = {dims}
    and len([x for x in embedding if isfinite(x)]) = {dims}),
v as (
  select vec_id, unnest(range({dims})) d, unnest([floor({scale} * x::double)::bigint for x in embedding]) x from kept),
s as (select vec_id, row_number() over (order by sha256('1:' || vec_id)) - 1 k from kept),
c0 as (select k, d, x c from s join v using (vec_id) where k < {k}),
{', '.join(steps)},
name as (select k, sha256(string_agg(c::varchar, ',' order by d)) h from c{rounds} group by k),
part as (select k, sum(s) s from a{last} group by k)
select vec_id, k::int "cluster", a.s::bigint distance, part.s::bigint cluster_inertia,
  (select sum(s) from a{last})::bigint inertia, h centroid_sha256
from a{last} a join part using (k) join name using (k)
"""


SQL = _sql()
