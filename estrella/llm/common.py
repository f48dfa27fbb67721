"""Helpers shared by the operators: durable tables, size-checked broadcasts,
connected components, and streaming access to sorted groups inside a task."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest side, in rows and in estimated bytes, that the operators broadcast on purpose. Sides
# are counted on a written table first; anything larger is joined through a shuffle.
BROADCAST_ROWS = 400_000
BROADCAST_BYTES = 64 << 20

# Largest batch handed to Python, in rows and in bytes (a longer row is a batch by itself).
# Each is set only where the session has Spark's default.
BATCH_LIMITS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1024"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4194304b"),
}


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only where that is unset and the master is local (tests on one machine) a scratch
    folder is made and remembered in the session; on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.estrella.llm.scratch", None
    )
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="estrella-llm-")
        spark.conf.set("spark.estrella.llm.scratch", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call uses."""
    return f"{shared_dir(spark)}/estrella-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs a read, never a recomputation of
    what came before, and values that depend on float order stay as they were.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Tasks import it, and an executor need not share the driver's folders or its
    PYTHONPATH. A package that came in an archive itself is with the executors already.
    """
    context = spark.sparkContext
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if getattr(context, "_estrella_shipped", False) or not os.path.isdir(package):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="estrella-code-"), "estrella.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._estrella_shipped = True


def map_batches(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``df.mapInArrow(fn, schema)``, with this package on the executors.

    Rows hold whole texts, so Spark's defaults of 10,000 rows and 64 MB a batch are lowered
    for the session (``BATCH_LIMITS``): a batch lies in memory several times, in the JVM, on
    its way and in Python.
    """
    spark = df.sparkSession
    ship_code(spark)
    for name, (default, ours) in BATCH_LIMITS.items():
        if spark.conf.get(name) == default:
            spark.conf.set(name, ours)
    return df.mapInArrow(fn, schema)


def scan_bytes(df: DataFrame) -> int:
    """Spark's estimate of the bytes of ``df``: for a written table that of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the written table ``df`` has at most BROADCAST_ROWS rows and BROADCAST_BYTES."""
    return scan_bytes(df) <= BROADCAST_BYTES and df.count() <= BROADCAST_ROWS


def small(df: DataFrame) -> DataFrame:
    """The written table ``df`` with a broadcast hint if that is small enough, else as it is."""
    return F.broadcast(df) if fits_broadcast(df) else df


def text_key(text: str = "text") -> list[Column]:
    """_ta, _tb: 128 bits of a text; a null text has a key of its own."""
    return [F.xxhash64(text).alias("_ta"), F.xxhash64(F.lit(1), F.col(text)).alias("_tb")]


def packed(df: DataFrame, *keys: Column) -> DataFrame:
    """All columns of ``df`` as one struct ``row``, and ``keys`` beside it: names that a
    caller's frame happens to have cannot meet those of an operator. ``row.*`` unpacks."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *keys)


def join_keys(df: DataFrame, keys: DataFrame, names: list[str], how: str) -> DataFrame:
    """``df`` semi- or anti-joined with the written table ``keys`` on ``names``; a null meets a null.

    ``df`` has columns of the operator only (see ``packed``).
    """
    other = small(keys.select(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(names)]))
    same = [F.col(c).eqNullSafe(F.col(f"_key{i}")) for i, c in enumerate(names)]
    return df.join(other, same, how)


def _order(df: DataFrame) -> Column:
    """What rows of ``packed`` are ordered by: their values, types without an order as JSON."""
    fields = df.schema["row"].dataType.fields
    value = lambda f: F.col("row").getField(f.name)
    plain = [f for f in fields if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    parts = [value(f) if f in plain else F.to_json(F.struct(value(f).alias("v"))) for f in fields]
    return F.struct(*[p.alias(f"c{i}") for i, p in enumerate(parts)])


def one_of_each(df: DataFrame, names: list[str], repeated: DataFrame) -> DataFrame:
    """``df(row, *names)`` with one row (the smallest) of each key in ``repeated``, a written
    table of the keys that several rows have. Only those rows are moved, one of each key and task."""
    folded = (
        join_keys(df, repeated, names, "left_semi")
        .groupBy(*names)
        .agg(F.min_by("row", _order(df)).alias("row"))
        .select("row", *names)
    )
    return join_keys(df, repeated, names, "left_anti").select("row", *names).unionByName(folded)


def connected_components(edges: DataFrame, name: str = "links") -> DataFrame:
    """(node, component): the smallest node reachable, for every node in ``edges(a, b)``.

    Alternates large-star and small-star steps until nothing changes; every step is
    two aggregations and two joins over the edges, nothing is gathered in one place.
    Edges with a null end or a = b are ignored; ties and repeated edges do no harm.
    """
    ends = [F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")]
    now = materialize(edges.where("a <> b").select(*ends).distinct(), name)
    state = _fingerprint(now)
    while state[0]:
        # large star: neighbours above u move to the smallest neighbour of u
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        moved = (
            now.select(F.col("v").alias("u"), F.col("u").alias("w"))
            .join(least, "u")
            .select(F.col("w").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        # small star: neighbours below u move to the smallest of them
        lower = moved.groupBy("u").agg(F.min("v").alias("m"))
        joined = moved.join(lower, "u")
        moved = (
            joined.select(
                F.explode(
                    F.array(
                        F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                        F.struct(F.col("u"), F.col("m").alias("v")),
                    )
                ).alias("e")
            )
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        now = materialize(moved, name)
        before, state = state, _fingerprint(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        now.select("v", "v").distinct()
    )


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def block_pairs(n: Column, block: Column, rows_per_block: int) -> Column:
    """Pairs (i, j), i <= j, of blocks that a member of ``block`` meets in, when a group
    of ``n`` rows is dealt into ceil(n / rows_per_block) blocks."""
    blocks = F.ceil(n / F.lit(float(rows_per_block))).cast("int")
    return F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda o: F.struct(F.least(o, block).alias("bi"), F.greatest(o, block).alias("bj")),
    )


def iter_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[tuple, pa.Table]]:
    """(key values, rows) of each group, from batches sorted by numeric ``keys``.

    Holds one group and one batch at a time.
    """
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(new)
        for s, e in zip(starts, [*starts[1:], batch.num_rows]):
            key = tuple(int(c[s]) for c in cols)
            if key != last and held:
                yield last, pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(s, e - s))
    if held:
        yield last, pa.Table.from_batches(held)


def iter_runs(batches: Iterator[pa.RecordBatch], keys: list[str], most_bytes: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, starts) of many whole groups at a time, from batches sorted by numeric ``keys``.

    ``starts`` are the first rows of the groups, and the number of rows. For groups that are mostly
    small. Holds about ``most_bytes``, or one group and one batch where that is more.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size < most_bytes:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        starts = _group_starts(rows, keys)
        cut = int(starts[-2])  # the last group may go on
        if cut:
            yield rows.slice(0, cut), starts[:-1]
        rest = rows.slice(cut).combine_chunks()
        held, size = rest.to_batches(), 0
        if not cut:  # one group so far: wait for as much again
            size = -rest.nbytes
    if held:
        rows = pa.Table.from_batches(held).combine_chunks()
        yield rows, _group_starts(rows, keys)


def _group_starts(rows: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows + 1, bool)
    new[[0, -1]] = True
    for k in keys:
        c = rows[k].to_numpy()
        new[1:-1] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def by_group(
    df: DataFrame,
    keys: list[str],
    fn: Callable[[tuple, pa.Table], pa.Table | None],
    schema: str,
    most_rows: int | None = None,
) -> DataFrame:
    """``fn(key, rows)`` on every group of ``df`` by the integer columns ``keys``.

    One shuffle and one sort; a task streams its groups and holds one of them. The
    caller splits groups without a bound beforehand (see ``block_pairs``). Results go back
    in batches of at most ``most_rows`` rows.
    """

    def run(batches):
        for key, rows in iter_groups(batches, keys):
            out = fn(key, rows)
            if out is not None and out.num_rows:
                yield from out.combine_chunks().to_batches(max_chunksize=most_rows)

    return map_batches(df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys), run, schema)


def by_runs(
    df: DataFrame,
    keys: list[str],
    fn: Callable[[pa.Table, np.ndarray], pa.Table | None],
    schema: str,
    most_bytes: int = 4 << 20,
) -> DataFrame:
    """``fn(rows, starts)`` on the groups of ``df`` by the integer columns ``keys``, many groups
    at a time (see ``iter_runs``); like ``by_group`` else."""

    def run(batches):
        for rows, starts in iter_runs(batches, keys, most_bytes):
            out = fn(rows, starts)
            if out is not None and out.num_rows:
                yield from out.combine_chunks().to_batches()

    return map_batches(df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys), run, schema)


def binary_rows(col: pa.ChunkedArray | pa.Array, dtype: str) -> np.ndarray:
    """Rows of equally long binary values as a 2-d array."""
    vals = col.to_pylist()
    return np.frombuffer(b"".join(vals), dtype=dtype).reshape(len(vals), -1)


def spread(matrix: np.ndarray, link: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Component label (a row number) of each row under ``link(row, other rows) -> bool``.

    Breadth first: a row is compared only with rows that no component holds yet, so
    that a group of n mutual copies costs about n comparisons instead of n * n.
    """
    n = len(matrix)
    label = np.full(n, -1)
    rest = np.arange(n)
    while rest.size:
        front = [rest[0]]
        label[rest[0]] = rest[0]
        rest = rest[1:]
        while front and rest.size:
            at = front.pop()
            hit = link(at, rest)
            if hit.any():
                got = rest[hit]
                label[got] = label[at]
                front.extend(got.tolist())
                rest = rest[~hit]
    return label
