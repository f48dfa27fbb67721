"""Frames with several readers, written once for a build.

A plan that reads a derived frame in two places computes it twice: column pruning and
pushed filters make the two subplans differ, so Spark cannot see that they are one. A build
is therefore made up twice: first to count who asks for which named frame (frames are lazy,
so this runs nothing), then for good, with every frame of two readers or more written to the
shared folder the first time it is asked for and read from there by all.

A write has a price of its own, so a frame is written only if the files it is computed from
hold ``SHARE_BYTES`` or more; a smaller one is computed again. The rows are the same.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from estrella.sources.sinks import shared_scratch_root
from estrella.sources.tables import Tables


SHARE_BYTES = 1 << 30


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` is computed from, by Spark's statistics."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def named(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Declare ``make(t, ...)`` as a named frame of the tables ``t``: its name is that of the
    function with its arguments."""

    @wraps(make)
    def frame(t: Tables, *args, **kwargs) -> DataFrame:
        given = [*map(str, args), *(f"{k}={v}" for k, v in sorted(kwargs.items()))]
        return t.frame("-".join([make.__name__, *given]), lambda: make(t, *args, **kwargs))

    return frame


class _Readers(Tables):
    """Counts the readers of each frame; what a frame reads itself is counted once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        self.readers: Counter[str] = Counter()
        self._made: dict[str, DataFrame] = {}

    def frame(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        self.readers[name] += 1
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]


class _Written(Tables):
    """Writes the frames in ``several`` once, and leaves the others lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str, several: set[str], root: str, least_bytes: int):
        super().__init__(spark, sf_dir)
        self._several, self._root, self._least, self._made = several, root, least_bytes, {}

    def frame(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._several:
            return make()
        if name not in self._made:
            made = make()
            if input_bytes(made) < self._least:
                self._several.discard(name)
                return made
            path = f"{self._root}/{name}"
            made.write.option("compression", "zstd").parquet(path)
            self._made[name] = self.spark.read.schema(made.schema).parquet(path)
        return self._made[name]


def written_frames(spark: SparkSession, sf_dir: str, names: set[str], least_bytes: int) -> Tables:
    """Tables for a job of several results, of which several read the named frames ``names``: each is
    written once under the folder of ``spark.checkpoint.dir`` if it is computed from ``least_bytes``
    or more, and stays lazy else."""
    root = shared_scratch_root(spark, f"estrella-shared-{uuid.uuid4().hex}")
    return _Written(spark, sf_dir, set(names), root, least_bytes)


def readers(spark: SparkSession, sf_dir: str, build: Callable[[Tables], DataFrame]) -> dict[str, int]:
    """How many readers each named frame has in ``build``."""
    counting = _Readers(spark, sf_dir)
    build(counting)
    return dict(counting.readers)


def build_shared(
    spark: SparkSession, sf_dir: str, build: Callable[[Tables], DataFrame], least_bytes: int | None = None,
    also: tuple[str, ...] = (),
) -> DataFrame:
    """``build(t)``, with frames of several readers that are computed from ``least_bytes``
    (SHARE_BYTES) or more written once under the folder of ``spark.checkpoint.dir`` (left
    there for the returned frame to read). Frames in ``also`` are written so with one reader too:
    the planner then knows the size of a narrow side before it moves the wide one to meet it."""
    several = {name for name, n in readers(spark, sf_dir, build).items() if n > 1 or name in also}
    if not several:
        return build(Tables(spark, sf_dir))
    root = shared_scratch_root(spark, f"estrella-shared-{uuid.uuid4().hex}")
    return build(_Written(spark, sf_dir, several, root, SHARE_BYTES if least_bytes is None else least_bytes))
