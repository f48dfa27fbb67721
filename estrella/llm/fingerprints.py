"""Document fingerprints by prefix polynomial hashes.

The prefix array of a text holds, for every position i, the sum of (c_j + 1) * base**j
over the code points before i, modulo a prime. A span's hash is the difference of two
entries, so any two spans are compared in constant time, and the longest common extension
from two positions, forwards or backwards, is found by binary search over its length.

A fingerprint keeps a text's length, its whole hash under two bases, and the prefix array
at a few positions counted from the start and from the end. Their distance is a power of
two that follows the length, so two fingerprints always have positions in common, and the
longest common extension of two texts, from the start and back from the end, is found from
the fingerprints alone, again by binary search.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrella.llm.common import map_batches, materialize

PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 1_664_525_003)
POSITIONS = 32  # positions kept from each end, at most
SLICE = 1 << 16
_powers = np.ones((len(BASES), SLICE), np.uint64)
for _k, _base in enumerate(BASES):
    _done = 1
    while _done < SLICE:
        _powers[_k, _done : 2 * _done] = _powers[_k, :_done] * np.uint64(pow(_base, _done, PRIME)) % np.uint64(PRIME)
        _done *= 2


def prefix_arrays(codes: np.ndarray) -> np.ndarray:
    """(bases x (n + 1), uint32) prefix arrays of code points, a slice of positions at a time."""
    n = len(codes)
    out = np.zeros((len(BASES), n + 1), np.uint32)
    for lo in range(0, n, SLICE):
        part = codes[lo : lo + SLICE].astype(np.uint64) + np.uint64(1)
        for k, base in enumerate(BASES):
            local = np.cumsum(part * _powers[k, : len(part)] % np.uint64(PRIME)) % np.uint64(PRIME)
            shifted = local * np.uint64(pow(base, lo, PRIME)) + np.uint64(out[k, lo])
            out[k, lo + 1 : lo + 1 + len(part)] = shifted % np.uint64(PRIME)
    return out


@dataclass(frozen=True)
class Fingerprint:
    """``start[j]`` is the prefix hash (first base) before position j * step, ``end[j]`` the
    one before position n - j * step, for j from 1; ``whole`` the whole hashes."""

    n: int
    whole: tuple[int, ...]
    start: tuple[int, ...]
    end: tuple[int, ...]

    @property
    def step(self) -> int:
        return step_of(self.n)

    def __bytes__(self) -> bytes:
        """The length in 8 bytes and each hash in 4, big-endian."""
        return self.n.to_bytes(8, "big") + np.array([*self.whole, *self.start, *self.end], ">u4").tobytes()

    def __str__(self) -> str:
        return bytes(self).hex()


def parse(fingerprint: str) -> Fingerprint:
    """The fingerprint that a string was made from."""
    raw = bytes.fromhex(fingerprint)
    n = int.from_bytes(raw[:8], "big")
    values = tuple(np.frombuffer(raw, ">u4", offset=8).tolist())
    kept, bases = n // step_of(n), len(BASES)
    return Fingerprint(n, values[:bases], values[bases : bases + kept], values[bases + kept :])


def step_of(n: int) -> int:
    """Distance of the kept positions: the smallest power of two that leaves POSITIONS at most."""
    step = 1
    while n // step > POSITIONS:
        step *= 2
    return step


class Hashed:
    """A text with its prefix arrays."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        self.n = len(codes)
        self.prefix = prefix_arrays(codes)

    def same(self, i: int, other: Hashed, j: int, length: int) -> bool:
        """Whether ``length`` code points from i are equal to those of ``other`` from j."""
        for k, base in enumerate(BASES):
            a = int(self.prefix[k, i + length]) - int(self.prefix[k, i])
            b = int(other.prefix[k, j + length]) - int(other.prefix[k, j])
            if (a * pow(base, j, PRIME) - b * pow(base, i, PRIME)) % PRIME:
                return False
        return True

    def extension(self, i: int, other: Hashed, j: int) -> int:
        """Length of the longest common extension forwards from i and, in ``other``, from j."""
        return _longest(min(self.n - i, other.n - j), lambda length: self.same(i, other, j, length))

    def extension_back(self, i: int, other: Hashed, j: int) -> int:
        """Length of the longest common extension that ends before i and, in ``other``, before j."""
        return _longest(min(i, j), lambda length: self.same(i - length, other, j - length, length))

    @cached_property
    def fingerprint(self) -> Fingerprint:
        step = step_of(self.n)
        at = np.arange(step, self.n + 1, step)
        return Fingerprint(
            self.n,
            tuple(self.prefix[:, -1].tolist()),
            tuple(self.prefix[0, at].tolist()),
            tuple(self.prefix[0, self.n - at].tolist()),
        )


def _longest(most: int, holds) -> int:
    """Largest length up to ``most`` for which ``holds``, which no longer length does after a failure."""
    low, high = 0, most
    while low < high:
        mid = (low + high + 1) // 2
        if holds(mid):
            low = mid
        else:
            high = mid - 1
    return low


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Share of the longer text that the common beginning and the common end make up, by the
    positions that both fingerprints keep; 1 exactly for equal fingerprints (two empty texts
    among them), 0 if one text alone is empty."""
    if a == b:
        return 1.0
    short, long = sorted((a.n, b.n))
    if not short:
        return 0.0
    step = max(a.step, b.step)
    sa, sb = step // a.step, step // b.step
    most = short // step
    base = BASES[0]

    def starts(m: int) -> bool:
        return a.start[m * sa - 1] == b.start[m * sb - 1]

    def ends(m: int) -> bool:
        x, y = a.whole[0] - a.end[m * sa - 1], b.whole[0] - b.end[m * sb - 1]
        return not (x * pow(base, b.n - m * step, PRIME) - y * pow(base, a.n - m * step, PRIME)) % PRIME

    common = (_longest(most, starts) + _longest(most, ends)) * step
    return min(common, short, long - 1) / long


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) code points replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


# digests stay binary as long as they are written; the result has them as lowercase hex
ROW = (
    "doc_id bigint, n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double, common_start bigint, common_end bigint"
)
# part: the task's number; text and opening: of the last row that a task could not finish
HELD = ROW + ", part int, text string, opening string"
_NAMES = [c.split()[0] for c in HELD.split(", ")]


def _compared(doc_id: int | None, text: str, own: Hashed, following: str, next_: Hashed) -> tuple:
    new = edited(text, following)
    other = Hashed(new)
    start = own.extension(0, other, 0)
    end = min(own.extension_back(own.n, other, other.n), min(own.n, other.n) - start)
    return (
        doc_id,
        own.n,
        hashlib.sha256(new.encode()).digest(),
        bytes(own.fingerprint),
        bytes(other.fingerprint),
        likeness(own.fingerprint, other.fingerprint),
        likeness(own.fingerprint, next_.fingerprint),
        start,
        end,
    )


def _batch(rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), types)], [f.name for f in types]
    )


_TYPES = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32(), "binary": pa.binary()}


def _types(schema: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (c.split() for c in schema.split(", "))])


def compare_with_next(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    common_start, common_end of every row of ``docs(doc_id, text)``.

    The next document is the one that follows in descending order of doc_id, after the last
    the first; rows of one doc_id are in the order of hashes of their texts, null ids come
    last. The edited text is ``edited(text, next text)``; near_edited and near_next are the
    ``likeness`` of the fingerprints; common_start and common_end are the exact lengths of
    the common beginning and (not overlapping it) end of text and edited text. A null text is
    an empty one; a single row is its own next; repeated rows give repeated rows, all but the
    last of which are followed by an equal one; no rows give no rows; other columns are not read.

    Texts move once, to ranges of the order. A task goes through its range with two texts at
    hand; its last row waits for the first text of the next range, in a second, small step.
    """
    spark = docs.sparkSession

    def run(batches):
        types = _types(HELD)
        opening = last = None
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                now = (doc, text, Hashed(text))
                if last is None:
                    opening = text
                else:
                    out.append((*_compared(*last, text, now[2]), None, None, None))
                last = now
            if out:
                yield _batch(out, types)
        if last is not None:
            waiting = (last[0], *[None] * (len(_NAMES) - 4), TaskContext.get().partitionId(), last[1], opening)
            yield _batch([waiting], types)

    text = F.coalesce("text", F.lit(""))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.xxhash64(F.lit(1), F.col("text"))]
    # equal rows may be split among ranges: the row's number tells them apart
    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
        .withColumn("nth", F.monotonically_increasing_id())
        .repartitionByRange(*order, "nth")
        .sortWithinPartitions(*order, "nth")
        .select("doc_id", "text")
    )
    found = materialize(ordered.transform(map_batches, run, HELD), "compared")
    rows = found.where("part is null").select(*_NAMES[:-3]).unionByName(_last_of_ranges(found))
    digests = [c for c in rows.columns if c == "edited_sha256" or c.endswith("fingerprint")]
    return rows.withColumns({c: F.lower(F.hex(c)) for c in digests})


def _last_of_ranges(found: DataFrame) -> DataFrame:
    """The rows that end a range, compared with the first text of the next one."""
    waiting = found.where("part is not null").select("part", "doc_id", "text", "opening")
    parts = sorted(r["part"] for r in waiting.select("part").collect())  # one number for each task
    pairs = found.sparkSession.createDataFrame(
        [(p, q) for p, q in zip(parts, parts[1:] + parts[:1])], "part int, following int"
    )
    first = waiting.select(F.col("part").alias("following"), F.col("opening").alias("next_text"))

    def run(batches):
        for batch in batches:
            out = []
            for doc, text, following in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                out.append(_compared(doc, text, Hashed(text), following, Hashed(following)))
            if out:
                yield _batch(out, _types(ROW))

    joined = waiting.join(F.broadcast(pairs), "part").join(first, "following")  # pairs: one for each task
    return joined.select("doc_id", "text", "next_text").transform(map_batches, run, ROW)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and fingerprint of every row of ``docs(doc_id, text)``, without moving it.

    A null text is an empty one; repeated rows give repeated rows; no rows give no rows.
    """

    schema = "doc_id bigint, n_chars bigint, fingerprint string"

    def run(batches):
        for batch in batches:
            got = [Hashed(t or "").fingerprint for t in batch.column(1).to_pylist()]
            if got:
                rows = [(d, f.n, str(f)) for d, f in zip(batch.column(0).to_pylist(), got)]
                yield _batch(rows, _types(schema))

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").transform(map_batches, run, schema)
