"""Minimum-cost-flow resharding.

Rows lie in old shards; new shards have capacities in rows that differ by at most one.
A network joins blocks (the rows of one old shard and one size class) to the shards:
staying at home is free, leaving costs a row's bytes, and the shards that get one row
more are part of the choice. Its minimum-cost flow moves the fewest bytes. The network
holds counts of shards and size classes only; the rows are then dealt by it in Spark, and
only the files of shards that change are written anew.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estrella.llm.common import fresh_path, materialize, small

OVERHEAD = 16  # bytes a row takes besides its text
STEPS = 4  # size classes per doubling of size
FINE = 32  # ranges of sizes a size class is cut into before its rows are ranked
PART_ROWS = 4096  # rows ranked in one window partition, about
FILE_ROWS = 16384  # rows of a shard's file at most
FILE_BYTES = 64 << 20  # bytes of a shard's file at most, and one row


class Network:
    """Minimum-cost flow by successive cheapest paths, with node potentials."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[float] = []

    def edge(self, a: int, b: int, room: int, cost: float) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def solve(self, source: int, sink: int) -> int:
        """Send as much as possible at the least cost; returns the amount."""
        n = len(self.out)
        height, sent = [0.0] * n, 0
        while True:
            dist, via = [float("inf")] * n, [-1] * n
            dist[source] = 0.0
            heap = [(0.0, source)]
            while heap:
                d, x = heapq.heappop(heap)
                if d > dist[x]:
                    continue
                for e in self.out[x]:
                    if self.room[e]:
                        y = self.to[e]
                        away = d + max(0.0, self.cost[e] + height[x] - height[y])
                        if away < dist[y] - 1e-9:
                            dist[y], via[y] = away, e
                            heapq.heappush(heap, (away, y))
            if dist[sink] == float("inf"):
                return sent
            height = [h + min(d, dist[sink]) for h, d in zip(height, dist)]
            amount, at = None, sink
            while at != source:
                e = via[at]
                amount = self.room[e] if amount is None else min(amount, self.room[e])
                at = self.to[e ^ 1]
            at = sink
            while at != source:
                self.room[via[at]] -= amount
                self.room[via[at] ^ 1] += amount
                at = self.to[via[at] ^ 1]
            sent += amount


@dataclass(frozen=True)
class Segment:
    """Rows lo..hi-1, by rank, of a block (old shard, size class) go to a new shard, there
    to the slots from ``slot`` on."""

    old: int
    cls: int
    lo: int
    hi: int
    shard: int
    slot: int


def plan_transfers(blocks: list[tuple[int, int, int, int]], shards: int) -> list[Segment]:
    """Segments that deal (old shard, size class, rows, bytes) blocks to ``shards`` shards with
    row counts at most one apart, moving the fewest bytes. Inside a block the first ranks
    leave; among equal ways the lowest numbers are filled first."""
    blocks = sorted(b for b in blocks if b[2])
    total = sum(b[2] for b in blocks)
    base, more = divmod(total, shards)
    source, sink, pool, extra = 0, 1, 2, 3
    home = 4
    first = home + shards
    net = Network(first + len(blocks))
    stay, leave, enter = {}, {}, []
    for i, (old, cls, rows, size) in enumerate(blocks):
        net.edge(source, first + i, rows, 0.0)
        if old < shards:
            stay[i] = net.edge(first + i, home + old, rows, 0.0)
        leave[i] = net.edge(first + i, pool, rows, size / rows)
    for s in range(shards):
        enter.append(net.edge(pool, home + s, total, 0.0))
        net.edge(home + s, sink, base, 0.0)
        net.edge(home + s, extra, 1, 0.0)
    net.edge(extra, sink, more, 0.0)
    sent = net.solve(source, sink)
    assert sent == total, (sent, total)
    wanted = [[s, net.room[e ^ 1]] for s, e in enumerate(enter)]
    wanted = [w for w in wanted if w[1]]
    slot = [0] * shards
    segments: list[Segment] = []
    for i, (old, cls, rows, _) in enumerate(blocks):
        out = net.room[leave[i] ^ 1]
        lo = 0
        while lo < out:
            w = wanted[0]
            n = min(out - lo, w[1])
            segments.append(Segment(old, cls, lo, lo + n, w[0], slot[w[0]]))
            slot[w[0]] += n
            lo += n
            w[1] -= n
            if not w[1]:
                wanted.pop(0)
        if lo < rows:
            segments.append(Segment(old, cls, lo, rows, old, slot[old]))
            slot[old] += rows - lo
    return segments


def row_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 of each row besides what ``docs`` holds (a null text: no bytes)."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns(
        {
            "size": (F.octet_length(text) + OVERHEAD).cast("bigint"),
            "text_crc32": F.crc32(text.cast("binary")).cast("bigint"),
        }
    )


def assign(rows: DataFrame, shards: int) -> tuple[DataFrame, list[Segment]]:
    """(``rows(doc_id, size, text_crc32, old)`` with shard, slot and file added, the plan).

    ``rows`` should be a written table. Ranks inside a block follow the size, so that its
    smallest rows leave: a block is cut into ascending ranges of sizes, a range of more than
    ``PART_ROWS`` rows into single sizes, and one size with more rows by a salt, which alone
    does not change the bytes. A rank is the count of the parts before plus the rank in the
    part: no task ranks a whole shard, and one hot old shard or size is spread like all others.
    A row that repeats another in all four columns may take its slot as well; both get one.
    """
    scale = F.log2(F.col("size").cast("double")) * STEPS
    rows = rows.withColumns({"cls": F.floor(scale).cast("int"), "sub": F.floor(scale * FINE).cast("int")})
    sizes = materialize(rows.groupBy("old", "cls", "sub", "size").agg(F.count("*").alias("n")), "sizes")
    counts = sizes.groupBy("old", "cls").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("bytes"))
    segments = plan_transfers([(r["old"], r["cls"], r["n"], r["bytes"]) for r in counts.collect()], shards)
    in_range = F.sum("n").over(Window.partitionBy("old", "cls", "sub"))  # at most the sizes within half a percent
    crowded = sizes.withColumn("range", in_range).where(F.col("range") > PART_ROWS)
    crowded = crowded.select("old", "size", F.ceil(F.col("n") / PART_ROWS).alias("salts"))
    alone = F.col("salts").isNotNull()
    # repeated rows share their hash: a salt, written with the rows, keeps a part bounded
    salt = F.pmod(F.xxhash64("doc_id", "text_crc32", F.monotonically_increasing_id()), F.coalesce("salts", F.lit(1)))
    rows = materialize(
        rows.join(small(materialize(crowded, "crowded")), ["old", "size"], "left")
        .withColumns({"fine": F.when(alone, F.col("size")).otherwise(0), "salt": salt})
        .drop("salts"),
        "ranked",
    )
    key = ["old", "cls", "sub", "fine", "salt"]
    before = Window.partitionBy("old", "cls").orderBy("sub", "fine", "salt")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*key).agg(F.count("*").alias("n"))
    offsets = offsets.select(*key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy(*key).orderBy("size", "doc_id", "text_crc32")
    ranked = rows.withColumn("rank", F.row_number().over(inside) - 1).join(small(materialize(offsets, "offsets")), key)
    spark = rows.sparkSession
    plan = spark.createDataFrame(
        [(s.old, s.cls, s.lo, s.hi, s.shard, s.slot, at, each) for s, at, each in _bytes_before(segments)],
        "old int, cls int, lo bigint, hi bigint, shard int, first bigint, at double, each double",
    )
    at = F.col("base") + F.col("rank")
    dealt = (
        ranked.withColumn("rank", at)
        .join(F.broadcast(plan), ["old", "cls"])  # at most old shards x size classes + shards rows
        .where((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
        .withColumn("slot", F.col("first") + F.col("rank") - F.col("lo"))
        .withColumn("file", F.floor((F.col("at") + (F.col("rank") - F.col("lo") + 1) * F.col("each")) / FILE_BYTES))
    )
    return dealt.drop("cls", "sub", "fine", "salt", "base", "rank", "lo", "hi", "first", "at", "each"), segments


def _bytes_before(segments: list[Segment]) -> list[tuple[Segment, float, float]]:
    """Each segment, the bytes at most in its shard before it, and the bytes at most of its rows."""
    out, full = [], {}
    for s in sorted(segments, key=lambda s: (s.shard, s.slot)):
        each = 2.0 ** ((s.cls + 1) / STEPS)
        at = full.get(s.shard, 0.0)
        out.append((s, at, each))
        full[s.shard] = at + (s.hi - s.lo) * each
    return out


def moved_bytes(assigned: DataFrame) -> DataFrame:
    """One row: rows and bytes that lie in another shard than before."""
    away = F.col("shard") != F.col("old")
    return assigned.agg(
        F.coalesce(F.sum(F.when(away, 1)), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(away, F.col("size"))), F.lit(0)).alias("bytes"),
    )


def write_affected(assigned: DataFrame, path: str) -> list[int]:
    """Write anew the files of every shard that loses or gets a row; returns those shards.

    Files go to ``path/shard=N``, consecutive slots of at most ``FILE_ROWS`` rows and
    about ``FILE_BYTES`` to a task. Shards whose rows all stay keep their old files.
    """
    away = assigned.where("shard <> old")
    ends = away.select(F.explode(F.array("shard", "old")).alias("s")).distinct().collect()  # shard numbers
    affected = sorted(r["s"] for r in ends)
    (
        assigned.where(F.col("shard").isin(affected))
        .repartition("shard", "file", F.floor(F.col("slot") / FILE_ROWS))
        .sortWithinPartitions("shard", "slot")
        .drop("file")
        .write.partitionBy("shard")
        .parquet(path)
    )
    return affected


def source_shard(old_shards: int):
    """The old layout of ``documents``: all documents of a source in one shard."""
    return F.pmod(F.xxhash64(F.coalesce("source", F.lit(""))), F.lit(old_shards)).cast("int")


def reshard(docs: DataFrame, old, row, shards: int = 40) -> DataFrame:
    """Deal all ``docs(doc_id, text)`` from old shards (column ``old``) to ``shards`` shards and
    return doc_id, size, text_crc32, law, shard, slot, grown_shard, read from the new files.

    ``row`` is a column that tells any two rows apart and stays as it is when the input is
    read again (such as file name and row number): ranks are found on sizes alone, and
    texts move once, to their new file.

    The law is ``rows``: counts of any two shards differ by at most one. Slots are gapless
    from 0 in each shard. A null text has no bytes; a null doc_id is a row like others;
    repeated rows are kept; with fewer rows than shards some shards are empty; no rows
    give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", old.alias("old"), row.alias("row"))
    placed, _ = assign(materialize(row_sizes(source).drop("text"), "rows"), shards)
    placed = materialize(placed, "placed")
    full = source.select("row", "text").join(small(placed), "row").drop("row")
    path = fresh_path(spark, "shards")
    affected = write_affected(full, path)
    schema = "doc_id bigint, text string, size bigint, text_crc32 bigint, old int, slot bigint, shard int"
    digest = ["doc_id", "size", "text_crc32", "shard", "slot"]
    written = row_sizes(spark.read.schema(schema).parquet(path).drop("size", "text_crc32")).select(*digest)
    unchanged = placed.where(~F.col("shard").isin(affected)).select(*digest)
    return written.unionByName(unchanged).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
