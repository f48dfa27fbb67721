"""Packing: first-fit decreasing with a tournament tree of bin capacities, run
independently in randomised groups of documents.

Documents are encoded, ended with an end id, and cut every ``context`` ids; what is
left over of a document stays in one piece. Pieces are dealt at random into groups of
about ``group_pieces``; each group is packed by itself, longest piece first, into the
first sequence that has room, and its sequences are put together and padded in the same
task. A tournament tree whose nodes hold the largest free capacity below them finds that
sequence in log(n) steps. The sequences are written; what is said about their pieces is
read from them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrella.llm import textbytes as tb
from estrella.llm import tokens
from estrella.llm.common import by_group, map_batches, materialize

PIECE = "grp bigint, nth bigint, doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"
SEQUENCE = (
    "sequence_id bigint, used int, ids binary, doc_ids array<bigint>, starts array<bigint>, "
    "lengths array<int>, doc_tokens array<bigint>"
)
BYTES_A_TOKEN = 4  # of text, for the number of groups only
OUT_ROWS = 256  # sequences handed to Spark at a time


def id_type(definition: str, *others: int) -> str:
    """How ids are stored: unsigned little-endian integers of 2 bytes, if the tokenizer's ids and
    ``others`` fit, else of 4."""
    size = tokens.encoder(definition).tokenizer.get_vocab_size()
    return "<u2" if max(size - 1, *others) < 1 << 16 else "<u4"


def group_count(docs: DataFrame, context: int, group_pieces: int) -> int:
    """How many groups make about ``group_pieces`` pieces each, from rows and bytes of text."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("double")
    n, held = docs.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0.0))).first()
    return max(1, -(-int(n + held / (BYTES_A_TOKEN * context)) // group_pieces))


def cut_pieces(
    docs: DataFrame, definition: str, end_id: int, context: int, groups: int, seed: int, dtype: str = "<u4"
) -> DataFrame:
    """Pieces of at most ``context`` ids of every whole document, each dealt to a group.

    A null or empty text has the one id ``end_id``. The group is a hash of document, start,
    the piece's number in its task and seed, so that neither a repeated document nor a hot
    source makes a large group. Columns other than doc_id and text are not read; repeated
    rows give repeated pieces. Ids are stored as ``dtype``.
    """

    def run(batches):
        enc, salt = tokens.encoder(definition), 0
        for batch in batches:
            rows: list[tuple] = []
            for doc, (ids, n) in zip(batch.column(0).to_pylist(), enc.texts(batch.column(1))):
                whole = np.empty(n + 1, dtype)
                whole[:n] = ids
                whole[n] = end_id
                for start in range(0, n + 1, context):
                    part = whole[start : start + context]
                    rows.append((doc, start, len(part), n + 1, salt, part.tobytes()))
                    salt += 1
            if not rows:
                continue
            doc, start, length, total, number, ids = zip(*rows)
            seed_of = np.array([0 if d is None else d for d in doc], np.int64).view(np.uint64)
            mixed = tb.mix(seed_of + tb.mix(np.array(start, np.uint64) + np.uint64(seed)))
            mixed = tb.mix(mixed + tb.mix(np.array(number, np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((mixed % np.uint64(groups)).astype(np.int64)),
                    pa.array((tb.mix(mixed) >> np.uint64(1)).astype(np.int64)),
                    *[pa.array(c, pa.int64()) for c in (doc, start, length, total)],
                    pa.array(ids, pa.binary()),
                ],
                ["grp", "nth", "doc_id", "start", "length", "doc_tokens", "ids"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").transform(map_batches, run, PIECE)


def first_fit_decreasing(lengths: list[int], context: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of each length; longest first, ties in the given order.

    >>> first_fit_decreasing([5, 3, 4, 8], 8)
    ([1, 1, 2, 0], [0, 5, 0, 0])
    """
    n = len(lengths)
    bins, offsets = [0] * n, [0] * n
    order = sorted(range(n), key=lambda i: -lengths[i])
    full = 0  # pieces of the whole context come first and need no search
    while full < n and lengths[order[full]] >= context:
        bins[order[full]] = full
        full += 1
    rest = order[full:]
    size = 1
    while size < max(1, len(rest)):
        size *= 2
    tree = [context] * (2 * size)  # tree[size + b]: free capacity of bin b; above: the larger child
    for i in rest:
        need = lengths[i]
        at = 1
        while at < size:
            at *= 2
            if tree[at] < need:
                at += 1
        offsets[i] = context - tree[at]
        bins[i] = full + at - size
        tree[at] -= need
        while at > 1:
            at //= 2
            most = tree[2 * at] if tree[2 * at] >= tree[2 * at + 1] else tree[2 * at + 1]
            if tree[at] == most:
                break
            tree[at] = most
    return bins, offsets


def padded_length(used: int, context: int) -> int:
    """Sequences are padded to ``context``; one whose ids are a power of two in number stays as it is."""
    return used if used & (used - 1) == 0 else context


def pack_group(rows: pa.Table, group: int, context: int, pad_id: int, dtype: str = "<u4") -> pa.Table:
    """The sequences (``SEQUENCE``) of one group's pieces."""
    rows = rows.sort_by([("length", "descending"), ("nth", "ascending")])
    lengths = rows["length"].to_numpy()
    bins, offsets = (np.asarray(x, np.int64) for x in first_fit_decreasing(lengths.tolist(), context))
    order = np.lexsort((offsets, bins))
    cut = np.flatnonzero(np.diff(bins[order], prepend=-1))
    ids = rows["ids"].combine_chunks()
    used = np.add.reduceat(lengths[order], cut)
    sizes = np.array([padded_length(int(u), context) for u in used])
    at = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.full(at[-1], pad_id, dtype)
    first = at[:-1][bins[order]] + offsets[order]
    for i, to, n in zip(order.tolist(), first.tolist(), lengths[order].tolist()):
        flat[to : to + n] = np.frombuffer(ids[i].as_buffer(), dtype)
    parts = pa.array(np.append(cut, len(order)).astype(np.int32))
    listed = lambda c, t: pa.ListArray.from_arrays(parts, rows[c].combine_chunks().take(pa.array(order)).cast(t))
    return pa.table(
        {
            "sequence_id": pa.array(np.arange(len(cut)) + (group << 32)),
            "used": pa.array(used.astype(np.int32)),
            "ids": pa.array([flat[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary()),
            "doc_ids": listed("doc_id", pa.int64()),
            "starts": listed("start", pa.int64()),
            "lengths": listed("length", pa.int32()),
            "doc_tokens": listed("doc_tokens", pa.int64()),
        }
    )


def pack_sequences(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    context: int = 2048,
    group_pieces: int = 2048,
    seed: int = 7,
    pad_id: int = 0,
) -> DataFrame:
    """Pack whole ``docs(doc_id, text)`` into sequences, written to the shared folder.

    One row for each sequence: sequence_id, used (ids before the padding), ids (``id_type``
    integers, padded with ``pad_id`` to ``context``, unless ``used`` is a power of two), and of its pieces in their
    order doc_ids, starts (ids of the document before the piece), lengths and doc_tokens.
    """
    definition = tokens.read_definition(tokenizer)
    dtype = id_type(definition, end_id, pad_id)
    groups = group_count(docs, context, group_pieces)
    pieces = cut_pieces(docs, definition, end_id, context, groups, seed, dtype)

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        return pack_group(rows, key[0], context, pad_id, dtype)

    return materialize(by_group(pieces, ["grp"], pack, SEQUENCE, OUT_ROWS), "sequences")


def pieces_of(sequences: DataFrame, dtype: str, keep_ids: bool = False) -> DataFrame:
    """One row per piece of written sequences: doc_id, start, length, ids_crc32, doc_tokens,
    (ids,) sequence_id, offset, from the ids in the sequences (stored as ``dtype``)."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if keep_ids else []), "sequence_id", "offset"]

    def run(batches):
        for batch in batches:
            lengths = batch.column(4)
            number = np.diff(lengths.offsets.to_numpy())
            n = lengths.flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), number)
            before = np.concatenate([[0], np.cumsum(n)])
            first = before[np.concatenate([[0], np.cumsum(number)])[:-1]]
            offset = before[:-1] - first[row]
            whole = [np.frombuffer(x.as_buffer(), dtype) for x in batch.column(1)]
            parts = [whole[r][a : a + k] for r, a, k in zip(row.tolist(), offset.tolist(), n.tolist())]
            cols = [
                batch.column(2).flatten(),
                batch.column(3).flatten(),
                pa.array(n),
                pa.array([tokens.crc(x) for x in parts], pa.int64()),
                batch.column(5).flatten(),
            ]
            if keep_ids:
                cols.append(pa.array([x.astype(np.int32) for x in parts], pa.list_(pa.int32())))
            cols += [batch.column(0).take(pa.array(row)), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(cols, names)

    ids = "ids array<int>, " if keep_ids else ""
    schema = f"doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, {ids}sequence_id bigint, offset bigint"
    columns = ["sequence_id", "ids", "doc_ids", "starts", "lengths", "doc_tokens"]
    return sequences.select(*columns).transform(map_batches, run, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    context: int = 2048,
    group_pieces: int = 2048,
    seed: int = 7,
    keep_ids: bool = False,
) -> DataFrame:
    """Pack whole ``documents(doc_id, text)`` into sequences of at most ``context`` ids
    (``pack_sequences``) and return what the written sequences hold (``pieces_of``).

    Null and empty texts are the end id alone; very long texts are cut into many pieces;
    repeated rows are packed as often as they occur; a null doc_id is kept as null; no
    rows give no rows; other columns are ignored.
    """
    sequences = pack_sequences(docs, tokenizer, end_id, context, group_pieces, seed)
    return pieces_of(sequences, id_type(tokens.read_definition(tokenizer), end_id), keep_ids)
