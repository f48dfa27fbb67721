"""Token-ID output: ORC files of ids with run-length encoded integers, row indexes and
Bloom filters on document ids.

Documents are range-partitioned and sorted by doc_id before they are encoded, so files
and stripes hold disjoint, ascending ranges of ids: a lookup by doc_id skips files,
stripes and row groups by their min/max statistics and Bloom filters, and stripes are
read in parallel.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from estrella.llm import tokens
from estrella.llm.common import fresh_path, map_batches, materialize, small

STRIPE_BYTES = 16 << 20
INDEX_ROWS = 2000
FILE_SCHEMA = "doc_id bigint, first bigint, n_tokens bigint, ids array<int>"


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, first (ids before it in its file), n_tokens and ids, in ascending doc_id
    order over the partitions. Rows with the same doc_id are ordered by their text's hash."""
    definition = tokens.read_definition(tokenizer)

    def run(batches):
        enc, first = tokens.encoder(definition), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            parts, at, tail = [], np.zeros(batch.num_rows + 1, np.int64), np.array([end_id], np.int32)
            for i, (ids, n) in enumerate(enc.texts(batch.column(1))):
                parts += [ids, tail]
                at[i + 1] = at[i] + n + 1
            flat = pa.array(np.concatenate(parts, dtype=np.int32, casting="unsafe"))
            del parts
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(at[:-1] + first),
                    pa.array(np.diff(at)),
                    pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), flat),
                ],
                ["doc_id", "first", "n_tokens", "ids"],
            )
            first += int(at[-1])

    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .repartitionByRange(F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    )
    return ordered.transform(map_batches, run, FILE_SCHEMA)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Write every whole text's ids and ``end_id`` to ORC files under ``path``.

    Null and empty texts are the end id alone. File number k holds the k-th range of
    doc_ids. No rows write no row; other columns are ignored; repeated rows are kept.
    """
    (
        encode_documents(docs, tokenizer, end_id)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", str(INDEX_ROWS))
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .option("compression", "zstd")
        .option("maxRecordsPerFile", "0")
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows, with ``file_no``, the number that orders the files."""
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("bigint")
    return spark.read.schema(FILE_SCHEMA).orc(path).select("*", number.alias("file_no"))


def file_bases(files: DataFrame) -> DataFrame:
    """file_no and ``base``, the ids in all files before it: a running sum over one row a file."""
    totals = files.groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("file_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every row, from the files alone."""

    def run(batches):
        tokens.release()  # the worker may have written such files before
        for batch in batches:
            lists = batch.column(3)
            at = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values.to_numpy().astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array(np.diff(at).astype(np.int64)),
                    pa.array([tokens.crc(flat[a:b]) for a, b in zip(at, at[1:])], pa.int64()),
                ],
                ["doc_id", "file_no", "first", "n_tokens", "ids_crc32"],
            )

    files = read_token_files(spark, path)
    bases = small(materialize(file_bases(files), "filebases"))
    return (
        files.select("doc_id", "file_no", "first", "ids")
        .transform(map_batches, run, "doc_id bigint, file_no bigint, first bigint, n_tokens bigint, ids_crc32 bigint")
        .join(bases, "file_no")
        .select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
    )


def token_round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and digest what is read back."""
    spark = docs.sparkSession
    path = fresh_path(spark, "tokens")
    write_token_files(docs, path, tokenizer, end_id)
    return token_digest(spark, path)
