"""Registered queries of the operators, with their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrella.llm import (
    clusters,
    decontaminate,
    embeddings,
    fingerprints,
    infill,
    langid,
    line_dedup,
    packing,
    quality,
    setsketch,
    sharding,
    token_counts,
    token_files,
)

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, linked at cosine 0.9."""
    return embeddings.embedding_duplicates(table(spark, sf_dir, "embeddings"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents not held out."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=1)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all windows of 13 words of the benchmark's items."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt from 32 shards by source to 40 even shards."""
    row = F.concat_ws(":", "_metadata.file_path", "_metadata.row_index")
    return sharding.reshard(table(spark, sf_dir, "documents"), sharding.source_shard(32), row, shards=40)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels not held out."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as ORC token files and digested from them."""
    return token_files.token_round_trip(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, linked at a similarity of 0.85 of their 3-word shingles."""
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact histogram of encoded lengths of all documents, with suffix sums."""
    return token_counts.length_histogram(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that are boilerplate on their source."""
    kept = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "text", "n_lines", "n_dropped")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut at two code points and rearranged, with digests of output and rebuilt text."""
    return infill.digests(infill.fill_in_middle(table(spark, sf_dir, "documents")))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable embeddings in 16 clusters after 3 rounds."""
    return clusters.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with their likeness."""
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_embedding_duplicates,
        op2_language,
        op3_packing,
        op4_decontamination,
        op5_resharding,
        op6_quality,
        op7_token_files,
        op8_near_duplicates,
        op9_token_counts,
        op10_line_dedup,
        op11_fill_in_middle,
        op12_clusters,
        op13_fingerprints,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_embedding_duplicates": embeddings.SQL,
    "op4_decontamination": decontaminate.SQL,
    "op8_near_duplicates": setsketch.SQL,
    "op10_line_dedup": line_dedup.SQL,
    "op11_fill_in_middle": infill.SQL,
    "op12_clusters": clusters.SQL,
}
