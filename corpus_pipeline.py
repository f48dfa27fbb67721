"""The corpus pipeline: stages over ``documents``, each written and read again.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before kept and
returns the columns of ``documents``; the last one returns the packed pieces. The stages
that drop documents decide by doc_id and text, so rows that share a doc_id or have none are
judged by their own text; rows that repeat both are one document from near_duplicates on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrella.llm import decontaminate, langid, line_dedup, packing, setsketch
from estrella.llm.common import materialize
from estrella.llm.queries import table, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose text is in a language learned from the labelled ones."""
    return langid.keep_languages(docs, langid.fit(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take boilerplate lines of each source out of the texts; n_chars follows the text.

    Lines are counted over distinct texts: copies are left to the next stage.
    """
    cleaned = line_dedup.drop_boilerplate(docs, distinct_texts=True)
    return cleaned.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row, of the smallest doc_id, of each group of near copies (5-word shingles, 0.8)."""
    return setsketch.one_of_each_group(docs, width=5, percent=80).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents of which benchmark windows cover a twentieth of the words or more."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 2048 ids (one row per piece)."""
    return packing.pack_documents(docs, tokenizer_path(), end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's rows are written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# The stages learn models, sketch and search, which SQL cannot express.
ORACLE_SQL = None
