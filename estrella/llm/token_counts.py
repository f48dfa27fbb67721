"""Token counts: an exact histogram of encoded lengths with suffix sums.

Documents are reduced to their encoded length before anything is shuffled. Over the
histogram, suffix sums give, for every context limit at once, how many documents reach
it and how many ids are kept or cut when documents are truncated there; quantiles are
read off the same sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estrella.llm import tokens
from estrella.llm.common import map_batches, materialize

BLOCK = 128  # lengths summed together before the running sums, so that no task sees them all


def encoded_lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """n_tokens of every whole text; a null or empty text has 0."""
    definition = tokens.read_definition(tokenizer)

    def run(batches):
        enc = tokens.encoder(definition)
        for batch in batches:
            lengths = np.fromiter((n for _, n in enc.texts(batch.column(0), ids_too=False)), np.int64, batch.num_rows)
            seen, docs_of = np.unique(lengths, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(docs_of.astype(np.int64))], ["n_tokens", "docs"])

    return docs.select("text").transform(map_batches, run, "n_tokens bigint, docs bigint")


def length_histogram(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per encoded length that occurs, with suffix sums.

    n_tokens; docs and tokens of that very length; docs_at_least and tokens_at_least;
    total_docs and total_tokens; kept_tokens and cut_tokens, if every document is cut
    to its first n_tokens ids; share_at_most, the share of documents not longer.
    Repeated rows count as often as they occur; no rows give no rows.
    """
    counted = encoded_lengths(docs, tokenizer).groupBy("n_tokens").agg(F.sum("docs").alias("docs"))
    hist = materialize(
        counted.withColumn("tokens", F.col("n_tokens") * F.col("docs")).withColumn(
            "block", F.floor(F.col("n_tokens") / BLOCK).cast("bigint")
        ),
        "lengths",
    )
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        hist.groupBy("block")
        .agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
        .select(
            "block",
            F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_above"),
            F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_above"),
        )
    )
    total = hist.agg(F.sum("docs").alias("total_docs"), F.sum("tokens").alias("total_tokens"))
    down = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    at_least = (
        hist.join(blocks, "block")
        .crossJoin(F.broadcast(total))  # one row
        .withColumn("docs_at_least", F.col("docs_above") + F.sum("docs").over(down))
        .withColumn("tokens_at_least", F.col("tokens_above") + F.sum("tokens").over(down))
    )
    kept = F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")
    return at_least.select(
        "n_tokens",
        "docs",
        "tokens",
        "docs_at_least",
        "tokens_at_least",
        "total_docs",
        "total_tokens",
        kept.alias("kept_tokens"),
        (F.col("total_tokens") - kept).alias("cut_tokens"),
        ((F.col("total_docs") - F.col("docs_at_least") + F.col("docs")) / F.col("total_docs")).alias("share_at_most"),
    )


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """One row: ids kept and cut when every document is cut to ``limit`` ids, for any limit.

    Read from the first occurring length at or above the limit; with none, nothing is cut.
    """
    above = F.col("n_tokens") >= limit
    docs = F.coalesce(F.max(F.when(above, F.col("docs_at_least"))), F.lit(0))
    toks = F.coalesce(F.max(F.when(above, F.col("tokens_at_least"))), F.lit(0))
    cut = toks - docs * limit
    return histogram.agg(
        F.lit(limit).alias("context"),
        (F.coalesce(F.max("total_tokens"), F.lit(0)) - cut).alias("kept_tokens"),
        cut.alias("cut_tokens"),
    )


def length_quantile(histogram: DataFrame, share: float) -> DataFrame:
    """One row: the smallest length that at least ``share`` of the documents do not exceed."""
    return histogram.where(F.col("share_at_most") >= share).agg(F.min("n_tokens").alias("n_tokens"))
