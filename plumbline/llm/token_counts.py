"""Token counts: an exact histogram of encoded lengths, whose suffix sums answer for every context limit.

Defined results: a null or blank text has length 0 and counts as a document; repeated rows count; other columns are
ignored; an empty table has an empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import materialise, table
from plumbline.llm.tokens import default_vocabulary, encoder, slices

#: Lengths in a block of the suffix sums, so that no task sums more than a block or the blocks.
BLOCK = 4096


def length_histogram(docs: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """n_tokens, n_docs."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        seen: dict[int, int] = {}
        for whole in batches:
            for batch in slices(whole, 0):
                lengths, counts = np.unique(np.diff(words.ragged(batch.column(0))[1]), return_counts=True)
                for n, c in zip(lengths.tolist(), counts.tolist(), strict=True):
                    seen[n] = seen.get(n, 0) + c
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["n_tokens", "n_docs"])

    parts = docs.select(F.col(text).alias("text")).mapInArrow(run, "n_tokens long, n_docs long")
    return materialise(parts.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs")), "lengths")


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For each length L that occurs: documents and tokens of it and above, the share of documents up to it, and the
    tokens left if every document is cut to L."""
    rows = histogram.withColumn("tokens", F.col("n_tokens") * F.col("n_docs")).withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    later = Window.orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    every = Window.partitionBy()
    blocks = blocks.select(
        "block", F.coalesce(F.sum("block_docs").over(later), F.lit(0)).alias("later_docs"), F.coalesce(F.sum("block_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("block_docs").over(every).alias("all_docs"), F.sum("block_tokens").over(every).alias("all_tokens"),
    )
    here = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumn("docs_here", F.sum("n_docs").over(here)).withColumn("tokens_here", F.sum("tokens").over(here)).join(blocks, "block")
    rows = rows.withColumn("docs_from", F.col("docs_here") + F.col("later_docs")).withColumn("tokens_from", F.col("tokens_here") + F.col("later_tokens"))
    return rows.select(
        "n_tokens", "n_docs", "docs_from", "tokens_from", (F.col("all_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias("truncated_tokens"),
        ((F.col("all_docs") - F.col("docs_from") + F.col("n_docs")) / F.col("all_docs")).alias("share_upto"), "all_docs", "all_tokens",
    )


def at_limits(sums: DataFrame, limits: DataFrame) -> DataFrame:
    """limits (context_limit long) with truncated_tokens and docs_over: for a limit between lengths, from the next length above."""
    points = sums.select(F.col("n_tokens").alias("at"), "docs_from", "tokens_from", "all_tokens", F.lit(None).cast("long").alias("context_limit"))
    asked = limits.select((F.col("context_limit") + 1).alias("at"), F.lit(None).cast("long").alias("docs_from"), F.lit(None).cast("long").alias("tokens_from"), F.lit(None).cast("long").alias("all_tokens"), "context_limit")
    order = Window.orderBy(F.col("at").desc(), F.col("context_limit").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    total = F.max("all_tokens").over(Window.partitionBy())
    both = points.unionByName(asked).withColumn("d", F.last("docs_from", ignorenulls=True).over(order)).withColumn("t", F.last("tokens_from", ignorenulls=True).over(order)).withColumn("all", total)
    over, t = F.coalesce("d", F.lit(0)), F.coalesce("t", F.lit(0))
    return both.where(F.col("context_limit").isNotNull()).select("context_limit", over.alias("docs_over"), (F.coalesce("all", F.lit(0)) - t + over * F.col("context_limit")).alias("truncated_tokens"))


def quantile(sums: DataFrame, share: float) -> DataFrame:
    """n_tokens: the least length that this share of the documents doesn't exceed."""
    return sums.where(F.col("share_upto") >= share).agg(F.min("n_tokens").alias("n_tokens"))


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    return suffix_sums(length_histogram(table(spark, sf_dir, "documents")))
