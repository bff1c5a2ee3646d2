"""Feeds of pages, of chunks of time and of several sources: when reading stops, what came through, what failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.sources.documents import unwrap


def read_pages(pages: DataFrame, element: str, size: int, most: int, limit: int | None = None) -> DataFrame:
    """[S01, S02, S06, S07] pages (feed, page from 1, body, total: as declared or null) that a scan would read, with items.

    A scan reads page by page. It stops after a short page, when it has as many items as were declared, or (limit) as many
    as are wanted; a page that can't be read is an error and ends it, and so is a scan that most pages don't end.
    status: read, last, failed or over.
    """
    items = unwrap(F.col("body"), element)
    w = Window.partitionBy("feed").orderBy("page")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    own = pages.withColumn("items", items).withColumn("n", F.size(F.coalesce("items", F.array().cast(f"array<{element}>"))))
    own = own.withColumn("have", F.coalesce(F.sum("n").over(before), F.lit(0)))
    enough = F.col("have") + F.col("n") >= F.coalesce("total", F.lit(2**62))
    if limit is not None:
        enough = enough | (F.col("have") + F.col("n") >= limit)
    status = F.when(F.col("items").isNull(), "failed").when((F.col("n") < size) | enough, "last").when(F.col("page") >= most, "over").otherwise("read")
    own = own.withColumn("status", status).withColumn("ended", F.coalesce(F.max(F.col("status") != "read").over(before), F.lit(False)))
    out = own.where(~F.col("ended"))
    if limit is not None:
        out = out.withColumn("items", F.slice("items", F.lit(1), F.greatest(F.lit(limit) - F.col("have"), F.lit(0)).cast("int")))
    return out.select("feed", "page", "items", "status")


def page_count(total: Column, size: int, most: int = 200) -> Column:
    """[S06] How many pages a declared total makes, one at least and the bound at most."""
    return F.least(F.greatest(F.ceil(total / size), F.lit(1)), F.lit(most)).cast("int")


def feed_status(read: DataFrame) -> DataFrame:
    """[S01, T08] By feed: pages read, items, and how it ended (complete, failed, over, or open if no page ended it)."""
    ends = F.max(F.when(F.col("status") != "read", F.col("status")))
    return read.groupBy("feed").agg(F.count("*").alias("pages"), F.sum(F.size(F.coalesce("items", F.array()))).alias("items"), F.when(ends == "last", "complete").otherwise(F.coalesce(ends, F.lit("open"))).alias("status"))


def source_report(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """[S28, S29, A22, J43, T08] A status row for each wanted source of rows (source, good): items that could be read, how
    many couldn't, and ok, partial, error (none could) or missing (nothing came)."""
    got = rows.groupBy("source").agg(F.count_if("good").alias("items"), F.count_if(~F.col("good")).alias("failed"))
    out = wanted.join(got, "source", "left")
    status = F.when(F.col("items").isNull(), "missing").when(F.col("failed") == 0, "ok").when(F.col("items") > 0, "partial").otherwise("error")
    return out.select("source", F.coalesce("items", F.lit(0)).alias("items"), F.coalesce("failed", F.lit(0)).alias("failed"), status.alias("status"))


def chunked(items: DataFrame, chunks: DataFrame, at: str, key: str) -> DataFrame:
    """[S09, S10] items that came in a chunk (chunk, lo, hi, ok), both ends included, once by key: as the last chunk that
    came through has them. Chunks are a bounded plan and broadcast; the chunk column tells which one it was."""
    met = items.join(F.broadcast(chunks.where("ok").select("chunk", "lo", "hi")), F.col(at).between(F.col("lo"), F.col("hi"))).drop("lo", "hi")
    rest = [c for c in met.columns if c != key]
    return met.groupBy(key).agg(F.max_by(F.struct(*rest), "chunk").alias("x")).select(key, "x.*")
