"""Readers of stored documents: JSON with a schema, verified snapshots, paged and cursor scans."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from plumbline.sources.sinks import QueryError


def read_json(spark: SparkSession, path: str, schema: str, kind: str | None = None) -> DataFrame:
    """[S11, S13] Whole JSON documents of a fixed schema; another kind or version is an error when rows are read."""
    df = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    if kind is None:
        return df
    ok = (F.col("kind") == kind) & (F.col("schemaVersion") == 1)
    return df.where(F.when(ok, True).otherwise(F.raise_error(F.lit(f"not a {kind} of version 1"))))


def verified(df: DataFrame, body: Column, digest: Column, most: int = 16 << 20) -> DataFrame:
    """[S12] Snapshots of bounded size whose digest is right; any other is an error."""
    ok = (F.octet_length(body) <= most) & (F.sha2(F.encode(body, "UTF-8"), 256) == digest)
    return df.where(F.when(ok, True).otherwise(F.raise_error(F.lit("a snapshot is too large or was changed"))))


def snapshot_state(body: Column, digest: Column, most: int = 16 << 20) -> Column:
    """[S12] ok, or why a stored snapshot can't be used: missing, changed (its digest is another one) or too_large."""
    same = F.sha2(F.encode(body, "UTF-8"), 256) == digest
    return F.when(body.isNull(), "missing").when(~F.coalesce(same, F.lit(False)), "changed").when(F.octet_length(body) > most, "too_large").otherwise("ok")


def unwrap(body: Column, element: str) -> Column:
    """[S25, S26] Records of a bare array or of an envelope with list, rows, data or content."""
    inside = [F.from_json(body, f"struct<{k}:array<{element}>>")[k] for k in ("list", "rows", "data", "content")]
    return F.coalesce(F.when(F.trim(body).startswith("["), F.from_json(body, f"array<{element}>")), *inside)


def fresh_or(cached: DataFrame, saved_at: str, now: Column, live: Callable[[], DataFrame], hours: int = 1) -> DataFrame:
    """[S14] What was saved within the hours, else the live rows."""
    kept = cached.where(F.unix_timestamp(now) - F.unix_timestamp(saved_at) < hours * 3600)
    return kept if not kept.isEmpty() else live()


def fresh_by_source(cached: DataFrame, live: DataFrame, saved_at: str, now: Column, hours: int = 1) -> DataFrame:
    """[S14] By source the cached rows if they were saved within the hours, else the live ones; origin tells which."""
    age = F.unix_timestamp(now) - F.unix_timestamp(F.col(saved_at))
    kept = cached.where(age < hours * 3600).drop(saved_at)
    rest = live.join(kept.select("source").distinct(), "source", "left_anti")
    return kept.withColumn("origin", F.lit("cache")).unionByName(rest.withColumn("origin", F.lit("live")))


class _Page(InputPartition):
    def __init__(self, page: int):
        self.page = page


class PagedSource(DataSource):
    """[S01, S02, S05, S27, S30] A paged service as a data source, a partition a page.

    Options: pages, size, and reader, a module:function of (page, size) that gives tuples of the schema.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return self.options["columns"]

    def reader(self, schema):
        return _PagedReader(self.options)


class _PagedReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def partitions(self):
        pages = int(self.options["pages"])
        if not 1 <= pages <= int(self.options.get("most", "100")):
            raise QueryError("too many pages", "REMOTE")
        return [_Page(i + 1) for i in range(pages)]

    def read(self, partition):
        import importlib

        module, _, name = self.options["reader"].partition(":")
        yield from getattr(importlib.import_module(module), name)(partition.page, int(self.options["size"]))


def cursor_pages(first: str, fetch: Callable[[str], tuple[list, str | None]], most: int = 100) -> Iterator[tuple]:
    """[S03, S04] Rows page by page until there is no next one; a page met twice or too many of them are errors."""
    seen, at = set(), first
    while at:
        if at in seen or len(seen) >= most:
            raise QueryError("a page repeats" if at in seen else "too many pages", "REMOTE")
        seen.add(at)
        rows, at = fetch(at)
        yield from rows


def repeated_pages(pages: DataFrame, body: str) -> DataFrame:
    """[S03] Fingerprints of pages that came more than once."""
    return pages.groupBy(F.sha2(F.encode(body, "UTF-8"), 256).alias("fingerprint")).agg(F.count("*").alias("times")).where("times > 1")
