"""Readers of Markdown, bullet lists, tables and log lines held in text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lines(df: DataFrame, text: str) -> DataFrame:
    """All columns but the text, and n (from 1) and line."""
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.posexplode(F.split(text, "\n")).alias("n", "line")).withColumn("n", F.col("n") + 1)


def carry(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """[W05, S19] carried: the last value that isn't null, of this line and those above."""
    w = Window.partitionBy(*keys).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("carried", F.last(value, ignorenulls=True).over(w))


def blocks(df: DataFrame, keys: list[str], opens: Column) -> DataFrame:
    """[S22] block: how many lines have opened one so far."""
    w = Window.partitionBy(*keys).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("block", F.sum(F.when(opens, 1).otherwise(0)).over(w))


def sections(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """[S20, W06, W07] n, level (2 to 4), title, path of titles, until: the last line before a heading of its level or above."""
    own = lines(df, text).withColumn("level", F.length(F.regexp_extract("line", r"^(#{2,4})\s+\S", 1))).withColumn("title", F.trim(F.regexp_extract("line", r"^#{2,4}\s+(.*)$", 1)))
    up = Window.partitionBy(*keys).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    last = F.max("n").over(Window.partitionBy(*keys))
    own = own.withColumn("last", last)
    for k in (2, 3, 4):  # the latest heading of this level since one above it
        own = own.withColumn(f"at{k}", F.max(F.when(F.col("level") == k, F.col("n"))).over(up)).withColumn(f"title{k}", F.last(F.when(F.col("level") == k, F.col("title")), ignorenulls=True).over(up))
    heads = own.where("level between 2 and 4")
    parts = [F.when(F.col("level") >= 2, F.col("title2")), F.when((F.col("level") >= 3) & (F.col("at3") > F.coalesce("at2", F.lit(0))), F.col("title3")), F.when((F.col("level") == 4) & (F.col("at4") > F.coalesce("at3", F.lit(0))), F.col("title4"))]
    down = Window.partitionBy(*keys).orderBy("n").rowsBetween(1, Window.unboundedFollowing)
    ends = F.array_min(F.array(*[F.when(F.col("level") >= k, F.min(F.when(F.col("level") == k, F.col("n"))).over(down)) for k in (2, 3, 4)]))
    return heads.withColumn("path", F.concat_ws(" > ", *parts)).withColumn("until", F.coalesce(ends - 1, F.col("last"))).select(*keys, "n", "level", "title", "path", "until")


def table(df: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """[S21] Rows of pipe tables with as many cells as the header; the header and the rule go."""
    cells = F.transform(F.split(F.regexp_replace("line", r"^\s*\||\|\s*$", ""), r"\|"), lambda c: F.trim(c))
    own = lines(df, text).where(F.col("line").rlike(r"^\s*\|")).withColumn("cells", cells)
    own = own.where((F.size("cells") == len(columns)) & ~F.forall("cells", lambda c: c.rlike("^:?-+:?$")) & (F.col("cells") != F.array(*[F.lit(c) for c in columns])))
    return own.select(*[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def log_lines(df: DataFrame, line: str, kinds: dict[str, str]) -> DataFrame:
    """[S23] at, source, message and kind by substring (else other); lines of another form go."""
    pattern = r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d)\S*\s+(\S+?):?\s+(.*)$"
    kind = F.lit("other")
    for name, part in reversed(kinds.items()):
        kind = F.when(F.col("message").contains(part), name).otherwise(kind)
    own = df.where(F.col(line).rlike(pattern)).select(F.to_timestamp(F.regexp_extract(line, pattern, 1)).alias("at"), F.regexp_extract(line, pattern, 2).alias("source"), F.regexp_extract(line, pattern, 3).alias("message"))
    return own.withColumn("kind", kind)
