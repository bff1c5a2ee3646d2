"""Snapshot diffs as bags: unchanged, changed, added and removed rows by source, with incomparable sources left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _numbered(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def bag_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """[J10, W02, W09, R11] source, key, change_type, before, after of two bags (source, key, canon, full).

    Equal rows (source, key, canon) cancel out one for one; what is left is paired by place within its key.
    """
    keys, same = ["source", "key"], ["source", "key", "canon"]
    a, b = _numbered(before, same, ["full"], "rn"), _numbered(after, same, ["full"], "rn")
    left = a.join(b.select(*same, "rn"), [*same, "rn"], "left_anti").drop("rn")
    right = b.join(a.select(*same, "rn"), [*same, "rn"], "left_anti").drop("rn")
    left = _numbered(left, keys, ["full"], "rn").select(*keys, "rn", F.col("full").alias("before"))
    right = _numbered(right, keys, ["canon", "full"], "rn").select(*keys, "rn", F.col("full").alias("after"))
    both = left.join(right, [*keys, "rn"], "full_outer")
    kind = F.when(F.col("after").isNull(), "removed").when(F.col("before").isNull(), "added").otherwise("changed")
    per_key = Window.partitionBy(*keys)
    nb, na = F.count("before").over(per_key), F.count("after").over(per_key)
    total = F.when(F.col("change_type") == "changed", F.greatest(nb, na)).when(F.col("change_type") == "removed", nb).otherwise(na)
    out = both.withColumn("change_type", kind).withColumn("total", total)
    return out.select("source", F.when(F.col("total") > 1, F.concat_ws("#", "key", F.col("rn").cast("string"))).otherwise(F.col("key")).alias("key"), "change_type", "before", "after")


def comparable(before: DataFrame, after: DataFrame, status_before: DataFrame, status_after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """[T07] Only sources that were read whole on both sides."""
    ok = status_before.where("status = 'ok'").select("source").join(status_after.where("status = 'ok'").select("source"), "source")
    return before.join(F.broadcast(ok), "source", "left_semi"), after.join(F.broadcast(ok), "source", "left_semi")


def diff_summary(changes: DataFrame, sources: DataFrame) -> DataFrame:
    """[A23] By source (source, comparable): added, removed, changed, their total, and whether anything changed: null where
    the source couldn't be compared."""
    count = lambda k: F.count_if(F.col("change_type") == k).alias(k)
    kinds = ["added", "removed", "changed"]
    found = sources.join(changes.groupBy("source").agg(*[count(k) for k in kinds]), "source", "left")
    own = [F.when(F.col("comparable"), F.coalesce(k, F.lit(0))).alias(k) for k in kinds]
    out = found.select("source", *own)
    total = F.col("added") + F.col("removed") + F.col("changed")
    return out.withColumn("total", total).withColumn("has_changes", total > 0)


def advance(baseline_exists: bool, comparable_sources: int) -> str:
    """[T02] What a watch does with its baseline."""
    return "created" if not baseline_exists else "advanced" if comparable_sources else "kept"


def next_baseline(before: DataFrame, after: DataFrame, status_before: DataFrame, status_after: DataFrame) -> DataFrame:
    """[T02] The baseline after a watch: what was just read of the sources that were read whole, what it had of the others;
    where no source is comparable, all of it stays as it was."""
    ok = status_after.where("status = 'ok'").select("source")
    both = status_before.where("status = 'ok'").join(ok, "source", "left_semi").agg((F.count("*") > 0).alias("any"))
    read = after.join(F.broadcast(ok), "source", "left_semi").join(F.broadcast(both.where("any")), F.lit(True)).drop("any")
    kept = before.join(F.broadcast(ok), "source", "left_anti")
    return read.unionByName(kept).unionByName(before.join(F.broadcast(ok), "source", "left_semi").join(F.broadcast(both.where("not any")), F.lit(True)).drop("any"))


def described(changes: DataFrame, text: Column) -> DataFrame:
    """[T03]"""
    return changes.withColumn("description", text)
