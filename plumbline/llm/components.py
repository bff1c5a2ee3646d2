"""Connected components by alternating stars, with grouping and joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import materialise


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, label for each node of an edge (a, b): label is the least node that edges lead to.

    Large stars hang a node's larger neighbours on its least one, small stars its smaller ones; each round halves the
    depth at least, and ends when the edges stay as they are. Minima are pre-aggregated and written before edges join them,
    so that a hub's edges are a skewed key of a plain shuffle, which Spark splits.
    """
    now = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    seen = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialise(large, "large")
        down = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "down")
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v"))).where("u <> v")
        now = materialise(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
