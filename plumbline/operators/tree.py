"""Trees of parent and child rows, and nested lists of them."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.staging import checked_broadcast, materialise


def walk(nodes: DataFrame, roots: DataFrame, position: str = "id") -> DataFrame:
    """[J31, J32] id, depth, path (ids from the root) and order (positions from the root) of each node that is reached.

    nodes: id, parent and position (among its parent's children). A node comes once, at its least depth and of equal ones
    at its first place, however many parents it has; so cycles end. One join a level, written before the next is looked
    for; it stops at a level without new nodes. A small level is broadcast, so that nodes are read and not shuffled.
    """
    nodes = nodes.select("id", "parent", F.col(position).alias("position"))
    first = roots.select("id").distinct().join(nodes.groupBy("id").agg(F.min("position").alias("position")), "id", "left")
    level = materialise(first.select("id", F.lit(0).alias("depth"), F.array("id").alias("path"), F.array("position").alias("order")), "level")
    seen = out = level
    for depth in itertools.count(1):
        up = level.select(F.col("id").alias("parent"), F.col("path").alias("above"), F.col("order").alias("before"))
        below = nodes.join(checked_broadcast(up), "parent").select("id", F.concat("above", F.array("id")).alias("path"), F.concat("before", F.array("position")).alias("order"))
        below = below.join(seen.select("id"), "id", "left_anti").groupBy("id").agg(F.min_by("path", F.struct("order", "path")).alias("path"), F.min("order").alias("order"))
        level = materialise(below.select("id", F.lit(depth).alias("depth"), "path", "order"), "level")
        if level.isEmpty():
            return out
        seen = out = out.unionByName(level)


def first_items(walked: DataFrame, most: int) -> DataFrame:
    """[J31, T08, T09] The first nodes, each after its parent and before its next sibling; truncated if the list is full."""
    if not 1 <= most <= 2000:
        raise ValueError("1 to 2000 items")
    rows = walked.orderBy("order", "id").limit(most)
    return rows.join(F.broadcast(rows.agg((F.count("*") >= most).alias("truncated"))), F.lit(True))


def leaves(nested: Column, inner: str, outer_fields: dict[str, str]) -> Column:
    """[P26] An array of structs, each with an array of structs inside, as one flat array; fields of the outer struct go along."""
    return F.flatten(F.transform(nested, lambda g: F.transform(g[inner], lambda x: F.struct(*[g[a].alias(b) for a, b in outer_fields.items()], x.alias(inner)))))
