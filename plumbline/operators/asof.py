"""Nearest and next rows in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def next_after(left: DataFrame, right: DataFrame, keys: list[str], at: str, payload: list[str], strict: bool = True) -> DataFrame:
    """[J22, J23, J24, J25] left with the next right row of its keys after at: one sort of both, no pairs.

    Rows of right come after those of left at the same instant if the join is not strict; of right rows at one instant the
    least payload comes first.
    """
    p = F.struct(*[F.col(c).alias(f"next_{c}") for c in payload])
    blank = F.lit(None)
    r = right.select(*keys, F.col(at).alias("__t"), F.lit(0 if strict else 1).alias("__s"), p.alias("__p"))
    kinds = {f.name: f.dataType for f in left.schema.fields}
    r = r.select(*keys, "__t", "__s", "__p", *[blank.cast(kinds[c]).alias(f"__l_{c}") for c in left.columns])
    own = left.select(*keys, F.col(at).alias("__t"), F.lit(1 if strict else 0).alias("__s"), blank.cast(r.schema["__p"].dataType).alias("__p"), *[F.col(c).alias(f"__l_{c}") for c in left.columns])
    w = Window.partitionBy(*keys).orderBy(F.col("__t").desc(), F.col("__s").desc(), F.col("__p").desc()).rowsBetween(Window.unboundedPreceding, 0)
    both = own.withColumn("__left", F.lit(True)).unionByName(r.withColumn("__left", F.lit(False)))
    return both.withColumn("__p", F.last("__p", ignorenulls=True).over(w)).where("__left").select(*[F.col(f"__l_{c}").alias(c) for c in left.columns], "__p.*")


def nearest(left: DataFrame, right: DataFrame, distance: Column, keys: list[str], order: list[Column], on: Column) -> DataFrame:
    """[J21] The nearest right row by distance; ties by order. right is a small calendar and broadcast."""
    joined = left.join(F.broadcast(right), on)
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(distance, *order))
    return joined.withColumn("__n", n).where("__n = 1").drop("__n")


def next_or_overdue(df: DataFrame, due: str, now: Column, key: str) -> DataFrame:
    """[J40, O10] The first due from now on, else the earliest overdue, else the first without a date."""
    group = F.when(F.col(due) >= now, 0).when(F.col(due).isNotNull(), 1).otherwise(2)
    return df.orderBy(group, F.col(due).asc_nulls_last(), key).limit(1)
