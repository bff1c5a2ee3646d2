"""Watches as streams: live feeds, and diffs of arriving snapshots against a baseline. Streams are extras: the reference polls once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.diff import bag_diff, comparable, next_baseline


def events(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """[T01] Files of a folder as they arrive."""
    return spark.readStream.schema(schema).parquet(path)


def hourly(df: DataFrame) -> DataFrame:
    """Events by hour and type, over a stream (late by two hours at most) or a table."""
    own = df.withWatermark("ts", "2 hours") if df.isStreaming else df
    return own.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("k"))


def once(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str):
    """[T02] Everything that has arrived since the last call, then stop."""
    return df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def diff_sink(baseline: str, changes: str, statuses: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """[T02, T03] For each batch of snapshot rows (source, key, canon, full): changes against the baseline are appended, and
    the baseline moves on for the sources that were read whole. statuses gives source and status of a batch; without it,
    each source that is in the batch was read whole. Both are written under the batch's number, so a batch that is done
    again changes nothing."""
    whole = statuses or (lambda batch: batch.select("source").distinct().withColumn("status", F.lit("ok")))

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        now = whole(batch)
        if number or _exists(spark, f"{baseline}/0"):
            old = spark.read.parquet(f"{baseline}/{number}")
            then = now.select("source").unionByName(old.select("source")).distinct().withColumn("status", F.lit("ok"))
            found, kept = bag_diff(*comparable(old, batch, then, now)), next_baseline(old, batch, then, now)
        else:
            found, kept = bag_diff(batch.limit(0), batch), batch
        found.write.mode("overwrite").parquet(f"{changes}/batch={number}")
        kept.write.mode("overwrite").parquet(f"{baseline}/{number + 1}")

    return run


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
