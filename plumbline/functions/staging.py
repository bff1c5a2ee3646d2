"""Cutting lineage in the shared folder, and broadcasts behind a count."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of narrow keys up to which a side may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
#: The same for a side that is one long a row: about 60 MB as a hashed relation, where the other side would shuffle texts.
KEY_ROWS = 2_000_000


#: Shuffle files of a finished write go at once instead of when the driver next collects garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, a session on one machine gets a temporary one that becomes the
    setting; on a cluster that is an error, as the executors would not see it."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="plumbline-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    path = f"{shared_dir(spark)}/plumbline-{what}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  the session has ended; the folder's owner cleans up
        return


def materialise(df: DataFrame, what: str, partition_by: str | None = None) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back, so that a lost executor costs a reread only."""
    spark = df.sparkSession
    path = new_path(spark, what)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        out = df.write.option("compression", "zstd")
        if partition_by:
            out = out.partitionBy(partition_by)
        out.parquet(path)
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)
    back = spark.read.schema(df.schema).parquet(path)
    back._plumbline_path = path
    return back


def discard(*tables: DataFrame) -> None:
    """Remove what materialise wrote, once nothing that is still to run reads it."""
    for df in tables:
        _remove(df.sparkSession, df._plumbline_path)


def checked_broadcast(side: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a materialised narrow side if a count proves it small; otherwise leave it to a shuffled join."""
    return F.broadcast(side) if side.limit(limit + 1).count() <= limit else side
