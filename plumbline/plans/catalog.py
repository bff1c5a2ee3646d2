"""The register of queries: what each answers, from which tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
IDS: dict[str, str] = {}


def query(ids: str, sql: str | None = None):
    """Register a function of (tables) as a query of its name; ids: the survey's operators that it exercises."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(Tables(spark, sf_dir))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__], IDS[f.__name__] = run, ids
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


class Tables:
    """The driver's tables by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def rows(self, data: list, schema: str) -> DataFrame:
        return self.spark.createDataFrame(data, schema)
