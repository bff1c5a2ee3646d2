"""What the operators share: table access, words, small literal tables; staging and let come from the library."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.scalars import let
from plumbline.functions.staging import KEY_ROWS, checked_broadcast, discard, materialise, new_path

__all__ = ["KEY_ROWS", "checked_broadcast", "discard", "fresh", "let", "literal_rows", "materialise", "n_words", "named", "new_path", "others", "table", "unit", "words"]

#: Character class of the contracts' words.
WORD_RE = r"[^\x20\x09-\x0D]+"
SPACE_RE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal_rows(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table from values in the plan itself."""
    items = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*items)))


def named(name: str) -> Column:
    """The column of just this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def others(df: DataFrame, *without: str) -> list[Column]:
    """The columns of df but for some, by any case."""
    gone = {w.lower() for w in without}
    return [named(c) for c in df.columns if c.lower() not in gone]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of df has, by any case."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name += "_"
        out.append(name)
    return out


def words(text: Column) -> Column:
    """The words of a text in order; no text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RE))


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_RE)).cast("long")


def unit(*cols: Column) -> Column:
    """A uniform double in (0, 1) that depends on the columns only."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") + 0.5) / float(2**53)
