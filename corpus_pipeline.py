"""A corpus from documents: quality rules, near duplicates, mixing by source, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written and reread as the next one's
docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import KEY_ROWS, checked_broadcast, fresh, materialise, table
from plumbline.llm.jaccard import jaccard_components
from plumbline.llm.mixing import mixed_documents
from plumbline.llm.packing import pack_documents, with_digest
from plumbline.llm.quality import quality_rules


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and failing lines go from the others (n_chars follows where a text changes). Each row is judged
    alone, so repeated rows fare alike; null and blank texts are rejected; columns of any name stay as they are.
    """
    judged = quality_rules(docs).where("kept")
    changed = F.col("n_removed") > 0
    judged = judged.withColumn("text", F.when(changed, F.col("clean_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        judged = judged.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return judged.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays: of the least doc_id (null ids come last), of rows equal in id and text the first by
    the other columns. Rows are told apart by id and text, so an id with two texts is two documents. Rows without words
    link with nothing, and all stay.
    """
    key, place = fresh(docs, "key", "place")
    keyed = docs.select("*", F.xxhash64("doc_id", F.col("doc_id").isNull(), "text").alias(key))
    classes = jaccard_components(keyed, doc_id=key).where("n_shingles > 0").groupBy(F.col("doc_id").alias(key), "component_id").agg(F.count("*").alias("rows"))
    classes = materialise(classes, "classes").join(keyed.select(key, F.col("doc_id").alias("id")).distinct(), key)
    classes = materialise(classes, "places")
    first = materialise(classes.groupBy("component_id").agg(F.min_by(F.struct(key, "rows"), F.struct(F.col("id").isNull(), "id", key)).alias("first")).select("first.*"), "first")
    gone = materialise(classes.join(first, key, "left_anti").select(key), "gone")
    kept = keyed.join(checked_broadcast(gone, KEY_ROWS), key, "left_anti")
    twice = materialise(first.where("rows > 1").select(key), "twice")
    if twice.isEmpty():
        return kept.select(*docs.columns)
    small = checked_broadcast(twice, KEY_ROWS)
    # Of repeated rows, tasks keep the first that they have; id and text are the same in all.
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    one = kept.join(small, key).groupBy(key).agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.min(F.struct(F.lit(0).alias(place), *rest)).alias(place))
    one = one.select("doc_id", "text", *[F.col(place)[c].alias(c) for c in rest])
    return kept.join(small, key, "left_anti").select(*docs.columns).unionByName(one)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it. Equal keys are ordered by document, and rows equal in id,
    source and text are taken alike; a null source is one of its own, and a null text has no words but a place in the order.
    Columns that begin with two underscores are the mix's own.
    """
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences. Repeated rows are packed one by one, a null text as its end id; pieces of equal
    length are used in the order of their rows. The result has columns of its own.
    """
    return with_digest(pack_documents(docs))


STAGES = [("quality_rules", quality), ("ngram_jaccard_join", near_duplicates), ("mix_sources", mix), ("pack_documents", pack)]
#: Shingle classes and packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, name)
    return docs
