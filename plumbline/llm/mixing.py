"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources share a budget by weight, none above a multiple of its own size; what is over goes to the others by weight.
A source that gets e complete epochs and a part gives each document e times, then those documents once more whose
exponential key, -ln(u) / quality, comes first, as many as fit the rest of its target. u depends on the document alone,
so reruns agree. The order within a source is found in two steps, so that no task sorts a whole source: keys are cut
into about sqrt(n) ranges whose summed sizes are prefix-summed, and only the range in which the budget ends is sorted.

Defined results: null texts have size 0 and are taken like any other; a null source is a source of its own, the last;
repeated rows count and are taken one by one; equal keys are ordered by document; the last document that is begun is
taken whole if at least half of it fits, so a source misses its target by at most half of one document; an empty table gives an empty table; other
columns are ignored (mix_sources) or kept (mixed_documents), where names that begin with two underscores are reserved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import checked_broadcast, materialise, n_words, named, others, table, unit


def quality_weight(text: Column) -> Column:
    """The share of letters and white space among the characters, at least 0.05."""
    text = F.coalesce(text, F.lit(""))
    odd = F.length(text) - F.length(F.regexp_replace(text, r"[^\p{L}\s]++", ""))
    return F.greatest(F.lit(0.05), 1.0 - odd / F.greatest(F.length(text), F.lit(1)))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """source, n, quality, source_size, target from one row a source.

    With the caps in order of cap / weight, the level is the largest of (budget - caps before) / weights from there on.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    own = sizes.withColumn("weight", F.element_at(cycle, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))).cast("int") + 1))
    own = own.withColumn("most", F.col("source_size") * float(cap)).withColumn("budget", F.sum("source_size").over(Window.partitionBy()) * float(share))
    fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("most").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    own = own.withColumn("level", (F.col("budget") - before) / rest)
    level = F.max("level").over(Window.partitionBy())
    return own.withColumn("target", F.least(F.col("most"), F.col("weight") * level)).select("source", "n", "quality", "source_size", "target")


def _keyed(docs: DataFrame, source: str, text: str, doc_id: str) -> DataFrame:
    """docs with __source, __size, __quality, __tie and __key."""
    body = F.coalesce(named(text), F.lit(""))
    own = docs.withColumns({"__source": named(source), "__size": n_words(body), "__quality": quality_weight(body), "__tie": F.xxhash64(named(doc_id), named(source), body)})
    return own.withColumn("__key", -F.ln(unit(F.lit("mix"), F.col("__tie"))) / F.col("__quality"))


class _Plan:
    """Targets by source, the part of the keys in which each source's budget ends, and who is taken there.

    rows: doc_id and the columns of _keyed. The plan's own columns begin with __p_ and clash with no document's.
    """

    def __init__(self, rows: DataFrame, weights: tuple[float, ...], share: float, cap: float):
        sizes = rows.groupBy(F.col("__source").alias("source")).agg(F.sum("__size").alias("source_size"), F.count("*").alias("n"), F.avg("__quality").alias("quality"))
        targets = source_targets(sizes, weights, share, cap).withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        targets = targets.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")).withColumn("parts", F.ceil(F.sqrt("n")))
        self.targets = materialise(targets.select(*[F.col(c).alias(f"__p_{c}") for c in targets.columns]), "targets")
        inner = Window.partitionBy("__source").orderBy("__p_part").rowsBetween(Window.unboundedPreceding, -1)
        sums = self.placed(rows).groupBy("__source", "__p_part", "__p_rest").agg(F.sum("__size").alias("size")).withColumn("before", F.coalesce(F.sum("size").over(inner), F.lit(0)))
        edge = sums.where((F.col("before") < F.col("__p_rest")) & (F.col("before") + F.col("size") >= F.col("__p_rest")))
        edge = edge.groupBy(F.col("__source").alias("of")).agg(F.min("__p_part").alias("__p_edge"), F.min_by("before", "__p_part").alias("__p_before"))
        # A source without an edge has no rest: none of its parts starts below it.
        self.targets = materialise(self.targets.join(edge, F.col("__p_source").eqNullSafe(F.col("of")), "left").drop("of"), "targets")

    def placed(self, rows: DataFrame) -> DataFrame:
        """rows with their source's plan and __p_part, which grows with the key; parts hold about as many rows each."""
        out = rows.join(checked_broadcast(self.targets), F.col("__source").eqNullSafe(F.col("__p_source")))
        return out.withColumn("__p_part", F.floor((1.0 - F.exp(-F.col("__key") * F.col("__p_quality"))) * F.col("__p_parts")).cast("long"))

    @staticmethod
    def at_edge(placed: DataFrame) -> DataFrame:
        """The rows of the parts in which budgets end, sorted by key: __more is 1 where half of the row still fits."""
        order = Window.partitionBy("__source").orderBy("__key", "doc_id", "__tie").rowsBetween(Window.unboundedPreceding, 0)
        upto = F.col("__p_before") + F.sum("__size").over(order) - F.col("__size") / 2
        return placed.where(F.col("__p_part") == F.col("__p_edge")).withColumn("__more", (upto <= F.col("__p_rest")).cast("long"))

    @staticmethod
    def apart(placed: DataFrame) -> DataFrame:
        """All other rows: taken below the edge."""
        below = F.coalesce(F.col("__p_part") < F.col("__p_edge"), F.lit(False))
        return placed.where(F.col("__p_edge").isNull() | (F.col("__p_part") != F.col("__p_edge"))).withColumn("__more", below.cast("long"))


def _planned(docs: DataFrame, weights, share, cap, source, text, doc_id) -> tuple[_Plan, DataFrame]:
    rows = _keyed(docs, source, text, doc_id).select(named(doc_id).alias("doc_id"), "__source", "__size", "__quality", "__tie", "__key")
    rows = materialise(rows, "mix")
    return _Plan(rows, weights, share, cap), rows


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, source: str = "source", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken for each row of docs."""
    plan, rows = _planned(docs, weights, share, cap, source, text, doc_id)
    placed = plan.placed(rows)
    copies = F.col("__p_epochs") + F.col("__more")
    out = plan.apart(placed).unionByName(plan.at_edge(placed))
    return out.select("doc_id", F.col("__source").alias("source"), F.col("__size").alias("size"), F.col("__p_source_size").alias("source_size"), F.col("__p_target").alias("target"), copies.alias("copies"), (copies * F.col("__size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, source: str = "source", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of docs, each as often as the mix takes it. Texts aren't shuffled: the plan is joined to them. Keys are made
    again from the texts, which costs less than to write all texts beside them; sizes aren't.

    Rows that are equal in id, source and text are taken alike, as often as the one of them that is taken most.
    """
    plan, rows = _planned(docs, weights, share, cap, source, text, doc_id)
    edge = materialise(plan.at_edge(plan.placed(rows)).groupBy(F.col("__tie").alias("__p_tie")).agg(F.max("__more").alias("__more")), "edge")
    placed = plan.placed(_keyed(docs, source, text, doc_id)).join(checked_broadcast(edge), F.col("__tie") == F.col("__p_tie"), "left")
    more = F.when(F.col("__p_part") == F.col("__p_edge"), F.coalesce("__more", F.lit(0))).otherwise(F.coalesce(F.col("__p_part") < F.col("__p_edge"), F.lit(False)).cast("long"))
    copies = (F.col("__p_epochs") + more).cast("int")
    return placed.withColumn("__copies", copies).where("__copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*others(docs))


def op4_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
