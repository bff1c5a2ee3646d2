"""Constrained combinations: one section a code, none in conflict, scored, the best first."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.scalars import js_round
from plumbline.functions.staging import BROADCAST_ROWS, checked_broadcast, materialise
from plumbline.operators.intervals import conflict_pairs, unblocked

#: Weights of the score, and the last period that counts as early.
WEIGHTS = {"early": 2, "gap_segments": 5, "gap_periods": 1, "weekdays": 4, "switches": 6}
EARLY = 2


def candidates(slots: DataFrame, codes: list[str], blocks: DataFrame | None = None) -> DataFrame:
    """[J03, J17] code, idx, section: scheduled sections of the codes without a slot in a block (day, ps, pe), in order."""
    own = slots.where(F.col("code").isin(codes) & (F.size("weeks") > 0))
    sections = own.select("code", "section").distinct()
    if blocks is not None:
        free = unblocked(own, F.broadcast(blocks))
        sections = sections.join(own.join(free, ["section", "day", "ps", "pe"], "left_anti").select("section"), "section", "left_anti").select("code", "section")
    return sections.withColumn("idx", F.row_number().over(Window.partitionBy("code").orderBy("section")))


def code_report(slots: DataFrame, codes: list[str], blocks: DataFrame | None = None) -> DataFrame:
    """[J17] By requested code: candidates, sections without any slot, and whether it is missing (no candidate)."""
    asked = slots.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in dict.fromkeys(codes)])).alias("code"))
    found = candidates(slots, codes, blocks).groupBy("code").agg(F.count("*").alias("candidates"))
    bare = slots.where(F.col("code").isin(codes)).groupBy("code", "section").agg(F.max(F.size("weeks")).alias("k")).where("k <= 0").groupBy("code").agg(F.count("*").alias("unscheduled"))
    out = asked.join(found, "code", "left").join(bare, "code", "left").fillna(0, ["candidates", "unscheduled"])
    return out.withColumn("missing", F.col("candidates") == 0)


def combinations(slots: DataFrame, codes: list[str], search_limit: int = 5000, width: int = 100_000, blocks: DataFrame | None = None) -> DataFrame:
    """[J04] path (candidate numbers by code), sections. Codes with fewer candidates come first; each step drops conflicts.

    A depth-first search meets complete combinations in the order of path, so the first search_limit by path are those
    that it would have looked at. They begin with the first partial ones, so each step keeps the first width partial
    combinations only; if too few of them could be completed, it is done again with more.
    """
    codes = list(dict.fromkeys(codes))
    if not 1 <= len(codes) <= 12:
        raise ValueError("1 to 12 codes")
    cand = materialise(candidates(slots, codes, blocks), "candidates")
    sizes = {r["code"]: r["count"] for r in cand.groupBy("code").count().collect()}  # at most 12 rows
    if len(sizes) < len(codes):
        return slots.sparkSession.createDataFrame([], "path array<int>, sections array<bigint>")
    order = sorted(codes, key=lambda c: (sizes[c], codes.index(c)))
    own_slots = slots.join(F.broadcast(cand.select("section")), "section", "left_semi") if sum(sizes.values()) <= BROADCAST_ROWS else slots.join(cand.select("section"), "section", "left_semi")
    pairs = conflict_pairs(own_slots, own_slots)
    banned = pairs.unionByName(pairs.select(F.col("section_b").alias("section_a"), F.col("section_a").alias("section_b"))).groupBy("section_a").agg(F.collect_set("section_b").alias("banned"))
    cand = cand.join(banned, cand["section"] == banned["section_a"], "left").drop("section_a").withColumn("banned", F.coalesce("banned", F.array().cast("array<bigint>")))
    cand = materialise(cand, "banned")
    own = lambda c: cand.where(F.col("code") == c).select(F.col("idx").alias("i"), F.col("section").alias("s"), F.col("banned").alias("b"))
    first = own(order[0]).select(F.array(F.col("i").cast("int")).alias("path"), F.array("s").alias("sections"))
    while True:
        steps = [first]
        for code in order[1:]:
            both = steps[-1].join(checked_broadcast(own(code)), ~F.arrays_overlap("sections", "b"))
            steps.append(both.select(F.concat("path", F.array(F.col("i").cast("int"))).alias("path"), F.concat("sections", F.array("s")).alias("sections")).orderBy("path").limit(width))
            steps[-1] = materialise(steps[-1], "partial")
        found = steps[-1].orderBy("path").limit(search_limit)
        if found.count() == search_limit or all(s.count() < width for s in steps[1:]):
            return found
        width *= 8


def score(solutions: DataFrame, slots: DataFrame, weights: dict[str, int] | None = None, early: int = EARLY) -> DataFrame:
    """[A16, W01] solutions with metrics by active week and total; solutions: solution, sections."""
    w = weights or WEIGHTS
    meetings = solutions.select("solution", F.explode("sections").alias("section")).join(slots, "section").withColumn("week", F.explode("weeks"))
    day = Window.partitionBy("solution", "week", "day").orderBy("ps", "pe", "campus")
    gap = F.col("ps") - F.lag("pe").over(day) - 1
    before = F.lag("campus").over(day)
    meetings = meetings.withColumn("gap", F.greatest(gap, F.lit(0))).withColumn("switch", F.coalesce((before != "") & (F.col("campus") != "") & (before != F.col("campus")), F.lit(False)))
    days = meetings.groupBy("solution", "week", "day").agg(F.count_if(F.col("ps") <= early).alias("early"), F.count_if(F.col("gap") > 0).alias("gap_segments"), F.coalesce(F.sum("gap"), F.lit(0)).alias("gap_periods"), F.count_if("switch").alias("switches"))
    sums = days.groupBy("solution").agg(F.countDistinct("week").alias("active_weeks"), F.sum("early").alias("early"), F.sum("gap_segments").alias("gap_segments"), F.sum("gap_periods").alias("gap_periods"), F.count("*").alias("weekdays"), F.sum("switches").alias("switches"))
    each = {m: js_round(F.col(m) / F.greatest("active_weeks", F.lit(1)), 2) for m in w}
    out = solutions.join(sums, "solution", "left").fillna(0, ["active_weeks", *w])
    out = out.withColumns(each)
    total = F.lit(0.0)
    for m, k in w.items():
        total = total - F.col(m) * k
    return out.withColumn("total", js_round(total, 2))


def ranked(scored: DataFrame, k: int) -> DataFrame:
    """[O01, O02, W08] The best k, numbered."""
    order = [F.col("total").desc(), "weekdays", "gap_segments", "gap_periods", "early", "switches", F.array_join(F.transform("sections", lambda s: s.cast("string")), "|")]
    top = scored.orderBy(*order).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def total_credits(solutions: DataFrame, credits: DataFrame) -> DataFrame:
    """[A17] solution, credits: the sum over its sections (section, credits), to two places."""
    each = solutions.select("solution", F.explode("sections").alias("section")).join(credits, "section")
    return each.groupBy("solution").agg(js_round(F.sum("credits"), 2).alias("credits"))


def timetables(slots: DataFrame, codes: list[str], k: int = 20, search_limit: int = 5000, blocks: DataFrame | None = None, credits: DataFrame | None = None) -> DataFrame:
    """[T09] The best k with how many were looked at, and whether the search or the list was cut."""
    found = combinations(slots, codes, search_limit, blocks=blocks).withColumn("solution", F.row_number().over(Window.orderBy("path")))
    found = materialise(found, "found")  # search_limit rows at most
    evaluated = F.count("*").over(Window.partitionBy())
    scored = score(found, slots).withColumn("evaluated", evaluated)
    best = ranked(scored, k).withColumn("search_truncated", F.col("evaluated") >= search_limit).withColumn("truncated", F.col("search_truncated") | (F.col("evaluated") > k))
    return best if credits is None else best.join(total_credits(found, credits), "solution", "left")
