"""Relevance and decision scores as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.scalars import grade_class, js_round, let, occurrences, strip_markdown


def search_text(c: Column) -> Column:
    return F.lower(strip_markdown(F.coalesce(c, F.lit(""))))


def relevance(query: str, fields: list[tuple[Column, float]]) -> Column:
    """[X01] fields are already in search_text form. The query's phrase and terms by place, the earlier the more; 0 if
    the phrase isn't there and a term isn't either."""
    needle = " ".join(query.lower().split())
    terms = needle.split(" ") if needle else []
    if not terms:
        return F.lit(0.0)
    at = lambda f, t: F.instr(f, t) - 1

    def score(x: Column) -> Column:
        combined = x["combined"]
        out = F.when(combined.contains(needle), 2000 - F.least(at(combined, needle), F.lit(999))).otherwise(0).cast("double")
        for i, (_, w) in enumerate(fields):
            f = x[f"f{i}"]
            out = out + F.when(f.contains(needle), w * (1000 - F.least(at(f, needle), F.lit(999)))).otherwise(0.0)
            for t in terms:
                out = out + F.when(f.contains(t), w * (150 - F.least(at(f, t), F.lit(149)))).otherwise(0.0)
        every = F.lit(True)
        for t in terms:
            every = every & combined.contains(t)
        return F.when((combined != "") & (combined.contains(needle) | every), out).otherwise(0.0)

    own = F.struct(*[f.alias(f"f{i}") for i, (f, _) in enumerate(fields)])
    return let(own, lambda x: let(F.struct(F.concat_ws(" ", *[F.nullif(x[f"f{i}"], F.lit("")) for i in range(len(fields))]).alias("combined"), *[x[f"f{i}"].alias(f"f{i}") for i in range(len(fields))]), score))


def scored(df: DataFrame, score: Column) -> DataFrame:
    """df with score, as one generated row each: a filter on it isn't pushed below, which would compute it twice."""
    return df.select("*", F.explode(F.array(score)).alias("score"))


def term_score(terms: list[str], fields: list[tuple[Column, int]]) -> Column:
    """[X02, X03] Occurrences by field weight."""
    out = F.lit(0).cast("long")
    for f, w in fields:
        for t in terms:
            out = out + occurrences(F.lower(f), F.lit(t)) * w
    return out


def alias_distance(aliases: Column, query: str) -> Column:
    """[X04] -100 for the same, else the least surplus length of those that hold it; null if none does."""
    q = query.lower()
    return F.array_min(F.transform(F.filter(aliases, lambda a: F.lower(a).contains(q)), lambda a: F.when(F.lower(a) == q, -100).otherwise(F.length(a) - len(q))))


def evidence_weight(confidence: Column, reviews: Column) -> Column:
    """[X10]"""
    c = F.when(confidence == "high", 1.0).when(confidence == "medium", 0.75).when(confidence == "low", 0.45).otherwise(0.0)
    return F.when(reviews > 0, c * F.greatest(F.lit(0.25), F.least(F.lit(1.0), reviews / 20))).otherwise(0.0)


def review_score(rating: Column, percentile: Column, weight: Column) -> Column:
    """[X09]"""
    return js_round(F.coalesce((rating - 7) * 4 * weight, F.lit(0.0)) + F.coalesce((percentile - 50) / 25 * weight, F.lit(0.0)), 2)


def capacity_score(capacity: Column, enrolled: Column) -> Column:
    """[X08]"""
    free = capacity - enrolled
    return F.when(capacity.isNull() | enrolled.isNull() | (capacity <= 0), 0).when(free <= 0, -18).when(free <= 2, -6).when(free >= capacity * 0.25, 4).otherwise(0)


def plan_score(planned: Column, conflicts: Column, feasible: Column) -> Column:
    """[X06] In the plan, or cut by conflicts (8 each up to 24), and whether a whole timetable is left."""
    return F.when(planned, 18).otherwise(0) - F.least(F.lit(24), 8 * conflicts) + F.when(feasible.isNull(), 0).when(feasible, 12).otherwise(-18)


def degree_score(kind: Column, gap: Column) -> Column:
    """[X07]"""
    return F.when(kind == "missing_required", 28).when(kind == "in_progress", -8).when(kind == "passed", -16).when(kind == "choice_gap", 22).when(kind == "category_gap", 18).otherwise(0) + F.when(gap > 0, 4).otherwise(0)


def verdict(total: Column, blocked: Column, compatible: Column) -> Column:
    """[X11]"""
    return F.when(blocked | ~compatible | (total < 0), "avoid").when(total >= 34, "strong").when(total >= 18, "recommend").otherwise("consider")


#: Labels of scores up to 33, up to 67 and above, by dimension; names of air quality by upper bound.
SCORE_LABELS = {"difficulty": ("Hard", "Average", "Easy"), "workload": ("Heavy", "Average", "Light"), "grading": ("Poor", "Average", "Excellent"), "takeaways": ("Low", "Average", "High")}
AIR_LEVELS = [(50, "Good"), (100, "Moderate"), (150, "Unhealthy for Sensitive Groups"), (200, "Unhealthy"), (300, "Very Unhealthy")]


def score_label(v: Column, dimension: str = "takeaways") -> Column:
    """[X14] The score counts from 0 to 100."""
    low, middle, high = SCORE_LABELS[dimension]
    c = F.greatest(F.lit(0), F.least(F.lit(100), v))
    return F.when(c <= 33, low).when(c <= 67, middle).otherwise(high)


def air_level(v: Column) -> Column:
    """[X15]"""
    out = F.lit("Hazardous")
    for most, name in reversed(AIR_LEVELS):
        out = F.when(v <= most, name).otherwise(out)
    return out


def lookup_confidence(exact: Column, base: Column, name: Column, teachers: Column, term: Column, candidates: Column) -> Column:
    """[X13]"""
    return (
        F.when(~exact & ~base & ~name, "none").when(exact & ((teachers > 0) | term | (candidates == 1)), "high")
        .when((exact & (candidates <= 3)) | ((base | name) & (teachers > 0)), "medium").otherwise("low")
    )


def reconciled(conflicts: Column, last: Column, desired: Column, inverse: Column) -> Column:
    """[A24] The verdict on a sequence of observations: how many conflict, which is last, how many are as wished or as before."""
    return F.when(conflicts > 0, "still_uncertain").when(last == "desired", "applied").when((desired == 0) & (inverse >= 2), "not_applied").otherwise("still_uncertain")


def polled(rows: DataFrame, most: int) -> DataFrame:
    """[T04, A24] target, polls and verdict of read-backs (target, n, seen: desired, inverse or conflict): in order, no more
    than most, and none after a desired or conflicting one."""
    w = Window.partitionBy("target").orderBy("n")
    done = F.coalesce(F.max(F.col("seen") != "inverse").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    own = rows.withColumn("place", F.row_number().over(w)).withColumn("done", done).where(~F.col("done") & (F.col("place") <= most))
    is_ = lambda s: F.count_if(F.col("seen") == s)
    return own.groupBy("target").agg(F.count("*").alias("polls"), reconciled(is_("conflict"), F.max_by("seen", "place"), is_("desired"), is_("inverse")).alias("verdict"))


#: How far a state of the degree is before others.
DEGREE_PRIORITY = {"required-gap": 4, "choice-gap": 3, "optional": 2, "unknown": 1}


def decision_order() -> list[Column]:
    """[O03] total, requested, degree_state, seats and rating, the best first; what isn't known comes last."""
    state = F.lit(0)
    for name, value in DEGREE_PRIORITY.items():
        state = F.when(F.col("degree_state") == name, value).otherwise(state)
    return [F.col("total").desc(), F.col("requested").desc(), state.desc(), F.coalesce("seats", F.lit(-1)).desc(), F.coalesce("rating", F.lit(-1)).desc()]


def sorted_reasons(reasons: Column) -> Column:
    """[O13] Structs of impact, kind and message: negative ones first, then positive ones, then others."""
    place = lambda r: F.when(r["impact"] == "negative", 0).when(r["impact"] == "positive", 1).otherwise(2)
    keyed = F.array_sort(F.transform(reasons, lambda r: F.struct(place(r).alias("place"), F.concat_ws(":", r["kind"], r["message"]).alias("text"), r.alias("reason"))))
    return F.transform(keyed, lambda k: k["reason"])


def match_reasons(title: Column, attachments: Column, query: str) -> Column:
    """[X16] reasons (title, attachment) and attachments that hold the query, by any case."""
    needle = query.strip().lower()
    found = F.filter(attachments, lambda a: F.lower(a).contains(needle))
    return F.struct(F.array_compact(F.array(F.when(F.lower(title).contains(needle), "title"), F.when(F.size(found) > 0, "attachment"))).alias("reasons"), found.alias("attachments"))


#: Completions, the best first.
COMPLETIONS = ["passed", "failed", "non-completed", "unknown"]


def best_completion(letter: Column, score: Column) -> Column:
    """[A25] The best completion of a group's rows that have a letter or a score."""
    own = F.when((F.coalesce(letter, F.lit("")) != "") | score.isNotNull(), grade_class(letter, score))
    return F.get(F.array(*[F.lit(c) for c in COMPLETIONS]), F.min(F.array_position(F.array(*[F.lit(c) for c in COMPLETIONS]), own)).cast("int") - 1)
