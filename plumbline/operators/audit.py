"""Weighted averages, requirement audits and rule sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.scalars import grade_class, js_round
from plumbline.operators.keys import keep_one


def weighted_mean(points: Column, credits: Column) -> list[Column]:
    """[A01, A02] Rows without points or credits count as rows only; sums are whole numbers of thousandths, so exact."""
    counts = points.isNotNull() & (credits > 0)
    w = F.sum(F.when(counts, credits).otherwise(0))
    s = F.sum(F.when(counts, F.floor(points * 1000 + 0.5) * credits).otherwise(0))
    return [js_round(F.when(w > 0, s / 1000.0 / w).otherwise(0.0), 3).alias("gpa"), w.alias("credits"), F.count_if(counts).alias("course_count")]


#: Clauses of a requirement: null or empty means no constraint; all that are given must hold. Codes, prefixes and letters
#: are held against upper case, names (any of them inside the name) against lower case.
RULES = "id string, min_credits double, min_courses int, codes array<string>, prefixes array<string>, departments array<string>, natures array<string>, letters array<string>, min_score double, names array<string>"

#: Best first: score, points, semester, letter, identity.
BEST = ("score", "points", "semester", "letter", "identity")


def fits(rule: Column) -> Column:
    """Whether a grade (code, name, department, nature, letter, score) meets every clause that the rule gives."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    code = F.upper(F.trim(text("code")))

    def clause(values: Column, holds) -> Column:
        return F.coalesce(F.size(values) <= 0, F.lit(True)) | F.exists(F.coalesce(values, F.array().cast("array<string>")), holds)

    return (
        clause(rule["codes"], lambda v: code == F.upper(F.trim(v)))
        & clause(rule["prefixes"], lambda v: code.startswith(F.upper(F.trim(v))))
        & clause(rule["departments"], lambda v: text("department") == v)
        & clause(rule["natures"], lambda v: text("nature") == v)
        & clause(rule["letters"], lambda v: F.upper(F.trim(text("letter"))) == F.upper(F.trim(v)))
        & (rule["min_score"].isNull() | F.coalesce(F.col("score") >= rule["min_score"], F.lit(False)))
        & clause(rule["names"], lambda v: F.contains(F.lower(text("name")), F.lower(v)))
    )


def evaluated(grades: DataFrame, rules: DataFrame) -> DataFrame:
    """[J11, W03, R03, C17] grades with identity, course (the code, else the identity), completion, ids (of the rules that
    fit) and role: counted (the best passed attempt of its course), retake (other passed ones), unresolved or excluded.

    Rules are what one person writes down: they join as one row with an array of them.
    """
    every = rules.agg(F.array_sort(F.collect_list(F.struct(*[f.split()[0] for f in RULES.split(", ")]))).alias("rules"))
    own = grades.withColumn("identity", F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("semester", "code", "name", "letter", "score")]))
    code = F.upper(F.trim(F.coalesce("code", F.lit(""))))
    own = own.withColumn("course", F.when(code == "", F.col("identity")).otherwise(code)).withColumn("completion", grade_class(F.col("letter"), F.col("score")))
    own = own.join(F.broadcast(every), F.lit(True)).withColumn("ids", F.transform(F.filter("rules", fits), lambda r: r["id"])).drop("rules")
    passed = F.col("completion") == "passed"
    place = F.row_number().over(Window.partitionBy("student", "course", passed).orderBy(*[F.col(c).desc_nulls_last() for c in BEST], "grade_id"))
    role = F.when(passed & (place == 1), "counted").when(passed, "retake").when(F.col("completion") == "unknown", "unresolved").otherwise("excluded")
    return own.withColumn("role", role)


def best_attempts(grades: DataFrame) -> DataFrame:
    """[W03, R03, C17] The best passed attempt by student and code."""
    passed = grades.where(grade_class(F.col("letter"), F.col("score")) == "passed")
    own = passed.withColumn("identity", F.concat_ws("|", F.col("code").cast("string"), F.col("letter")))
    return keep_one(own, ["student", "code"], [*[F.col(c).desc_nulls_last() for c in BEST], F.col("grade_id")]).drop("identity")


def audit(grades: DataFrame, rules: DataFrame) -> DataFrame:
    """[A09] By student and requirement: matched credits and courses, what remains, whether it is satisfied, and the grades
    matched, ambiguous (their course fits more than one requirement and counts for none), unresolved, excluded, retaken."""
    each = evaluated(grades, rules).select("student", "grade_id", "credits", "role", F.size("ids").alias("k"), F.explode("ids").alias("id"))
    role = lambda name: F.col("role") == name
    groups = {"matched": role("counted") & (F.col("k") == 1), "ambiguous": role("counted") & (F.col("k") > 1), "unresolved": role("unresolved"), "excluded": role("excluded"), "retaken": role("retake")}
    found = each.groupBy("student", "id").agg(
        F.sum(F.when(groups["matched"], F.col("credits"))).alias("matched_credits"), F.count_if(groups["matched"]).alias("matched_courses"),
        *[F.array_sort(F.collect_list(F.when(is_, F.col("grade_id")))).alias(name) for name, is_ in groups.items()],
    )
    every = grades.select("student").distinct().join(F.broadcast(rules.select("id", "min_credits", "min_courses")), F.lit(True))
    out = every.join(found, ["student", "id"], "left").fillna(0, ["matched_credits", "matched_courses"])
    credits = F.greatest(js_round(F.coalesce("min_credits", F.lit(0.0)) - F.col("matched_credits"), 2), F.lit(0.0))
    courses = F.greatest(F.coalesce("min_courses", F.lit(0)) - F.col("matched_courses"), F.lit(0))
    lists = [F.coalesce(F.col(name), F.array().cast("array<bigint>")).alias(name) for name in groups]
    return out.select("student", "id", js_round(F.col("matched_credits"), 2).alias("matched_credits"), "matched_courses", credits.alias("missing_credits"), courses.alias("missing_courses"), ((credits == 0) & (courses == 0)).alias("satisfied"), *lists)


def audit_summary(grades: DataFrame, rules: DataFrame) -> DataFrame:
    """[A09, T08] By student: grades counted, ambiguous, unresolved, excluded, unmatched, passed retakes, and codes with
    more than one attempt."""
    own = evaluated(grades, rules)
    counted, k = F.col("role") == "counted", F.size("ids")
    courses = own.groupBy("student", "course").agg(
        F.count("*").alias("attempts"), F.count_if(counted).alias("counted"), F.count_if(counted & (k > 1)).alias("ambiguous"), F.count_if(counted & (k == 0)).alias("unmatched"),
        F.count_if(F.col("role") == "unresolved").alias("unresolved"), F.count_if(F.col("role") == "excluded").alias("excluded"), F.count_if(F.col("role") == "retake").alias("retakes"),
    )
    return courses.groupBy("student").agg(F.count_if(F.col("attempts") > 1).alias("duplicate_courses"), *[F.sum(c).alias(c) for c in ("counted", "ambiguous", "unmatched", "unresolved", "excluded", "retakes")])


def findings(rules: dict[str, Column]) -> Column:
    """[F18, F22, F23, F24, F25, P17] The names of the rules that hold, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]))


def attempt_state(total: Column, open_: Column, completed: Column, submitted: Column, latest: Column) -> Column:
    """[A08] By the latest attempt (completed, submitted or open) if it is one of these, else by what there is; mixed if
    something else is open or done beside it."""
    rest = (submitted > 0) | (completed > 0)
    return (
        F.when(total == 0, "not_attempted").when(latest.isin("completed", "submitted"), F.when(open_ > 0, "mixed").otherwise(latest)).when(latest == "open", F.when(rest, "mixed").otherwise("in_progress"))
        .when((open_ > 0) & rest, "mixed").when(completed > 0, "completed").when(submitted > 0, "submitted").when(open_ > 0, "in_progress").otherwise("other")
    )
