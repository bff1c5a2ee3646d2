"""Required courses, their states by student, and what is left to choose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.keys import code_else_name


def _clean(c: str) -> Column:
    return F.coalesce(F.trim(c), F.lit(""))


def plain_code(c: str) -> Column:
    return F.upper(F.regexp_replace(_clean(c), r"\s+", ""))


def plain_name(c: str) -> Column:
    return F.lower(F.regexp_replace(_clean(c), r"\s+", ""))


def required_courses(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """[A10] Rows of a plan (pos, code, name, grouping, category, credits, required) as one row a required course, by code
    or else by name: the first code, name and credits that are given, all groups and categories in order. And the required
    rows that have neither code nor name."""
    own = rows.where("required").withColumn("key", F.when(plain_code("code") != "", F.concat(F.lit("code:"), plain_code("code"))).when(plain_name("name") != "", F.concat(F.lit("name:"), plain_name("name"))))
    first = lambda c: F.min_by(c, F.when(c.isNotNull() & (c.cast("string") != ""), F.col("pos")))
    all_ = lambda c: F.array_sort(F.collect_set(F.nullif(_clean(c), F.lit(""))))
    courses = own.where("key is not null").groupBy("key").agg(F.coalesce(first(_clean("code")), F.lit("")).alias("code"), first(_clean("name")).alias("name"), all_("grouping").alias("groups"), all_("category").alias("categories"), first(F.col("credits")).alias("credits"))
    return courses.withColumn("name", F.coalesce("name", F.nullif("code", F.lit("")))), own.where("key is null").drop("key")


def ambiguous_names(courses: DataFrame) -> DataFrame:
    """[A11] Names that more than one required course has."""
    return courses.groupBy(plain_name("name").alias("name")).agg(F.count("*").alias("k")).where("k > 1 and name <> ''").select("name")


def course_states(students: DataFrame, courses: DataFrame, grades: DataFrame, enrolled: DataFrame) -> DataFrame:
    """[A12, J13, J14] student, key, state, attempts, latest and matched_by of each student and required course.

    passed; ambiguous where the course shares its name with another and a row without a reliable code has that name;
    in_progress if it is enrolled (matched_by code or name); unclear after a result that isn't known; else failed,
    non-completed or missing. grades: student, code, name, completion, semester, score; enrolled: student, code, name.
    Courses are one programme's: broadcast.
    """
    shared = ambiguous_names(courses)
    met = code_else_name(grades, courses, "code", "name", "key", shared)
    newest = F.struct("semester", F.coalesce("score", F.lit(float("-inf"))), "completion")
    is_ = lambda c: F.max(F.col("completion") == c)
    tried = met.groupBy("student", F.col("matched_key").alias("key")).agg(
        F.count("*").alias("attempts"), F.max("semester").alias("latest"), is_("passed").alias("passed"), is_("unknown").alias("unknown"),
        F.max_by("completion", F.when(F.col("completion").isin("failed", "non-completed"), newest)).alias("other"),
    )
    now = code_else_name(enrolled, courses, "code", "name", "key", shared).groupBy("student", F.col("matched_key").alias("key")).agg(F.min("matched_by").alias("matched_by"))
    doubtful = courses.withColumn("name", plain_name("name")).join(shared, "name").select("key", "name", (plain_code("code") == "").alias("uncoded"))
    seen = grades.select("student", "code", "name").unionByName(enrolled.select("student", "code", "name")).select("student", (plain_code("code") == "").alias("blank"), plain_name("name").alias("name")).distinct()
    evidence = seen.join(F.broadcast(doubtful), "name").where("blank or uncoded").select("student", "key").distinct().withColumn("doubt", F.lit(True))
    out = students.join(F.broadcast(courses.select("key")), F.lit(True))
    for part in (tried, now, evidence):
        out = out.join(part, ["student", "key"], "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    state = F.when(yes("passed"), "passed").when(yes("doubt"), "ambiguous").when(F.col("matched_by").isNotNull(), "in_progress").when(yes("unknown"), "unclear").otherwise(F.coalesce("other", F.lit("missing")))
    return out.select("student", "key", state.alias("state"), F.coalesce("attempts", F.lit(0)).alias("attempts"), "latest", F.when(state == "in_progress", F.col("matched_by")).alias("matched_by"))


def choice_gaps(categories: DataFrame, modules: DataFrame) -> DataFrame:
    """[A26, F13] Categories in which credits, courses or hours remain, and modules in which credits or courses do or that
    are not passed: scope, name, remaining_credits, remaining_courses, remaining_hours."""
    left = lambda c: F.coalesce(F.col(c) > 0, F.lit(False))
    some = categories.where(left("remaining_credits") | left("remaining_courses") | left("remaining_hours")).select(F.lit("credit-category").alias("scope"), "name", "remaining_credits", "remaining_courses", "remaining_hours")
    open_ = modules.where(left("remaining_credits") | left("remaining_courses") | F.coalesce(~F.col("passed"), F.lit(False)))
    return some.unionByName(open_.select(F.lit("module").alias("scope"), "name", "remaining_credits", "remaining_courses", F.lit(None).cast("double").alias("remaining_hours")))
