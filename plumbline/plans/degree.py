"""Queries on requirements, required courses and what is left to choose."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import scalars as S
from plumbline.operators import audit as A
from plumbline.operators import degree as D
from plumbline.plans.adapters import TRANSCRIPT, transcript
from plumbline.plans.catalog import Tables, query

#: One rule for each kind of clause, and two that overlap.
_RULES = [
    ("core", 6.0, 2, ["CS0", "cs2", "CS4", "CS10", "MA1", "MA7"], None, None, None, None, None, None),
    ("maths", 4.0, None, None, ["ma"], None, None, None, 70.0, None),
    ("lettered", None, 1, None, None, None, None, ["a+", "P"], None, None),
    ("office", 2.0, 1, None, None, ["F"], ["1-URGENT"], None, None, None),
    ("named", None, 1, [], None, None, None, None, None, ["course 1", "COURSE 20"]),
]
_ROLES = f"""{TRANSCRIPT},
r(id, min_credits, min_courses) AS (VALUES ('core', 6.0, 2), ('maths', 4.0, NULL), ('lettered', NULL, 1), ('office', 2.0, 1), ('named', NULL, 1)),
e AS (SELECT *, upper(trim(code)) AS uc, CASE WHEN trim(code) = '' THEN identity ELSE upper(trim(code)) END AS course FROM transcript),
role AS (SELECT grade_id, student, course, credits, CASE WHEN completion = 'unknown' THEN 'unresolved' WHEN completion <> 'passed' THEN 'excluded' WHEN n = 1 THEN 'counted' ELSE 'retake' END AS role FROM
  (SELECT *, row_number() OVER (PARTITION BY student, course, completion = 'passed' ORDER BY score DESC NULLS LAST, points DESC NULLS LAST, semester DESC, letter DESC, identity DESC, grade_id) AS n FROM e)),
fit AS (SELECT grade_id, r.id FROM e JOIN r ON CASE r.id WHEN 'core' THEN uc IN ('CS0', 'CS2', 'CS4', 'CS10', 'MA1', 'MA7') WHEN 'maths' THEN starts_with(uc, 'MA') AND coalesce(score >= 70, false)
  WHEN 'lettered' THEN upper(trim(letter)) IN ('A+', 'P') WHEN 'office' THEN department = 'F' AND nature = '1-URGENT' ELSE contains(lower(name), 'course 1') OR contains(lower(name), 'course 20') END),
k AS (SELECT grade_id, count(*) AS k FROM fit GROUP BY 1)"""
_LIST = lambda name, cond: f"coalesce(string_agg(CAST(grade_id AS VARCHAR), ',' ORDER BY grade_id) FILTER (WHERE {cond}), '') AS {name}"


def rules(t: Tables) -> DataFrame:
    return t.rows(_RULES, A.RULES)


@query("C17 A09", f"WITH {_ROLES} SELECT grade_id, role FROM role")
def attempt_roles(t: Tables):
    """Whether each grade is the one that counts, a retake, unresolved or excluded."""
    return A.evaluated(transcript(t), rules(t)).select("grade_id", "role")


@query("W03 R03", f"""WITH {TRANSCRIPT} SELECT student, code, grade_id, score, credits FROM (SELECT *, row_number() OVER (PARTITION BY student, code ORDER BY score DESC NULLS LAST, points DESC NULLS LAST, semester DESC, letter DESC, grade_id) AS n
FROM transcript WHERE completion = 'passed') WHERE n = 1""")
def best_attempt(t: Tables):
    """The best passed attempt by student and code."""
    return A.best_attempts(transcript(t)).select("student", "code", "grade_id", "score", "credits")


@query("J11 A09 F09 M02", f"""WITH {_ROLES}, x AS (SELECT student, id, grade_id, credits, role, k FROM role JOIN fit USING (grade_id) JOIN k USING (grade_id)),
s AS (SELECT student, id, sum(credits) FILTER (WHERE role = 'counted' AND k = 1) AS mc, count(*) FILTER (WHERE role = 'counted' AND k = 1) AS mn, {_LIST('matched', "role = 'counted' AND k = 1")},
  {_LIST('ambiguous', "role = 'counted' AND k > 1")}, {_LIST('unresolved', "role = 'unresolved'")}, {_LIST('excluded', "role = 'excluded'")}, {_LIST('retaken', "role = 'retake'")} FROM x GROUP BY ALL),
st AS (SELECT DISTINCT student FROM transcript)
SELECT student, r.id, CAST(coalesce(mc, 0) AS DOUBLE) AS matched_credits, coalesce(mn, 0) AS matched_courses, CAST(greatest(coalesce(min_credits, 0) - coalesce(mc, 0), 0) AS DOUBLE) AS missing_credits,
  CAST(greatest(coalesce(min_courses, 0) - coalesce(mn, 0), 0) AS BIGINT) AS missing_courses, coalesce(min_credits, 0) <= coalesce(mc, 0) AND coalesce(min_courses, 0) <= coalesce(mn, 0) AS satisfied,
  coalesce(matched, '') AS matched, coalesce(ambiguous, '') AS ambiguous, coalesce(unresolved, '') AS unresolved, coalesce(excluded, '') AS excluded, coalesce(retaken, '') AS retaken
FROM st CROSS JOIN r LEFT JOIN s USING (student, id)""")
def requirement_audit(t: Tables):
    """Requirements by student, with the grades that count for each, and those that don't and why."""
    lists = ["matched", "ambiguous", "unresolved", "excluded", "retaken"]
    return A.audit(transcript(t), rules(t)).withColumns({c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",") for c in lists})


@query("A09 T08", f"""WITH {_ROLES}, c AS (SELECT student, course, count(*) AS attempts, count(*) FILTER (WHERE role = 'counted') AS counted, count(*) FILTER (WHERE role = 'counted' AND k > 1) AS ambiguous, count(*) FILTER (WHERE role = 'counted' AND k IS NULL) AS unmatched,
  count(*) FILTER (WHERE role = 'unresolved') AS unresolved, count(*) FILTER (WHERE role = 'excluded') AS excluded, count(*) FILTER (WHERE role = 'retake') AS retakes FROM role LEFT JOIN k USING (grade_id) GROUP BY ALL)
SELECT student, count(*) FILTER (WHERE attempts > 1) AS duplicate_courses, CAST(sum(counted) AS BIGINT) AS counted, CAST(sum(ambiguous) AS BIGINT) AS ambiguous, CAST(sum(unmatched) AS BIGINT) AS unmatched, CAST(sum(unresolved) AS BIGINT) AS unresolved,
  CAST(sum(excluded) AS BIGINT) AS excluded, CAST(sum(retakes) AS BIGINT) AS retakes FROM c GROUP BY 1""")
def audit_summary(t: Tables):
    """What an audit could and couldn't count, by student."""
    return A.audit_summary(transcript(t), rules(t))


def _plan(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    code = F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.when(k % 2 == 0, "cs").otherwise("MA"), (k % 30).cast("string")))
    name = F.when((k % 5 == 0) & (k % 35 == 0), F.lit(None)).otherwise(F.concat(F.lit("course "), (k % 25).cast("string")))
    return t.part.where(k < 60).select(k.alias("pos"), code.alias("code"), name.alias("name"), F.col("p_brand").alias("grouping"), F.col("p_type").alias("category"), F.when(k % 3 != 0, F.col("p_size").cast("double")).alias("credits"), (k % 4 != 3).alias("required"))


_PLAN = """plan AS (SELECT p_partkey AS pos, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE (CASE WHEN p_partkey % 2 = 0 THEN 'CS' ELSE 'MA' END) || (p_partkey % 30) END AS code, CASE WHEN p_partkey % 35 = 0 THEN NULL ELSE 'course' || (p_partkey % 25) END AS name,
  p_brand AS grouping, p_type AS category, CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_size AS DOUBLE) END AS credits FROM part WHERE p_partkey < 60 AND p_partkey % 4 <> 3),
keyed AS (SELECT *, CASE WHEN code <> '' THEN 'code:' || code ELSE 'name:' || name END AS key FROM plan WHERE code <> '' OR name IS NOT NULL),
course AS (SELECT key, max(code) AS code, arg_min(name, pos) AS name, list_sort(list_distinct(list(grouping))) AS groups, list_sort(list_distinct(list(category))) AS categories, arg_min(credits, pos) FILTER (WHERE credits IS NOT NULL) AS credits FROM keyed GROUP BY 1)"""


@query("A10", f"WITH {_PLAN} SELECT key, code, array_to_string(groups, ',') AS groups, array_to_string(categories, ',') AS categories, credits FROM course")
def required_courses(t: Tables):
    """Required courses of a plan, rows of one course rolled up."""
    courses, _ = D.required_courses(_plan(t))
    return courses.select("key", F.upper("code").alias("code"), F.array_join("groups", ",").alias("groups"), F.array_join("categories", ",").alias("categories"), "credits")


@query("A12 J13 J14 A11", f"""WITH {TRANSCRIPT}, {_PLAN}, shared AS (SELECT name FROM course GROUP BY 1 HAVING count(*) > 1),
g AS (SELECT student, upper(trim(code)) AS code, replace(lower(name), ' ', '') AS name, completion, semester, score FROM transcript),
en AS (SELECT student, CASE WHEN grade_id % 3 = 0 THEN '' ELSE 'CS' || (grade_id % 40) END AS code, 'course' || (grade_id % 31) AS name FROM transcript WHERE grade_id % 11 = 0),
ok AS (SELECT * FROM course WHERE name NOT IN (SELECT name FROM shared)),
hit AS (SELECT g.*, c.key FROM g JOIN course c ON g.code = c.code AND g.code <> '' UNION ALL SELECT g.*, c.key FROM g JOIN ok c ON g.name = c.name AND (g.code = '' OR c.code = '')),
tried AS (SELECT student, key, count(*) AS attempts, max(semester) AS latest, bool_or(completion = 'passed') AS passed, bool_or(completion = 'unknown') AS unknown,
  arg_max(completion, (semester, coalesce(score, '-Infinity'::DOUBLE), completion)) FILTER (WHERE completion IN ('failed', 'non-completed')) AS other FROM hit GROUP BY ALL),
now AS (SELECT student, key, min(m) AS matched_by FROM (SELECT student, c.key, 'code' AS m FROM en JOIN course c ON en.code = c.code AND en.code <> '' UNION ALL SELECT student, c.key, 'name' FROM en JOIN ok c ON en.name = c.name AND (en.code = '' OR c.code = '')) GROUP BY ALL),
doubt AS (SELECT DISTINCT student, c.key FROM (SELECT student, code, name FROM g UNION SELECT student, code, name FROM en) s JOIN course c ON s.name = c.name AND (s.code = '' OR c.code = '') JOIN shared ON shared.name = c.name),
every AS (SELECT DISTINCT student, key FROM transcript CROSS JOIN course),
st AS (SELECT student, key, CASE WHEN passed THEN 'passed' WHEN d.doubt THEN 'ambiguous' WHEN matched_by IS NOT NULL THEN 'in_progress' WHEN unknown THEN 'unclear' ELSE coalesce(other, 'missing') END AS state, coalesce(attempts, 0) AS attempts, latest, matched_by
  FROM every LEFT JOIN tried USING (student, key) LEFT JOIN now USING (student, key) LEFT JOIN (SELECT *, true AS doubt FROM doubt) d USING (student, key))
SELECT student, key, state, attempts, latest, CASE WHEN state = 'in_progress' THEN matched_by END AS matched_by FROM st""")
def required_gap(t: Tables):
    """Each student's state of each required course."""
    g = transcript(t).withColumn("completion", S.grade_class(F.col("letter"), F.col("score")))
    k = F.col("grade_id")
    enrolled = g.where(k % 11 == 0).select("student", F.when(k % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("cs "), (k % 40).cast("string"))).alias("code"), F.concat(F.lit("COURSE "), (k % 31).cast("string")).alias("name"))
    courses, _ = D.required_courses(_plan(t))
    return D.course_states(g.select("student").distinct(), courses, g, enrolled)


@query("A26 F13 P06", """WITH c AS (SELECT s_name AS name, CAST(s_suppkey % 4 AS DOUBLE) AS required, CAST(s_suppkey % 3 AS DOUBLE) AS done, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_suppkey % 6 - 4 END AS courses, CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE CAST(s_suppkey % 5 - 3 AS DOUBLE) END AS hours FROM supplier),
k AS (SELECT name, greatest(required - done, 0) AS credits, courses, hours FROM c),
m AS (SELECT p_name || p_partkey AS name, CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(p_size % 4 - 2 AS DOUBLE) END AS credits, p_size % 2 - 1 AS courses, CASE p_size % 3 WHEN 0 THEN NULL WHEN 1 THEN true ELSE false END AS passed FROM part)
SELECT 'credit-category' AS scope, name, credits AS remaining_credits, CAST(courses AS BIGINT) AS remaining_courses, hours AS remaining_hours FROM k WHERE credits > 0 OR courses > 0 OR hours > 0
UNION ALL SELECT 'module', name, credits, CAST(courses AS BIGINT), NULL FROM m WHERE credits > 0 OR courses > 0 OR NOT passed""")
def choice_gaps(t: Tables):
    """Categories and modules in which something is left to choose."""
    k, size = F.col("s_suppkey"), F.col("p_size")
    given = t.supplier.select(F.col("s_name").alias("name"), (k % 4).alias("required"), (k % 3).alias("completed"), F.when(k % 7 != 0, k % 6 - 4).alias("remaining_courses"), F.when(k % 2 != 0, (k % 5 - 3).cast("double")).alias("remaining_hours"))
    remaining = given.select("name", F.greatest(F.col("required") - F.col("completed"), F.lit(0)).cast("double").alias("remaining_credits"), "remaining_courses", "remaining_hours")
    modules = t.part.select(F.concat("p_name", F.col("p_partkey").cast("string")).alias("name"), F.when(size % 3 != 0, (size % 4 - 2).cast("double")).alias("remaining_credits"), (size % 2 - 1).cast("long").alias("remaining_courses"), F.when(size % 3 == 1, True).when(size % 3 == 2, False).alias("passed"))
    return D.choice_gaps(remaining, modules)
