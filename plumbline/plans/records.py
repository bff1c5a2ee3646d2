"""Queries on grades, snapshots, keys and counts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.functions import scalars as S
from plumbline.operators import audit as A
from plumbline.operators import diff as D
from plumbline.operators import keys as K
from plumbline.operators import rank as X
from plumbline.plans.adapters import GRADES, POINTS, SNAPSHOTS, grades, snapshots
from plumbline.plans.catalog import Tables, query

_GPA = f"""floor(CASE WHEN sum(CASE WHEN p IS NOT NULL AND credits > 0 THEN credits ELSE 0 END) > 0 THEN sum(CASE WHEN p IS NOT NULL AND credits > 0 THEN p * credits ELSE 0 END) / 1000.0
  / sum(CASE WHEN p IS NOT NULL AND credits > 0 THEN credits ELSE 0 END) ELSE 0 END * 1000 + 0.5) / 1000 AS gpa, CAST(sum(CASE WHEN p IS NOT NULL AND credits > 0 THEN credits ELSE 0 END) AS BIGINT) AS credits,
  count(CASE WHEN p IS NOT NULL AND credits > 0 THEN 1 END) AS course_count"""


@query("A01 A02 M01 M02 P04", f"WITH {GRADES}, g AS (SELECT *, {POINTS} AS p FROM grades JOIN customer ON student = c_custkey) SELECT coalesce(nullif(trim(c_mktsegment), ''), 'Unknown') AS segment, {_GPA} FROM g GROUP BY 1")
def gpa_by_group(t: Tables):
    """Credit-weighted averages by market segment."""
    g = grades(t).join(t.customer, F.col("student") == F.col("c_custkey"))
    return g.groupBy(F.coalesce(F.nullif(F.trim("c_mktsegment"), F.lit("")), F.lit("Unknown")).alias("segment")).agg(*A.weighted_mean(S.score_points(F.col("score")), F.col("credits")))


@query("A02", f"WITH {GRADES}, g AS (SELECT *, {POINTS} AS p FROM grades) SELECT semester, {_GPA} FROM g GROUP BY 1")
def gpa_by_semester(t: Tables):
    return grades(t).groupBy("semester").agg(*A.weighted_mean(S.score_points(F.col("score")), F.col("credits")))


@query("A01", f"WITH {GRADES}, g AS (SELECT *, {POINTS} AS p FROM grades) SELECT student, {_GPA} FROM g GROUP BY 1")
def gpa_by_student(t: Tables):
    return grades(t).groupBy("student").agg(*A.weighted_mean(S.score_points(F.col("score")), F.col("credits")))


@query("M02 C17", f"WITH {GRADES} SELECT grade_id, {POINTS} / 1000 AS points, CASE WHEN score >= 60 THEN 'passed' ELSE 'failed' END AS outcome FROM grades")
def grade_points(t: Tables):
    return grades(t).select("grade_id", S.score_points(F.col("score")).alias("points"), S.grade_class(F.lit("F"), F.col("score")).alias("outcome"))


@query("W04", f"WITH {GRADES} SELECT student, code, grade_id, semester FROM (SELECT *, row_number() OVER (PARTITION BY student, code ORDER BY semester DESC, score DESC, grade_id) AS n FROM grades) WHERE n = 1")
def newest_attempt(t: Tables):
    return K.keep_one(grades(t), ["student", "code"], [F.col("semester").desc(), F.col("score").desc(), F.col("grade_id")]).select("student", "code", "grade_id", "semester")


@query("A11", "SELECT p_name AS name, count(*) AS k FROM part GROUP BY 1 HAVING count(*) > 1")
def ambiguous_names(t: Tables):
    return t.part.groupBy(F.col("p_name").alias("name")).agg(F.count("*").alias("k")).where("k > 1")


@query("A04 R02", "SELECT o_orderpriority AS kind, count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS open, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS done, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS partial, count(*) AS total FROM orders GROUP BY 1")
def status_counts(t: Tables):
    is_ = lambda s: F.count_if(F.col("o_orderstatus") == s)
    return t.orders.groupBy(F.col("o_orderpriority").alias("kind")).agg(is_("O").alias("open"), is_("F").alias("done"), is_("P").alias("partial"), F.count("*").alias("total"))


@query("A06 A08 J28 J42", """WITH l AS (SELECT l_orderkey AS k, l_shipdate, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'completed' WHEN l_returnflag = 'A' THEN 'submitted' WHEN l_linestatus = 'O' THEN 'open' ELSE 'other' END AS st FROM lineitem),
a AS (SELECT k, count(*) AS total, count(CASE WHEN st = 'completed' THEN 1 END) AS completed, count(CASE WHEN st = 'submitted' THEN 1 END) AS submitted, count(CASE WHEN st = 'open' THEN 1 END) AS open,
  max(l_shipdate) AS latest, arg_max(st, (l_shipdate, l_linenumber, st)) AS last FROM l GROUP BY 1)
SELECT o_orderkey AS id, coalesce(total, 0) AS total, latest, CASE WHEN total IS NULL THEN 'not_attempted' WHEN last IN ('completed', 'submitted') THEN CASE WHEN open > 0 THEN 'mixed' ELSE last END
  WHEN last = 'open' THEN CASE WHEN submitted + completed > 0 THEN 'mixed' ELSE 'in_progress' END WHEN open > 0 AND submitted + completed > 0 THEN 'mixed' WHEN completed > 0 THEN 'completed' WHEN submitted > 0 THEN 'submitted'
  WHEN open > 0 THEN 'in_progress' ELSE 'other' END AS state FROM orders LEFT JOIN a ON o_orderkey = k""")
def derived_state(t: Tables):
    """State of each order by its lines."""
    flag = F.when(F.col("l_returnflag") == "R", "completed").when(F.col("l_returnflag") == "A", "submitted").when(F.col("l_linestatus") == "O", "open").otherwise("other")
    lines = t.lineitem.withColumn("st", flag)
    n = lambda s: F.count_if(F.col("st") == s).alias(s)
    lines = lines.groupBy(F.col("l_orderkey").alias("id")).agg(F.count("*").alias("total"), n("completed"), n("submitted"), n("open"), F.max("l_shipdate").alias("latest"), F.max_by("st", F.struct("l_shipdate", "l_linenumber", "st")).alias("last"))
    total = F.coalesce("total", F.lit(0))
    return t.orders.select(F.col("o_orderkey").alias("id")).join(lines, "id", "left").select("id", total.alias("total"), "latest", A.attempt_state(total, F.col("open"), F.col("completed"), F.col("submitted"), F.col("last")).alias("state"))


@query("A05", "SELECT event_type AS kind, count(*) AS k, count(DISTINCT user_id) AS users, CAST(sum(count(*)) OVER () AS BIGINT) AS all_rows FROM events GROUP BY 1")
def kind_histogram(t: Tables):
    return t.events.groupBy(F.col("event_type").alias("kind")).agg(F.count("*").alias("k"), F.countDistinct("user_id").alias("users")).withColumn("all_rows", F.sum("k").over(Window.partitionBy()))


@query("J10 W02 W09 R11", f"WITH {SNAPSHOTS} SELECT * FROM changes")
def snapshot_diff(t: Tables):
    return D.bag_diff(*snapshots(t))


@query("A23 T07", f"""WITH {SNAPSHOTS}, c AS (SELECT source, count(CASE WHEN change_type = 'added' THEN 1 END) AS added, count(CASE WHEN change_type = 'removed' THEN 1 END) AS removed, count(CASE WHEN change_type = 'changed' THEN 1 END) AS changed FROM changes WHERE source <> 'P' GROUP BY 1)
SELECT s.source, CASE WHEN s.ok THEN coalesce(added, 0) END AS added, CASE WHEN s.ok THEN coalesce(removed, 0) END AS removed, CASE WHEN s.ok THEN coalesce(changed, 0) END AS changed, CASE WHEN s.ok THEN coalesce(added + removed + changed, 0) END AS total,
  CASE WHEN s.ok THEN coalesce(added + removed + changed, 0) > 0 END AS has_changes FROM (VALUES ('O', true), ('F', true), ('P', false), ('X', true)) s(source, ok) LEFT JOIN c USING (source)""")
def snapshot_diff_summary(t: Tables):
    """Counts by source; the source P was read in part on one side, so it isn't compared, and X has no rows."""
    before, after = snapshots(t)
    whole = t.rows([("O", "ok"), ("F", "ok"), ("P", "ok"), ("X", "ok")], "source string, status string")
    part = t.rows([("O", "ok"), ("F", "ok"), ("P", "partial"), ("X", "ok")], "source string, status string")
    sources = part.select("source", (F.col("status") == "ok").alias("comparable"))
    return D.diff_summary(D.bag_diff(*D.comparable(before, after, whole, part)), sources)


@query("T02", f"""WITH {SNAPSHOTS}, n AS (SELECT source, doc FROM a0 WHERE source <> 'P' UNION ALL SELECT source, doc FROM b0 WHERE source = 'P') SELECT source, count(*) AS k, sha256(string_agg(doc, '|' ORDER BY doc)) AS digest FROM n GROUP BY 1""")
def watch_baseline(t: Tables):
    """The baseline after a watch in which the source P was read in part: P keeps its old rows."""
    before, after = snapshots(t)
    whole = t.rows([("O", "ok"), ("F", "ok"), ("P", "ok")], "source string, status string")
    part = t.rows([("O", "ok"), ("F", "ok"), ("P", "partial")], "source string, status string")
    rows = D.next_baseline(before, after, whole, part)
    return rows.groupBy("source").agg(F.count("*").alias("k"), F.sha2(F.array_join(F.array_sort(F.collect_list("full")), "|"), 256).alias("digest"))


@query("T03", f"WITH {SNAPSHOTS} SELECT source, key, change_type || ': ' || coalesce(before, '-') || ' -> ' || coalesce(after, '-') AS description FROM changes")
def change_feed(t: Tables):
    text = F.concat(F.col("change_type"), F.lit(": "), F.coalesce("before", F.lit("-")), F.lit(" -> "), F.coalesce("after", F.lit("-")))
    return D.described(D.bag_diff(*snapshots(t)), text).select("source", "key", "description")


@query("R02", "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1")
def keep_first(t: Tables):
    return K.keep_one(t.events, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id", "value")


@query("R04", "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def keep_last(t: Tables):
    best = t.events.groupBy("user_id", "event_type").agg(F.max_by(F.struct("event_id", "value"), F.struct("ts", "event_id")).alias("x"))
    return best.select("user_id", "event_type", "x.event_id", "x.value")


@query("R01", """WITH u AS (SELECT p_name AS id, p_brand AS tag, p_partkey AS pos FROM part UNION ALL SELECT p_name, p_type, p_partkey + 1000000 FROM part)
SELECT id, array_to_string(list_sort(list_distinct(list(tag))), ',') AS tags, CAST(min(pos) AS BIGINT) AS pos FROM u GROUP BY 1""")
def merge_union(t: Tables):
    """Two feeds of names, their tags merged."""
    feed = lambda c, add: t.part.select(F.col("p_name").alias("id"), F.array(c).alias("tags"), (F.col("p_partkey") + add).alias("pos"), (F.col("p_partkey") + add).alias("n"))
    merged = K.merge_union([feed("p_brand", 0), feed("p_type", 1000000)], "id", "tags", "n")
    return merged.select("id", F.array_join(F.array_sort("tags"), ",").alias("tags"), "pos")


@query("R05", "SELECT p_brand AS brand, p_partkey AS id FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_size = 1 THEN 0 ELSE 1 END, p_partkey) AS n FROM part) WHERE n = 1")
def exact_first(t: Tables):
    parts = t.part.select(F.col("p_brand").alias("brand"), F.col("p_partkey").alias("id"), "p_size")
    return K.prepend(parts, parts.where("p_size = 1"), "brand", "id").select("brand", "id")


@query("R07 R06 Y05", "SELECT c_custkey AS id, array_to_string(list_sort(list_filter(list_distinct([c_mktsegment, 'BASE', upper(left(c_name, 4))]), lambda x: x <> 'BUILDING')), ',') AS plan FROM customer")
def plan_codes(t: Tables):
    """Plan entries: added to, less what was removed."""
    own = F.array_union(F.array("c_mktsegment"), F.array(F.lit("BASE"), F.upper(F.substring("c_name", 1, 4))))
    return t.customer.select(F.col("c_custkey").alias("id"), F.array_join(F.array_sort(F.array_except(S.distinct_texts(own), F.array(F.lit("BUILDING")))), ",").alias("plan"))


@query("A13 A14 R08", """WITH b AS (SELECT o_custkey AS bundle, o_orderkey % 4 AS component, o_orderkey % 3 = 0 AS bears, o_orderkey % 5 AS credits, o_orderkey AS k FROM orders),
c AS (SELECT bundle, component, max(CASE WHEN bears THEN 1 ELSE 0 END) AS bears, arg_min(credits, k) AS credits FROM b GROUP BY ALL)
SELECT bundle, count(*) AS components, string_agg(CAST(component AS VARCHAR), ',' ORDER BY component) AS listing,
  CASE WHEN sum(bears) = 1 THEN CAST(max(CASE WHEN bears = 1 THEN credits END) AS BIGINT) WHEN sum(bears) > 1 THEN NULL WHEN count(DISTINCT CASE WHEN credits > 0 THEN credits END) > 1 THEN NULL
    ELSE CAST(coalesce(max(CASE WHEN credits > 0 THEN credits END), 0) AS BIGINT) END AS credits,
  sum(bears) > 1 OR (sum(bears) = 0 AND count(DISTINCT CASE WHEN credits > 0 THEN credits END) > 1) AS ambiguous FROM c GROUP BY 1""")
def bundle_rollup(t: Tables):
    """Bundles of components; one bearer gives the credits, several are ambiguous, else the only positive value counts."""
    k = F.col("o_orderkey")
    rows = t.orders.select(F.col("o_custkey").alias("bundle"), (k % 4).alias("component"), (k % 3 == 0).alias("bears"), (k % 5).alias("credits"), k.alias("k"))
    parts = rows.groupBy("bundle", "component").agg(F.max("bears").alias("bears"), F.min_by("credits", "k").alias("credits"))
    n, values = F.count_if("bears"), F.countDistinct(F.when(F.col("credits") > 0, F.col("credits")))
    credits = F.when(n == 1, F.max(F.when(F.col("bears"), F.col("credits")))).when((n > 1) | (values > 1), F.lit(None)).otherwise(F.coalesce(F.max(F.when(F.col("credits") > 0, F.col("credits"))), F.lit(0)))
    return parts.groupBy("bundle").agg(F.count("*").alias("components"), F.array_join(F.array_sort(F.collect_list("component")), ",").alias("listing"), credits.alias("credits"), ((n > 1) | ((n == 0) & (values > 1))).alias("ambiguous"))


@query("A19 A20", """WITH s AS (SELECT o_custkey AS owner, o_orderkey % 6 AS item, arg_max(o_orderkey % 40, o_orderkey) AS bid FROM orders GROUP BY ALL),
p AS (SELECT owner, item, bid, CASE WHEN item < 2 THEN 25 END AS new FROM s)
SELECT owner, CAST(sum(bid) AS BIGINT) AS now, CAST(sum(coalesce(new, bid)) AS BIGINT) AS projected, sum(coalesce(new, bid)) > 100 AS over_limit FROM p GROUP BY 1""")
def bid_projection(t: Tables):
    """Last bids by item, with two picks replaced."""
    k = F.col("o_orderkey")
    last = t.orders.groupBy(F.col("o_custkey").alias("owner"), (k % 6).alias("item")).agg(F.max_by(k % 40, k).alias("bid"))
    picks = F.broadcast(t.rows([(0, 25), (1, 25)], "item long, new long"))
    both = last.join(picks, "item", "left").withColumn("then", F.coalesce("new", "bid"))
    return both.groupBy("owner").agg(F.sum("bid").alias("now"), F.sum("then").alias("projected"), (F.sum("then") > 100).alias("over_limit"))


@query("A24", """SELECT o_custkey AS target, CASE WHEN count(CASE WHEN o_orderstatus = 'P' THEN 1 END) > 0 THEN 'still_uncertain' WHEN arg_max(o_orderstatus, o_orderkey) = 'O' THEN 'applied'
  WHEN count(CASE WHEN o_orderstatus = 'F' THEN 1 END) >= 2 AND count(CASE WHEN o_orderstatus = 'O' THEN 1 END) = 0 THEN 'not_applied' ELSE 'still_uncertain' END AS verdict FROM orders GROUP BY 1""")
def reconciliation(t: Tables):
    """Verdict over a sequence of observations."""
    s = F.col("o_orderstatus")
    last = F.when(F.max_by(s, "o_orderkey") == "O", "desired")
    return t.orders.groupBy(F.col("o_custkey").alias("target")).agg(X.reconciled(F.count_if(s == "P"), last, F.count_if(s == "O"), F.count_if(s == "F")).alias("verdict"))


@query("J43", """WITH w AS (SELECT 'labels' AS source, count(*) AS n FROM labels UNION ALL SELECT 'pages', count(*) FROM pages UNION ALL SELECT 'parts', count(*) FROM part WHERE p_size > 1000)
SELECT r.source, coalesce(n, 0) AS items, CASE WHEN n IS NULL THEN 'error' WHEN n = 0 THEN 'empty' ELSE 'ok' END AS status FROM (VALUES ('labels'), ('pages'), ('parts'), ('mail')) r(source) LEFT JOIN w USING (source)""")
def source_status(t: Tables):
    """Status of each wanted source, kept beside its rows: missing ones count as errors."""
    count = lambda df, name: df.agg(F.lit(name).alias("source"), F.count("*").alias("n"))
    got = count(t.labels, "labels").unionByName(count(t.pages, "pages")).unionByName(count(t.part.where("p_size > 1000"), "parts"))
    want = t.rows([("labels",), ("pages",), ("parts",), ("mail",)], "source string")
    return want.join(got, "source", "left").select("source", F.coalesce("n", F.lit(0)).alias("items"), F.when(F.col("n").isNull(), "error").when(F.col("n") == 0, "empty").otherwise("ok").alias("status"))


@query("A27", "SELECT p_brand AS brand, 'small' AS field, CAST(sum(CASE WHEN p_size < 10 THEN 1 ELSE 0 END) AS BIGINT) AS k FROM part GROUP BY 1 UNION ALL SELECT p_brand, 'large', CAST(sum(CASE WHEN p_size >= 40 THEN 1 ELSE 0 END) AS BIGINT) FROM part GROUP BY 1")
def population_counts(t: Tables):
    """Named counters, one row each."""
    wide = t.part.groupBy(F.col("p_brand").alias("brand")).agg(F.count_if(F.col("p_size") < 10).alias("small"), F.count_if(F.col("p_size") >= 40).alias("large"))
    return wide.unpivot(["brand"], ["small", "large"], "field", "k")


@query("A30 X14", """SELECT p_brand AS brand, CAST(count(*) AS BIGINT) AS k, CAST(sum(p_size) AS BIGINT) AS total, rank() OVER (ORDER BY sum(p_size) DESC) AS place,
  CASE WHEN least(100, max(p_size) * 2) <= 33 THEN 'Low' WHEN least(100, max(p_size) * 2) <= 67 THEN 'Average' ELSE 'High' END AS label FROM part GROUP BY 1""")
def rankings(t: Tables):
    """Statistics and a ranking by brand (a row a brand is ranked)."""
    sums = t.part.groupBy(F.col("p_brand").alias("brand")).agg(F.count("*").alias("k"), F.sum("p_size").alias("total"), X.score_label(F.max("p_size") * 2).alias("label"))
    return sums.withColumn("place", F.rank().over(Window.orderBy(F.col("total").desc())).cast("long"))


@query("X05 X06 X07 X08 X09 X10 X11", """WITH v AS (SELECT p_partkey AS id, p_size AS capacity, p_partkey % 53 AS enrolled, CAST(p_partkey % 100 AS DOUBLE) / 10 AS rating, CAST(p_partkey % 101 AS DOUBLE) AS pct, p_partkey % 30 AS n,
  p_partkey % 4 = 0 AS planned, p_partkey % 5 AS conflicts FROM part),
w AS (SELECT *, CASE WHEN n > 0 THEN 0.75 * greatest(0.25, least(1.0, n / 20)) ELSE 0 END AS wt FROM v),
s AS (SELECT *, CASE WHEN capacity - enrolled <= 0 THEN -18 WHEN capacity - enrolled <= 2 THEN -6 WHEN capacity - enrolled >= capacity * 0.25 THEN 4 ELSE 0 END AS cs,
  CASE WHEN planned THEN 18 ELSE 0 END - least(24, 8 * conflicts) + CASE WHEN conflicts = 0 THEN 12 ELSE -18 END AS ps,
  CASE id % 3 WHEN 0 THEN 28 WHEN 1 THEN 22 ELSE -16 END + CASE WHEN id % 7 > 3 THEN 4 ELSE 0 END AS ds, floor(((rating - 7) * 4 * wt + (pct - 50) / 25 * wt) * 100 + 0.5) / 100 AS rs FROM w)
SELECT id, CAST(cs + ps + ds AS BIGINT) AS base, rs AS review, CASE WHEN conflicts > 3 OR cs + ps + ds + rs < 0 THEN 'avoid' WHEN cs + ps + ds + rs >= 34 THEN 'strong' WHEN cs + ps + ds + rs >= 18 THEN 'recommend' ELSE 'consider' END AS verdict FROM s""")
def decision_score(t: Tables):
    """Evidence for and against each candidate, summed into a verdict."""
    k = F.col("p_partkey")
    capacity = X.capacity_score(F.col("p_size"), k % 53)
    weight = X.evidence_weight(F.lit("medium"), k % 30)
    review = X.review_score((k % 100).cast("double") / 10, (k % 101).cast("double"), weight)
    plan = X.plan_score(k % 4 == 0, k % 5, k % 5 == 0)
    degree = X.degree_score(F.when(k % 3 == 0, "missing_required").when(k % 3 == 1, "choice_gap").otherwise("passed"), F.when(k % 7 > 3, 1).otherwise(0))
    out = t.part.select(k.alias("id"), (capacity + plan + degree).cast("long").alias("base"), review.alias("review"), (k % 5 > 3).alias("blocked"))
    return out.select("id", "base", "review", X.verdict(F.col("base") + F.col("review"), F.col("blocked"), F.lit(True)).alias("verdict"))


@query("J13 X13 C09 C11 R12", """WITH c AS (SELECT p_partkey AS id, upper(replace(p_brand, '#', '')) AS code, p_name AS name, p_size AS term FROM part),
l AS (SELECT s_suppkey AS q, 'BRAND' || (s_suppkey % 5 + 1) || (s_suppkey % 4 + 1) AS code, s_suppkey % 50 + 1 AS term FROM supplier),
j AS (SELECT q, id, CASE WHEN c.term = l.term THEN 2 ELSE 0 END + 1 AS points FROM l JOIN c ON c.code = l.code),
b AS (SELECT q, id, points, row_number() OVER (PARTITION BY q ORDER BY points DESC, id) AS n, count(*) OVER (PARTITION BY q) AS candidates, count(CASE WHEN points = 3 THEN 1 END) OVER (PARTITION BY q) AS exact FROM j)
SELECT l.q, b.id, coalesce(candidates, 0) AS candidates, CASE WHEN id IS NULL THEN 'none' WHEN exact = 1 THEN 'resolved' ELSE 'ambiguous' END AS status,
  CASE WHEN id IS NULL THEN 'none' WHEN exact > 0 OR candidates = 1 THEN 'high' WHEN candidates <= 3 THEN 'medium' ELSE 'low' END AS confidence FROM l LEFT JOIN b ON l.q = b.q AND n = 1""")
def entity_resolution(t: Tables):
    """Lookups by code, with the term as a signal: the best candidate, its status and confidence."""
    cand = t.part.select(F.col("p_partkey").alias("id"), S.plain_code(F.replace("p_brand", F.lit("#"), F.lit(""))).alias("code"), F.col("p_size").alias("term"))
    k = F.col("s_suppkey")
    looks = t.supplier.select(k.alias("q"), F.concat(F.lit("BRAND"), (k % 5 + 1).cast("string"), (k % 4 + 1).cast("string")).alias("code"), (k % 50 + 1).alias("want"))
    met = looks.join(cand, "code", "left").withColumn("points", F.when(F.col("id").isNotNull(), F.when(F.col("term") == F.col("want"), 3).otherwise(1)))
    best = met.groupBy("q").agg(F.max_by("id", F.struct("points", -F.col("id"))).alias("id"), F.count("id").alias("candidates"), F.count_if(F.col("points") == 3).alias("exact"))
    none, sole = F.col("id").isNull(), F.col("exact") == 1
    sure = X.lookup_confidence(~none, F.lit(False), F.lit(False), F.lit(0), F.col("exact") > 0, F.col("candidates"))
    return best.select("q", "id", "candidates", F.when(none, "none").when(sole, "resolved").otherwise("ambiguous").alias("status"), sure.alias("confidence"))


@query("J37", """SELECT c_custkey AS id, CASE WHEN n IS NULL THEN 'not_observed' WHEN n = 1 THEN 'confirmed' ELSE 'ambiguous' END AS outcome FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders ANTI JOIN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') r ON o_orderkey = l_orderkey GROUP BY 1) x ON c_custkey = o_custkey""")
def new_row_detection(t: Tables):
    """Rows that weren't there before, by owner: one confirms, more are ambiguous."""
    new = t.orders.join(t.lineitem.where("l_returnflag = 'R'").select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("n"))
    return t.customer.select(F.col("c_custkey").alias("id")).join(new, "id", "left").select("id", F.when(F.col("n").isNull(), "not_observed").when(F.col("n") == 1, "confirmed").otherwise("ambiguous").alias("outcome"))


@query("J29", """SELECT c_custkey AS id, coalesce(s_name, 'unlisted ' || c_name) AS label, greatest(CAST(c_nationkey AS BIGINT) - coalesce(s_suppkey, 0), 0) AS remaining FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""")
def fallback_rows(t: Tables):
    """A left join whose missing side is filled by a fallback."""
    return t.customer.join(t.supplier, F.col("c_custkey") == F.col("s_suppkey"), "left").select(F.col("c_custkey").alias("id"), F.coalesce("s_name", F.concat(F.lit("unlisted "), "c_name")).alias("label"), F.greatest(F.col("c_nationkey") - F.coalesce("s_suppkey", F.lit(0)), F.lit(0)).cast("long").alias("remaining"))


@query("", """WITH sel(pos, brand) AS (VALUES (0, 'Brand#11'), (1, 'Brand#99'), (2, 'Brand#23'), (3, 'Brand#11'))
SELECT pos, brand, coalesce(k, 0) AS matched, min(pos) OVER (PARTITION BY brand) = pos AS first_selector FROM sel LEFT JOIN (SELECT p_brand, count(*) AS k FROM part GROUP BY 1) ON p_brand = brand""")
def selectors(t: Tables):
    """Selectors with how many rows each finds; of equal ones the first counts."""
    sel = t.rows([(0, "Brand#11"), (1, "Brand#99"), (2, "Brand#23"), (3, "Brand#11")], "pos int, brand string")
    counts = t.part.groupBy(F.col("p_brand").alias("brand")).agg(F.count("*").alias("matched"))
    return sel.join(counts, "brand", "left").select("pos", "brand", F.coalesce("matched", F.lit(0)).alias("matched"), (F.min("pos").over(Window.partitionBy("brand")) == F.col("pos")).alias("first_selector"))


@query("S24", "SELECT r_name AS region, n_name AS nation FROM nation JOIN region ON n_regionkey = r_regionkey WHERE lower(r_name) LIKE '%a%'")
def registry_scan(t: Tables):
    """A small registry, filtered by substring and joined by key."""
    return t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey")).where(F.lower("r_name").contains("a")).select(F.col("r_name").alias("region"), F.col("n_name").alias("nation"))


@query("O01 W08", "SELECT c_custkey AS id, c_acctbal AS balance, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20")
def top_balances(t: Tables):
    """The twenty highest balances, numbered."""
    order = [F.col("balance").desc(), F.col("id")]
    top = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance")).orderBy(*order).limit(20)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("long"))


@query("O08 O09 T09", "SELECT o_orderkey AS id, o_totalprice AS price, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS total, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') > 150 AS has_more FROM orders WHERE o_orderstatus = 'O' ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100")
def paged_orders(t: Tables):
    """The third page of open orders by price."""
    rows = t.orders.where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    return K.paged(rows, [F.col("price").desc(), F.col("id")], 3, 50)


@query("O04 O05 O07 O12 O15", "SELECT l_returnflag AS flag, o_orderkey AS id, row_number() OVER (PARTITION BY l_returnflag ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS place FROM (SELECT DISTINCT l_returnflag, o_orderkey, o_totalprice FROM orders JOIN lineitem ON o_orderkey = l_orderkey)")
def sorted_by_spec(t: Tables):
    """Places by a client's sort specification."""
    rows = t.orders.join(t.lineitem.select("l_orderkey", "l_returnflag").distinct(), F.col("o_orderkey") == F.col("l_orderkey"))
    order = K.sort_by(rows, "price(desc)", {"price": ["o_totalprice", F.col("o_orderkey")], "id": ["o_orderkey"]})
    return rows.select(F.col("l_returnflag").alias("flag"), F.col("o_orderkey").alias("id"), F.row_number().over(Window.partitionBy("l_returnflag").orderBy(*order)).cast("long").alias("place"))


@query("O06 F05", """SELECT o_orderkey AS id, CASE WHEN o_orderdate > TIMESTAMP '1996-06-01' THEN 'upcoming' ELSE 'started' END AS timing,
  row_number() OVER (ORDER BY CASE WHEN o_orderdate > TIMESTAMP '1996-06-01' THEN 0 ELSE 1 END, CASE WHEN o_orderdate > TIMESTAMP '1996-06-01' THEN epoch(o_orderdate) ELSE -epoch(o_orderdate) END, o_orderkey) AS place FROM orders
QUALIFY place <= 100""")
def timing_rank_sort(t: Tables):
    """What is to come first, soonest first; then what has started, latest first."""
    now = F.lit("1996-06-01").cast("timestamp")
    up = F.col("o_orderdate") > now
    at = F.unix_timestamp("o_orderdate")
    order = [F.when(up, 0).otherwise(1), F.when(up, at).otherwise(-at), F.col("o_orderkey")]
    top = t.orders.orderBy(*order).limit(100)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("long")).select(F.col("o_orderkey").alias("id"), F.when(up, "upcoming").otherwise("started").alias("timing"), "place")
