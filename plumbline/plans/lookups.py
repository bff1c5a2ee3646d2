"""Queries on lookups of rooms, records and courses, and on what is live of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import scalars as S
from plumbline.operators import intervals, lookup
from plumbline.operators import rank as X
from plumbline.plans.adapters import MEETINGS, meetings
from plumbline.plans.catalog import Tables, query

_ROOMS = "rm AS (SELECT DISTINCT room AS code, 'Hall ' || room AS label FROM meetings)"


def _rooms(t: Tables) -> DataFrame:
    return meetings(t).select("room").distinct().select(F.col("room").cast("string").alias("code"), F.concat(F.lit("Hall "), F.col("room").cast("string")).alias("label"))


_ASKED = "q AS (SELECT event_id AS id, CASE event_id % 4 WHEN 0 THEN 'HALL ' || event_id % 230 WHEN 1 THEN ' ' || event_id % 230 || ' ' WHEN 2 THEN 'all 1' || event_id % 19 ELSE 'hall' END AS query, ts FROM events)"


def _asked(t: Tables) -> DataFrame:
    k = F.col("event_id")
    number = (k % 230).cast("string")
    query_ = F.when(k % 4 == 0, F.concat(F.lit("HALL "), number)).when(k % 4 == 1, F.concat(F.lit(" "), number, F.lit(" "))).when(k % 4 == 2, F.concat(F.lit("all 1"), (k % 19).cast("string"))).otherwise("hall")
    return t.events.select(k.alias("id"), query_.alias("query"), "ts")


_RESOLVED = f"""{MEETINGS}, {_ROOMS}, {_ASKED}, u AS (SELECT DISTINCT query FROM q),
met AS (SELECT query, CAST(code AS VARCHAR) AS code, CASE WHEN CAST(code AS VARCHAR) = trim(lower(query)) OR lower(label) = trim(lower(query)) THEN 0 ELSE 1 END AS rnk FROM u JOIN rm ON CAST(code AS VARCHAR) = trim(lower(query)) OR contains(lower(label), trim(lower(query)))),
per AS (SELECT query, rnk, count(*) AS n, min(code) AS code FROM met GROUP BY query, rnk), best AS (SELECT * FROM per QUALIFY row_number() OVER (PARTITION BY query ORDER BY rnk) = 1),
found AS (SELECT id, ts, q.query, CASE WHEN n = 1 THEN code END AS code, coalesce(n, 0) AS matches, CASE WHEN n IS NULL THEN 'missing' WHEN n = 1 THEN 'found' ELSE 'ambiguous' END AS status FROM q LEFT JOIN best USING (query))"""


@query("F15", f"WITH {_RESOLVED} SELECT id, code, matches, status FROM found")
def resolve_rooms(t: Tables):
    """Rooms by code or name, else by a part of the name."""
    return lookup.resolve(_asked(t), _rooms(t)).select("id", "code", "matches", "status")


_PERIOD_SQL = "p(period, s) AS (VALUES " + ", ".join(f"({i}, {m})" for i, m in enumerate(S.OLD_PERIODS, 1)) + ")"


@query("J44 F15 J20 J07", f"""WITH {_RESOLVED}, {_PERIOD_SQL}, a AS (SELECT id, CAST(code AS INT) AS room, isodow(ts) AS day, CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7.0) + 1 AS INT) AS week, hour(ts) * 60 + minute(ts) AS m FROM found WHERE status = 'found'),
n AS (SELECT a.*, period FROM a JOIN p ON m >= s AND m < s + 50)
SELECT id, n.room, period, s.section FROM n JOIN slots s ON s.room = n.room AND s.day = n.day AND s.week = n.week AND s.ps <= period AND s.pe >= period""")
def room_now(t: Tables):
    """What is on in the room that was asked for: the room by name, the instant as a period, the meetings of both."""
    found = lookup.resolve(_asked(t), _rooms(t)).where("status = 'found'")
    periods = t.rows([(i, m, m + S.PERIOD_MINUTES) for i, m in enumerate(S.OLD_PERIODS, 1)], "period int, lo int, hi int")
    at = found.select("id", F.col("code").cast("int").alias("room"), (F.weekday("ts") + 1).alias("day"), (F.floor(F.datediff("ts", F.lit("2024-01-01")) / 7) + 1).cast("int").alias("week"), (F.hour("ts") * 60 + F.minute("ts")).alias("m"))
    now = intervals.range_lookup(at, "id", periods, F.col("m"), "lo", "hi", ["lo"], half_open=True).where("period is not null").select("id", "room", "day", "week", "period")
    return intervals.slots_at(now, meetings(t), ("room", "day")).select("id", "room", "period", "section")


@query("F16 F20", """WITH r AS (SELECT p_brand || '-' || p_partkey AS id, p_type || '/' || p_partkey % 60 AS path, p_name AS title FROM part),
q AS (SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'Brand#13-' || o_orderkey % 50 WHEN 1 THEN 'ECONOMY/' || o_orderkey % 90 WHEN 2 THEN 'cold widget' ELSE ' nothing ' END AS query FROM orders),
m AS (SELECT DISTINCT trim(query) AS x FROM q), s AS (SELECT x, 0 AS rnk, 'id' AS by_, min(id) AS record, count(*) AS k FROM m JOIN r ON id = x GROUP BY x UNION ALL SELECT x, 1, 'path', min(id), count(*) FROM m JOIN r ON path = x GROUP BY x UNION ALL SELECT x, 2, 'title', min(id), count(*) FROM m JOIN r ON title = x GROUP BY x),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY x ORDER BY rnk) = 1)
SELECT q.id, CASE WHEN by_ = 'title' AND k > 1 THEN NULL ELSE record END AS record, by_ AS found_by, CASE WHEN by_ IS NULL THEN 'missing' WHEN by_ = 'title' AND k > 1 THEN 'ambiguous' ELSE 'found' END AS status FROM q LEFT JOIN b ON trim(query) = x""")
def record_lookup(t: Tables):
    """Records by id, else by path, else by a title that no other has."""
    k = F.col("o_orderkey")
    asked = F.when(k % 4 == 0, F.concat(F.lit("Brand#13-"), (k % 50).cast("string"))).when(k % 4 == 1, F.concat(F.lit("ECONOMY/"), (k % 90).cast("string"))).when(k % 4 == 2, "cold widget").otherwise(" nothing ")
    p = F.col("p_partkey")
    records = t.part.select(F.concat_ws("-", "p_brand", p.cast("string")).alias("id"), F.concat_ws("/", "p_type", (p % 60).cast("string")).alias("path"), F.col("p_name").alias("title"))
    return lookup.cascade(t.orders.select(k.alias("id"), asked.alias("query")), records).select("id", "record", F.col("by").alias("found_by"), "status")


_COURSES = """c AS (SELECT p_partkey AS id, upper(replace(CASE p_partkey % 4 WHEN 0 THEN 'cs-' || p_size WHEN 1 THEN 'CS' || p_size || 'A' WHEN 2 THEN 'CS ' || p_size || 'b2' ELSE 'EE' || p_size END, '-', '')) AS raw, lower(replace(p_name, ' ', '')) AS name,
  [lower(p_brand), 'prof ' || p_partkey % 40] AS teachers, ['T' || p_partkey % 3, 'T' || p_partkey % 5] AS terms, p_size AS reviews, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST(p_partkey % 10 AS DOUBLE) END AS rating FROM part),
l AS (SELECT s_suppkey AS q, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'CS' || s_suppkey % 60 END AS code, CASE WHEN s_suppkey % 3 = 0 THEN 'coldwidget' ELSE '' END AS name, ['prof ' || s_suppkey % 60] AS teachers, 'T' || s_suppkey % 4 AS term FROM supplier),
m AS (SELECT q, id, replace(raw, ' ', '') = code AND code <> '' AS exact, code <> '' AND starts_with(replace(raw, ' ', ''), code) AND regexp_matches(substr(replace(raw, ' ', ''), length(code) + 1), '^[A-Z][A-Z0-9]*$') AS base, l.name <> '' AND l.name = c.name AS named,
  len(list_filter(l.teachers, lambda x: list_bool_or([x = y OR contains(x, y) OR contains(y, x) FOR y IN c.teachers]))) AS shared, list_contains(terms, term) AS in_term, reviews, coalesce(rating, -1) AS rating FROM l JOIN c ON true),
k AS (SELECT *, count(*) OVER (PARTITION BY q) AS matches, row_number() OVER (PARTITION BY q ORDER BY shared > 0 DESC, exact DESC, base DESC, named DESC, shared DESC, in_term DESC, reviews DESC, rating DESC, id) AS place FROM m WHERE exact OR base OR named),
b AS (SELECT q, id AS picked, matches, CASE WHEN exact AND (shared > 0 OR in_term OR matches = 1) THEN 'high' WHEN (exact AND matches <= 3) OR ((base OR named) AND shared > 0) THEN 'medium' ELSE 'low' END AS confidence FROM k WHERE place = 1)
SELECT l.q, picked, coalesce(matches, 0) AS matches, coalesce(confidence, 'none') AS confidence, CASE WHEN picked IS NULL THEN 'not_found' WHEN confidence = 'low' AND matches > 1 THEN 'ambiguous' ELSE 'matched' END AS status FROM l LEFT JOIN b USING (q)"""


@query("J26 J27 X12 X13 C09 C11", f"WITH {_COURSES}")
def course_lookup(t: Tables):
    """Courses by code, base code or name, with teachers and term as evidence."""
    p, k = F.col("p_partkey"), F.col("s_suppkey")
    size = F.col("p_size").cast("string")
    code = F.when(p % 4 == 0, F.concat(F.lit("cs-"), size)).when(p % 4 == 1, F.concat(F.lit("CS"), size, F.lit("A"))).when(p % 4 == 2, F.concat(F.lit("CS "), size, F.lit("b2"))).otherwise(F.concat(F.lit("EE"), size))
    tagged = lambda name, n: F.concat(F.lit(name), n.cast("string"))
    candidates = t.part.select(p.alias("id"), code.alias("code"), F.col("p_name").alias("name"), F.array(F.lower("p_brand"), tagged("prof ", p % 40)).alias("teachers"), F.array(tagged("T", p % 3), tagged("T", p % 5)).alias("terms"), F.col("p_size").alias("reviews"), F.when(p % 6 != 0, (p % 10).cast("double")).alias("rating"), tagged("u", p).alias("url"))
    asked = t.supplier.select(k.alias("q"), F.when(k % 5 == 0, "").otherwise(tagged("CS", k % 60)).alias("code"), F.when(k % 3 == 0, "Cold (widget)").alias("name"), F.array(tagged("prof ", k % 60)).alias("teachers"), tagged("T", k % 4).alias("term"))
    return lookup.match_courses(asked, candidates)


@query("J15 W10", """WITH s(pos, selector) AS (VALUES (0, 'Brand#13'), (1, 'cold'), (2, 'Brand#99'), (3, 'Brand#13'), (4, 'nowhere')), m AS (SELECT p_partkey AS id, min(pos) AS pos FROM part JOIN s ON p_brand = selector OR contains(p_name, selector) GROUP BY 1)
SELECT id, CAST(pos AS INT) AS pos, CAST(NULL AS VARCHAR) AS missed FROM m UNION ALL SELECT NULL, CAST(pos AS INT), selector FROM s WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_brand = selector OR contains(p_name, selector))""")
def selector_matches(t: Tables):
    """Rows at the first selector that fits, and the selectors that fit nothing."""
    selectors = t.rows([(0, "Brand#13"), (1, "cold"), (2, "Brand#99"), (3, "Brand#13"), (4, "nowhere")], "pos int, selector string")
    on = (F.col("p_brand") == F.col("selector")) | F.col("p_name").contains(F.col("selector"))
    first, missed = lookup.by_selectors(t.part, selectors, on, "p_partkey", "p_size")
    return first.select(F.col("p_partkey").alias("id"), "pos", F.lit(None).cast("string").alias("missed")).unionByName(missed.select(F.lit(None).cast("long").alias("id"), "pos", F.col("selector").alias("missed")))


@query("J35", """WITH a AS (SELECT l_orderkey AS task, min(l_linestatus) AS kind FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1), e AS (SELECT l_orderkey AS task, min(l_linestatus) AS kind FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1), c AS (SELECT l_orderkey AS task, min(CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE 'cart' END) AS kind FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT o_orderkey AS task, coalesce(nullif(CASE WHEN a.task IS NOT NULL THEN a.kind WHEN e.task IS NOT NULL THEN e.kind ELSE c.kind END, ''), o_orderstatus) AS kind, CASE WHEN a.task IS NOT NULL THEN 'available' WHEN e.task IS NOT NULL THEN 'enrolled' WHEN c.task IS NOT NULL THEN 'cart' END AS live
FROM orders LEFT JOIN a ON a.task = o_orderkey LEFT JOIN e ON e.task = o_orderkey LEFT JOIN c ON c.task = o_orderkey""")
def live_tasks(t: Tables):
    """Fields of tasks as they are live: of the available row first, then of the enrolled one, then of the cart."""
    part = lambda flag, kind: t.lineitem.where(F.col("l_returnflag") == flag).select(F.col("l_orderkey").alias("task"), kind.alias("kind"))
    tasks = t.orders.select(F.col("o_orderkey").alias("task"), F.col("o_orderstatus").alias("kind"))
    return lookup.live_state(tasks, part("N", F.col("l_linestatus")), part("A", F.col("l_linestatus")), part("R", F.when(F.col("l_linenumber") % 2 == 0, "").otherwise("cart")), ["kind"])


@query("J41 P15", """WITH s AS (SELECT s_suppkey AS line, s_suppkey % 3 AS route, [CASE s_suppkey % 4 WHEN 0 THEN 'x/one_a' WHEN 1 THEN 'x/two_a' ELSE 'x/plain' END, CASE s_suppkey % 5 WHEN 0 THEN 'y/short_up' WHEN 1 THEN 'y/short_down' ELSE 'y/z' END] AS urls,
  [CASE WHEN s_suppkey % 2 = 0 THEN 'walk' ELSE 'bus' END, CASE WHEN s_suppkey % 7 = 0 THEN 'walk' ELSE 'bus' END] AS kinds FROM supplier),
d AS (SELECT *, CASE WHEN s.line % 5 = 0 THEN 1 WHEN s.line % 5 = 1 THEN 0 WHEN s.line % 4 = 0 THEN 0 WHEN s.line % 4 = 1 THEN 1 END AS told FROM s)
SELECT line, route, CASE WHEN kinds[1] = 'bus' THEN urls[1] WHEN kinds[2] = 'bus' THEN urls[2] ELSE urls[1] END AS url, CASE told WHEN 0 THEN 'XYBS1' WHEN 1 THEN 'XYBS2' ELSE '' END AS line_code, CAST(coalesce(told, 0) AS INT) AS direction FROM d""")
def bus_sources(t: Tables):
    """The source of each route's times, and its line and direction by the last url that tells them."""
    k = F.col("s_suppkey")
    first = F.struct(F.when(k % 4 == 0, "x/one_a").when(k % 4 == 1, "x/two_a").otherwise("x/plain").alias("url"), F.when(k % 2 == 0, "walk").otherwise("bus").alias("type"))
    second = F.struct(F.when(k % 5 == 0, "y/short_up").when(k % 5 == 1, "y/short_down").otherwise("y/z").alias("url"), F.when(k % 7 == 0, "walk").otherwise("bus").alias("type"))
    return lookup.preferred_source(t.supplier.select(k.alias("line"), (k % 3).alias("route"), F.array(first, second).alias("sources")))


@query("J12", "SELECT p_partkey AS id, CASE WHEN s_suppkey IS NULL THEN 'not_provided' ELSE 'provided' END AS evidence, s_acctbal AS rating FROM part LEFT JOIN supplier ON p_partkey % 150 = s_suppkey")
def evidence_map(t: Tables):
    """Evidence for each candidate from a lookup; what the lookup lacks is told from what it has as nothing."""
    rows = t.part.select(F.col("p_partkey").alias("id"), (F.col("p_partkey") % 150).alias("key"))
    have = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("rating"), F.lit(True).alias("there"))
    return rows.join(have, "key", "left").select("id", F.when(F.col("there"), "provided").otherwise("not_provided").alias("evidence"), "rating")


@query("O03 W08", """WITH d AS (SELECT p_partkey AS id, p_brand AS brand, p_partkey % 9 - 2 AS total, p_partkey % 4 = 0 AS requested, CASE p_size % 5 WHEN 0 THEN 4 WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 1 ELSE 0 END AS degree, CASE WHEN p_size % 7 = 0 THEN -1 ELSE p_size % 11 END AS seats, CASE WHEN p_size % 3 = 0 THEN -1 ELSE p_size % 8 END AS rating FROM part)
SELECT id, brand, row_number() OVER (PARTITION BY brand ORDER BY total DESC, requested DESC, degree DESC, seats DESC, rating DESC, id) AS place FROM d""")
def decision_order(t: Tables):
    """Decisions in order: score, requested, state of the degree, seats, rating, identity."""
    p, size = F.col("p_partkey"), F.col("p_size")
    state = F.get(F.array(*[F.lit(x) for x in ("required-gap", "choice-gap", "optional", "unknown", "none")]), (size % 5).cast("int"))
    rows = t.part.select(p.alias("id"), F.col("p_brand").alias("brand"), (p % 9 - 2).alias("total"), (p % 4 == 0).alias("requested"), state.alias("degree_state"), F.when(size % 7 != 0, size % 11).alias("seats"), F.when(size % 3 != 0, size % 8).alias("rating"))
    return rows.select("id", "brand", F.row_number().over(Window.partitionBy("brand").orderBy(*X.decision_order(), "id")).cast("long").alias("place"))


@query("O13", """WITH r AS (SELECT o_custkey AS owner, CASE o_orderkey % 3 WHEN 0 THEN 'positive' WHEN 1 THEN 'neutral' ELSE 'negative' END AS impact, o_orderpriority AS kind, o_orderkey AS k FROM orders)
SELECT owner, string_agg(impact || ':' || kind || ':' || k, ';' ORDER BY CASE impact WHEN 'negative' THEN 0 WHEN 'positive' THEN 1 ELSE 2 END, kind || ':' || k) AS reasons FROM r GROUP BY 1""")
def ordered_reasons(t: Tables):
    """Reasons by owner: those against first, then those for, then the rest."""
    k = F.col("o_orderkey")
    impact = F.when(k % 3 == 0, "positive").when(k % 3 == 1, "neutral").otherwise("negative")
    rows = t.orders.select(F.col("o_custkey").alias("owner"), F.struct(impact.alias("impact"), F.col("o_orderpriority").alias("kind"), k.cast("string").alias("message")).alias("reason"))
    out = rows.groupBy("owner").agg(X.sorted_reasons(F.collect_list("reason")).alias("reasons"))
    return out.select("owner", F.array_join(F.transform("reasons", lambda r: F.concat_ws(":", r["impact"], r["kind"], r["message"])), ";").alias("reasons"))


@query("X16 T09", """WITH m AS (SELECT p_partkey AS id, contains(lower(p_name), 'co') AS title, CASE WHEN p_size % 4 <> 0 THEN len(list_filter([p_type || '.pdf', p_brand || '.co'], lambda x: contains(lower(x), 'co'))) ELSE 0 END AS files FROM part)
SELECT id, CASE WHEN title AND files > 0 THEN 'title,attachment' WHEN title THEN 'title' ELSE 'attachment' END AS reasons, files AS attachments FROM m WHERE title OR files > 0""")
def content_search(t: Tables):
    """Content whose title or whose attachments hold the text, and which of them do; folders have no attachments."""
    files = F.when(F.col("p_size") % 4 != 0, F.array(F.concat("p_type", F.lit(".pdf")), F.concat("p_brand", F.lit(".co")))).otherwise(F.array().cast("array<string>"))
    found = X.match_reasons(F.col("p_name"), files, "CO ")
    return t.part.select(F.col("p_partkey").alias("id"), found.alias("x")).where(F.size("x.reasons") > 0).select("id", F.array_join("x.reasons", ",").alias("reasons"), F.size("x.attachments").cast("long").alias("attachments"))


@query("A25", """WITH g AS (SELECT o_custkey AS owner, CASE o_orderkey % 7 WHEN 0 THEN 0 WHEN 3 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 4 THEN 3 END AS p FROM orders)
SELECT owner, CASE min(p) WHEN 0 THEN 'passed' WHEN 1 THEN 'failed' WHEN 2 THEN 'non-completed' WHEN 3 THEN 'unknown' END AS completion FROM g GROUP BY 1""")
def best_completion(t: Tables):
    """The best completion of each owner's rows, by a fixed order; none if no row has a result."""
    letters = F.get(F.array(*[F.lit(x) for x in ("A", "F", "W", "P", "??", "", None)]), (F.col("o_orderkey") % 7).cast("int"))
    return t.orders.select(F.col("o_custkey").alias("owner"), letters.alias("letter")).groupBy("owner").agg(X.best_completion(F.col("letter"), F.lit(None).cast("double")).alias("completion"))
