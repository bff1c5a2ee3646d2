"""Queries on normalisation, trees, rule sets, sinks and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import scalars as S
from plumbline.operators import audit as A
from plumbline.operators import normalize as N
from plumbline.operators import rank as X
from plumbline.operators import tree
from plumbline.plans.catalog import Tables, query
from plumbline.sources import documents, sinks


#: Parts as content: a tree of fours, in which some have a second parent, and the roots one of their own descendants.
_NODES = """n AS (SELECT p_partkey AS id, p_partkey // 4 AS parent FROM part UNION ALL SELECT p_partkey, p_partkey // 9 + 1 FROM part WHERE p_partkey % 5 = 3 UNION ALL SELECT p_partkey, p_partkey * 4 + 9 FROM part WHERE p_partkey < 4)"""
_WALK = f"""RECURSIVE {_NODES}, w(id, depth, path) AS (SELECT p_partkey, 0, [p_partkey] FROM part WHERE p_partkey < 4
UNION SELECT n.id, depth + 1, list_append(path, n.id) FROM w JOIN n ON n.parent = w.id WHERE NOT list_contains(path, n.id) AND depth < 12),
b AS (SELECT id, min(depth) AS depth FROM w GROUP BY 1), t AS (SELECT id, depth, min(path) AS path FROM w JOIN b USING (id, depth) GROUP BY ALL)"""


def _content(t: Tables) -> tuple[DataFrame, DataFrame]:
    k = F.col("p_partkey")
    own = t.part.select(k.alias("id"), F.floor(k / 4).alias("parent"))
    second = t.part.where(k % 5 == 3).select(k.alias("id"), (F.floor(k / 9) + 1).alias("parent"))
    back = t.part.where(k < 4).select(k.alias("id"), (k * 4 + 9).alias("parent"))
    return own.unionByName(second).unionByName(back), own.where("id < 4")


@query("J31 J32", f"WITH {_WALK} SELECT id, CAST(depth AS INT) AS depth, array_to_string(path, '/') AS path FROM t")
def tree_walk(t: Tables):
    """Content walked from its roots, each node once."""
    return tree.walk(*_content(t)).select("id", "depth", F.array_join(F.transform("path", lambda x: x.cast("string")), "/").alias("path"))


@query("J31 T08 T09", f"WITH {_WALK} SELECT id, CAST(depth AS INT) AS depth, true AS truncated FROM t ORDER BY path, id LIMIT 100")
def content_tree(t: Tables):
    """The first hundred nodes of the walk, and whether the list was cut there."""
    return tree.first_items(tree.walk(*_content(t)), 100).select("id", "depth", "truncated")


@query("P26", """SELECT p_brand AS grouping, p_type AS lab, p_name AS room, count(*) AS k FROM part GROUP BY ALL""")
def nested_rooms(t: Tables):
    """Groups of labs of rooms, flattened."""
    labs = t.part.groupBy("p_brand", "p_type").agg(F.collect_list(F.struct("p_name")).alias("rooms"))
    groups = labs.groupBy("p_brand").agg(F.collect_list(F.struct("p_type", "rooms")).alias("labs"))
    flat = groups.select(F.col("p_brand").alias("grouping"), F.explode(tree.leaves(F.col("labs"), "rooms", {"p_type": "lab"})).alias("x"))
    return flat.groupBy("grouping", F.col("x.lab").alias("lab"), F.col("x.rooms.p_name").alias("room")).agg(F.count("*").alias("k"))


@query("A05 P27", "SELECT CASE p_size % 4 WHEN 0 THEN 'file' WHEN 1 THEN 'folder' WHEN 2 THEN 'assignment' ELSE 'unknown' END AS kind, p_type AS handler, count(*) AS k FROM part GROUP BY ALL")
def content_types(t: Tables):
    handler = F.element_at(F.array(*[F.lit(f"resource/x-bb-{k}") for k in ("file", "folder", "asmt-test-link", "blog")]), F.col("p_size") % 4 + 1)
    return t.part.groupBy(N.handler_kind(handler).alias("kind"), F.col("p_type").alias("handler")).agg(F.count("*").alias("k"))


@query("P01 P02 Y03 Y04 Y05 C14", """SELECT o_orderkey AS id, 'C' || o_custkey AS code, CAST(o_orderkey % 6 AS DOUBLE) / 2 AS credits, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 120 AS DOUBLE) END AS capacity,
'Li|Wang' || o_orderkey % 9 AS teachers, CASE WHEN o_orderkey % 4 = 0 THEN 'tis-bundle:b' || o_orderkey % 50 WHEN o_orderkey % 4 = 1 THEN 'tis-selection:' || o_orderkey ELSE 'tis-task:t-' || o_orderkey END AS bundle,
array_to_string(list_filter(generate_series(1 + o_orderkey % 3, 12), lambda w: w % 2 = 1), ',') AS weeks, CAST(3 AS INT) AS day, CAST(1 + o_orderkey % 5 AS INT) AS ps, CAST(2 + o_orderkey % 5 AS INT) AS pe, 'R' || o_custkey % 200 AS room FROM orders""")
def normalise_sections(t: Tables):
    """Orders written as raw sections with a schedule in HTML, and normalised."""
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    s = lambda x: x.cast("string")
    line = F.concat(s(1 + k % 3), F.lit("-12单周,星期三第"), s(1 + k % 5), F.lit("-"), s(2 + k % 5), F.lit("节 R"), s(F.col("o_custkey") % 200))
    raw = t.orders.select(
        F.concat(F.lit(" C"), c, F.lit(" ")).alias("kcdm"), F.concat(F.lit("t-"), s(k)).alias("rwh"), s(k % 6 / 2).alias("xf"), F.when(k % 3 == 0, F.lit("none")).otherwise(s(k % 120)).alias("zrl"),
        F.concat(F.lit("Li，Wang"), s(k % 9), F.lit(", Li")).alias("dgjsmc"), F.when(k % 4 == 0, F.concat(F.lit("b"), s(k % 50))).otherwise(F.lit("  ")).alias("kczid"), F.when(k % 4 == 1, s(k)).alias("id"),
        F.concat(F.lit('<span class="ivu-tag-text"><p>'), line, F.lit("</p><p>nothing</p></span>")).alias("kcxx"),
    )
    x = N.sections(raw).withColumn("slot", F.get("schedule", F.lit(0)))
    return x.select(F.element_at(F.split("task", "-"), -1).cast("long").alias("id"), "code", "credits", "capacity", F.array_join("teachers", "|").alias("teachers"), "bundle", F.array_join("slot.weeks", ",").alias("weeks"), "slot.day", "slot.ps", "slot.pe", "slot.room")


@query("P03 Y02", """SELECT o_orderkey AS id, CAST(o_orderkey % 7 + 1 AS INT) AS day, CAST(CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 9 + 1 ELSE 5 END AS INT) AS ps, CASE WHEN o_orderkey % 2 = 0 THEN '1,3' ELSE '2,4,6' END AS weeks FROM orders""")
def normalise_entries(t: Tables):
    """Entries with columns and a bitmap, or with a key and a description."""
    k = F.col("o_orderkey")
    even = k % 2 == 0
    key = F.concat(F.lit("xq"), (k % 7 + 1).cast("string"), F.lit("_jc5"))
    raw = t.orders.select(k.cast("string").alias("RWH"), key.alias("KEY"), F.when(even, (k % 9 + 1).cast("string")).alias("KSJC"), F.when(even, "0101").alias("ZC"), F.when(~even, "Name\n[Teacher]\n[2-6双周] [Room 1] [5-6节]").alias("SKSJ"))
    return N.entries(raw).select(F.col("task").cast("long").alias("id"), "day", "ps", F.array_join("weeks", ",").alias("weeks"))


@query("P05 D01 D08 R15", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN 'bad_date' WHEN o_orderkey % 7 = 0 THEN 'bad_time' ELSE 'ok' END AS outcome,
CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 2 HOUR END AS start FROM orders""")
def normalise_exams(t: Tables):
    """Exams with dates and times that can or can't be read."""
    k = F.col("o_orderkey")
    raw = t.orders.select(k.cast("string").alias("KCDM"), F.when(k % 5 == 0, F.lit("1996-02-30")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("KSRQ"), F.when(k % 7 == 0, "12:00-11:00").otherwise("10:00-12:00").alias("KSJTSJ"))
    x = N.exams(raw)
    why = N.exam_omission(F.col("day"), F.col("start"), F.lit("now"), "now")
    return x.select(F.col("code").cast("long").alias("id"), F.coalesce(why, F.lit("ok")).alias("outcome"), "start")


@query("P16 P21 P23 D16 D18 M04", """SELECT o_orderkey AS id, CAST(o_orderkey % 3 + o_orderkey % 5 + o_orderkey % 7 AS DOUBLE) / 100 AS cost, o_orderkey % 2 = 1 AS can_print, o_orderkey // 8 % 2 = 1 AS can_color, CAST(o_orderkey // 1000 AS BIGINT) AS server_group,
date_trunc('second', o_orderdate) + INTERVAL 3661 SECOND AS at_time, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS begins FROM orders""")
def normalise_services(t: Tables):
    """Printing records, printers and programs from packed numbers."""
    k, s = F.col("o_orderkey"), lambda x: x.cast("string")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    ms = (F.unix_date(F.to_date("o_orderdate")).cast("long") * 86400000).cast("string")
    raw = t.orders.select(s(k).alias("dwSID"), day.alias("dwDate"), F.lit("10101").alias("dwTime"), s(k % 3).alias("dwUsedCardMoney"), s(k % 5).alias("dwUsedFreeMoney"), s(k % 7).alias("dwUsedMoney"), s(k).alias("dwDevSN"), s(k % 16).alias("dwProperty"), s(k).alias("ID"), F.concat(F.lit("/Date("), ms, F.lit(")/")).alias("ApplyBeginDate"))
    use, place, prog = N.usage(raw).select("id", "cost", F.col("at").alias("at_time")), N.stations(raw).select("id", "can_print", "can_color", "server_group"), N.programs(raw).select(F.col("id").cast("long").alias("id"), "begins")
    return use.join(place, "id").join(prog, "id")


@query("F18", """SELECT o_orderkey AS id, array_to_string(list_filter([CASE WHEN o_totalprice > 200000 THEN 'too_long' END, CASE WHEN o_orderstatus = 'F' THEN 'past' END, CASE WHEN o_orderkey % 5 = 0 THEN 'capacity' END], lambda x: x IS NOT NULL), ',') AS blockers,
NOT (o_totalprice > 200000 OR o_orderstatus = 'F' OR o_orderkey % 5 = 0) AS ready FROM orders""")
def preflight_rules(t: Tables):
    """Rules that block each order."""
    found = A.findings({"too_long": F.col("o_totalprice") > 200000, "past": F.col("o_orderstatus") == "F", "capacity": F.col("o_orderkey") % 5 == 0})
    return t.orders.select(F.col("o_orderkey").alias("id"), F.array_join(found, ",").alias("blockers"), (F.size(found) == 0).alias("ready"))


@query("", """WITH q(name) AS (VALUES ('Brand#11'), ('Brand#1'), ('Brand#99'), ('#2')), b AS (SELECT DISTINCT p_brand FROM part),
m AS (SELECT q.name, p_brand, CASE WHEN p_brand = q.name THEN 0 ELSE 1 END AS rnk FROM q JOIN b ON contains(p_brand, q.name)), x AS (SELECT name, min(rnk) AS best FROM m GROUP BY 1)
SELECT q.name, CAST(count(p_brand) AS BIGINT) AS candidates, CASE WHEN count(p_brand) = 0 THEN 'not_found' WHEN count(p_brand) = 1 THEN 'resolved' ELSE 'ambiguous' END AS status FROM q LEFT JOIN x USING (name) LEFT JOIN m ON m.name = q.name AND rnk = best GROUP BY q.name""")
def resolve_names(t: Tables):
    """Exact names first, else those that contain what was asked; more than one is ambiguous."""
    asked = t.rows([("Brand#11",), ("Brand#1",), ("Brand#99",), ("#2",)], "name string")
    brands = t.part.select("p_brand").distinct()
    met = brands.join(F.broadcast(asked), F.col("p_brand").contains(F.col("name"))).withColumn("rank", F.when(F.col("p_brand") == F.col("name"), 0).otherwise(1))
    per = met.groupBy("name", "rank").agg(F.count("*").alias("k")).groupBy("name").agg(F.min_by("k", "rank").alias("k"))
    k = F.coalesce("k", F.lit(0))
    return asked.join(per, "name", "left").select("name", k.alias("candidates"), F.when(k == 0, "not_found").when(k == 1, "resolved").otherwise("ambiguous").alias("status"))


@query("D10 C11", """SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN '2024秋' WHEN 1 THEN '2024春' ELSE '2024夏' END AS label, CASE o_orderkey % 3 WHEN 0 THEN '20241' WHEN 1 THEN '20252' ELSE '20253' END AS code, o_orderkey % 4 IN (0, 1) AS extends FROM orders""")
def term_labels(t: Tables):
    k = F.col("o_orderkey")
    code = F.concat(F.lit("2024"), (k % 3 + 1).cast("string"))
    full = F.when(k % 4 == 0, "CS101").when(k % 4 == 1, "CS101A").when(k % 4 == 2, "CS1012").otherwise("EE101")
    return t.orders.select(k.alias("id"), S.term_label(code).alias("label"), S.term_code(F.lit("2024-2025"), (k % 3 + 1).cast("string")).alias("code"), S.extends_code(full, F.lit("CS101")).alias("extends"))


@query("X15 X14 C16", """SELECT p_partkey AS id, CASE WHEN p_size * 8 <= 50 THEN 'Good' WHEN p_size * 8 <= 100 THEN 'Moderate' WHEN p_size * 8 <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN p_size * 8 <= 200 THEN 'Unhealthy' WHEN p_size * 8 <= 300 THEN 'Very Unhealthy' ELSE 'Hazardous' END AS air,
CASE WHEN p_size % 3 = 0 THEN 'unknown' WHEN p_size >= 3 THEN 'group' ELSE 'solo' END AS room FROM part""")
def level_labels(t: Tables):
    size = F.col("p_size").cast("string")
    name = F.when(F.col("p_size") % 3 == 0, "Room").when(F.col("p_size") % 3 == 1, F.concat(F.lit("Room（"), size, F.lit("－60）"))).otherwise(F.concat(F.lit("Room ("), size, F.lit("+)")))
    return t.part.select(F.col("p_partkey").alias("id"), X.air_level(F.col("p_size") * 8).alias("air"), S.capacity_class(name).alias("room"))


@query("K01", """SELECT CAST(0 AS INT) AS place, '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}' AS line FROM nation UNION ALL SELECT 1, '{"summary":"nation","items":' || count(*) || '}' FROM nation""")
def json_envelope(t: Tables):
    return sinks.json_lines(t.nation.select("n_nationkey", "n_name", "n_regionkey"), "nation")


@query("K05 G08 S31", r"""WITH e AS (SELECT user_id, event_id, ts, 'BEGIN:VEVENT' || chr(13) || chr(10) || 'UID:' || event_id || chr(13) || chr(10) || 'DTSTAMP:20240101T000000Z' || chr(13) || chr(10) || 'DTSTART:' || strftime(ts, '%Y%m%dT%H%M%SZ') || chr(13) || chr(10)
|| 'DTEND:' || strftime(ts + INTERVAL 1 HOUR, '%Y%m%dT%H%M%SZ') || chr(13) || chr(10) || 'SUMMARY:' || event_type || '\, user' || chr(13) || chr(10) || 'DESCRIPTION:a\;b' || chr(13) || chr(10) || 'END:VEVENT' AS x FROM events)
SELECT user_id, md5('BEGIN:VCALENDAR' || chr(13) || chr(10) || 'VERSION:2.0' || chr(13) || chr(10) || 'PRODID:-//plumbline//EN' || chr(13) || chr(10) || 'CALSCALE:GREGORIAN' || chr(13) || chr(10) || string_agg(x, chr(13) || chr(10) ORDER BY event_id) || chr(13) || chr(10) || 'END:VCALENDAR' || chr(13) || chr(10)) AS mark FROM e GROUP BY 1""")
def calendar_text(t: Tables):
    """A calendar for each user."""
    text = sinks.event_text(F.col("event_id").cast("string"), F.concat("event_type", F.lit(", user")), F.lit("a;b"), F.col("ts"), F.col("ts") + F.expr("interval 1 hour"), "20240101T000000Z")
    cal = sinks.calendar(t.events.select("user_id", "event_id", text.alias("text")), ["user_id"], "text", ["event_id"], "plumbline")
    return cal.where(sinks.is_calendar(F.col("calendar"))).select("user_id", F.md5(F.encode("calendar", "UTF-8")).alias("mark"))


@query("K06", "SELECT s_suppkey AS id, '# ' || s_name || chr(10) || '- **nation**: ' || s_nationkey AS page FROM supplier")
def markdown_pages(t: Tables):
    return t.supplier.select(F.col("s_suppkey").alias("id"), sinks.markdown_page(F.col("s_name"), {"nation": F.col("s_nationkey").cast("string"), "none": F.lit(" ")}).alias("page"))


@query("S25 S15", "SELECT o_orderkey % 3 AS form, CAST(sum(o_orderkey) AS BIGINT) AS ids FROM orders GROUP BY 1")
def unwrap_payloads(t: Tables):
    """Records out of bare arrays and of two kinds of envelopes."""
    k = F.col("o_orderkey")
    one = F.concat(F.lit('[{"id":'), k.cast("string"), F.lit("}]"))
    body = F.when(k % 3 == 0, one).when(k % 3 == 1, F.concat(F.lit('{"rows":'), one, F.lit("}"))).otherwise(F.concat(F.lit('{"data":'), one, F.lit(',"total":1}')))
    return t.orders.select((k % 3).alias("form"), F.explode(documents.unwrap(body, "struct<id:bigint>")).alias("r")).groupBy("form").agg(F.sum("r.id").alias("ids"))


@query("S03", "SELECT sha256(p_type) AS fingerprint, count(*) AS times FROM part GROUP BY p_type HAVING count(*) > 1")
def repeated_pages(t: Tables):
    return documents.repeated_pages(t.part, "p_type")


@query("P12 P19 P24 P13", """SELECT p_partkey AS id, lower(p_brand) AS doi, p_size % 3 = 2 AS full_text, left(p_name, 1) || repeat('*', length(p_name) - 1) AS masked FROM part WHERE p_size % 5 NOT IN (0, 1)""")
def normalise_works(t: Tables):
    """Papers of the wanted kinds without supplements, full text by labels, masked names."""
    kind = F.when(F.col("p_size") % 5 == 0, "dataset").when(F.col("p_size") % 5 == 1, "journal-article")
    doi = F.when(F.col("p_size") % 5 == 1, F.concat(F.lower("p_brand"), F.lit(".s001"))).otherwise(F.lower("p_brand"))
    keep = N.works(t.part.select(F.col("p_partkey").alias("id"), "p_size", kind.alias("type"), doi.alias("doi"), F.col("p_name").alias("name")))
    labels = F.array(F.when(F.col("p_size") % 3 == 1, "online no_fulltext").when(F.col("p_size") % 3 == 2, "Full Text").otherwise("print"), F.lit("x"))
    return keep.select("id", "doi", N.has_full_text(F.lit(None).cast("string"), labels).alias("full_text"), F.concat(F.substring("name", 1, 1), F.repeat(F.lit("*"), F.length("name") - 1)).alias("masked"))
