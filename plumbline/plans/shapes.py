"""Queries on records and texts of several shapes: what a service sends, some of it odd, and what is made of it."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from plumbline.functions import scalars as S
from plumbline.functions.staging import new_path
from plumbline.operators import diff as D
from plumbline.operators import intervals, tree
from plumbline.operators import keys as K
from plumbline.operators import normalize as N
from plumbline.plans.adapters import MEETINGS, SNAPSHOTS, TRANSCRIPT, meetings, snapshots, transcript
from plumbline.plans.catalog import Tables, query
from plumbline.sources import documents, html, markdown, sinks


def _pick(k: Column, *values) -> Column:
    """The value at k modulo how many there are."""
    return F.get(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), (k % len(values)).cast("int"))


# Records


@query("P04 M02", f"WITH {TRANSCRIPT} SELECT grade_id AS id, upper(trim(code)) AS code, CASE WHEN grade_id % 4 = 1 THEN 0.0 ELSE credits END AS credits, letter, score, CAST(points AS DOUBLE) AS points FROM (SELECT * REPLACE (trim(letter) AS letter) FROM transcript)")
def normalise_grades(t: Tables):
    """Raw grades with dirty numbers, as typed ones with their points."""
    g = transcript(t)
    raw = g.select(F.col("code").alias("KCDM"), F.col("name").alias("kcmc"), F.col("semester").alias("xnxqmc"), F.when(F.col("grade_id") % 4 == 1, "n/a").otherwise(F.concat(F.lit(" "), F.col("credits").cast("string"))).alias("xf"), F.col("letter").alias("xscj"), F.coalesce(F.col("score").cast("string"), F.lit(" -")).alias("zzcj"), F.col("grade_id").cast("string").alias("kcxz"))
    return N.grade_records(raw).select(F.col("nature").cast("long").alias("id"), F.upper("code").alias("code"), "credits", "letter", "score", "points")


@query("P07 M05", """WITH c AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(c_custkey % 7 AS DOUBLE) + 100 END AS a, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 6 AS DOUBLE) + 100 END AS b, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey % 110 AS DOUBLE) END AS d, CAST(c_custkey % 9 AS DOUBLE) AS r FROM customer)
SELECT id, coalesce(a, b) AS required, d AS completed, CASE WHEN coalesce(a, b) IS NOT NULL AND d IS NOT NULL THEN greatest(coalesce(a, b) - d, 0) ELSE r END AS remaining, coalesce(abs(a - b) >= 1e-6, false) AS disagrees FROM c""")
def degree_progress(t: Tables):
    """Credits from two sources: the overview goes first, what remains follows from both, and a disagreement is told."""
    k = F.col("c_custkey")
    num = lambda c, n, add: F.when(k % c != 0, (k % n + add).cast("double"))
    rows = t.customer.select(k.alias("id"), num(4, 7, 100).alias("overview_required"), num(5, 6, 100).alias("summary_required"), num(3, 110, 0).alias("completed"), (k % 9).cast("double").alias("summary_remaining"))
    return N.degree_progress(rows)


@query("P18 T10", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS label, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_acctbal AS DOUBLE) END AS next_deadline, true AS known FROM customer")
def context_record(t: Tables):
    """Columns by level: a normal record has the middle ones (null where there is nothing), and not the verbose ones."""
    rows = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("label"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal")).alias("next_deadline"), F.lit(True).alias("known"), F.lit("open").alias("library"))
    return N.at_level(rows, "normal", {"terse": ["id", "name", "label"], "normal": ["next_deadline", "known"], "verbose": ["library"]})


@query("P20 P24", """SELECT p_partkey AS id, 'alma' || p_partkey AS doc_id, CASE p_partkey % 3 WHEN 0 THEN 'PC' ELSE 'L' END AS context, p_name AS title, p_type AS format, p_partkey % 4 <> 1 AS full_text FROM part WHERE p_partkey % 6 <> 5""")
def catalog_records(t: Tables):
    """Library records in JSON as catalog rows: ids and titles from where they are, without those that have none."""
    k = F.col("p_partkey")
    control = F.when(k % 6 != 5, F.array(F.concat(F.lit("alma"), k.cast("string"))))
    display = F.struct(F.array(F.concat(F.lit(" <b>"), "p_name", F.lit("</b>  "))).alias("title"), F.array("p_type").alias("type"))
    links = _pick(k, "Online access", "no_fulltext", "full text", "view online")
    body = F.to_json(F.struct(F.struct(F.struct(control.alias("recordid")).alias("control"), display.alias("display"), F.struct(F.array(links).alias("lds")).alias("links")).alias("pnx"), F.when(k % 3 == 0, "PC").alias("context")))
    return N.catalog_rows(t.part.select(k.alias("id"), body.alias("body")), "body").select("id", "doc_id", "context", "title", "format", "full_text")


@query("A15", f"""WITH {MEETINGS} SELECT code, room % 3 AS part, array_to_string(list_sort(list_distinct(list_filter(list(CASE WHEN section % 4 = 0 THEN '' ELSE 'T' || section % 6 END), lambda x: x <> ''))), ',') AS teachers,
array_to_string(list_sort(list(day || ':' || ps || '-' || pe)), ';') AS meets FROM meetings GROUP BY 1, 2""")
def enrolment_rollup(t: Tables):
    """Enrolments by code and section group: the different teachers in order, and all meetings."""
    teacher = F.when(F.col("section") % 4 != 0, F.concat(F.lit("T"), (F.col("section") % 6).cast("string")))
    meet = F.concat(F.col("day").cast("string"), F.lit(":"), F.col("ps").cast("string"), F.lit("-"), F.col("pe").cast("string"))
    own = meetings(t).groupBy("code", (F.col("room") % 3).alias("part")).agg(F.array_sort(F.collect_set(teacher)).alias("teachers"), F.array_sort(F.collect_list(meet)).alias("meets"))
    return own.select("code", "part", F.array_join("teachers", ",").alias("teachers"), F.array_join("meets", ";").alias("meets"))


@query("A18", """WITH c AS (SELECT p_brand AS grouping, p_type AS name, CAST(sum(p_size % 5) AS BIGINT) AS idle, CAST(sum(p_size % 9) AS BIGINT) AS total FROM part GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY grouping ORDER BY idle DESC, total DESC, name) AS n FROM c WHERE total > 0), s AS (SELECT grouping, sum(idle) AS i, sum(total) AS t FROM c GROUP BY 1)
SELECT s.grouping, i || '/' || t || ' idle' || coalesce((SELECT string_agg(' · ' || name || ' ' || idle || '/' || total, '' ORDER BY n) FROM r WHERE r.grouping = s.grouping AND n <= 2), '') AS summary FROM s""")
def idle_summary(t: Tables):
    """Idle and total by group, with the two categories in which most is idle."""
    c = t.part.groupBy(F.col("p_brand").alias("grouping"), F.col("p_type").alias("name")).agg(F.sum(F.col("p_size") % 5).alias("idle"), F.sum(F.col("p_size") % 9).alias("total"))
    of = lambda r: F.concat(r["idle"].cast("string"), F.lit("/"), r["total"].cast("string"))
    row = F.struct((-F.col("idle")).alias("a"), (-F.col("total")).alias("b"), "name", "idle", "total")
    top = F.slice(F.array_sort(F.collect_list(F.when(F.col("total") > 0, row))), 1, 2)
    sums = c.groupBy("grouping").agg(F.struct(F.sum("idle").alias("idle"), F.sum("total").alias("total")).alias("all"), top.alias("top"))
    return sums.select("grouping", F.concat_ws(" · ", F.concat(of(F.col("all")), F.lit(" idle")), F.transform("top", lambda r: F.concat(r["name"], F.lit(" "), of(r)))).alias("summary"))


@query("A28 T08", """WITH r AS (SELECT o_custkey AS owner, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 't' || o_orderkey % 40 END AS task, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'C' || o_orderkey % 9 END AS code FROM orders), i AS (SELECT owner, CASE WHEN task <> '' THEN 'task:' || task WHEN code IS NOT NULL THEN 'code:' || code END AS id FROM r)
SELECT owner, count(DISTINCT id) AS courses, count(*) AS rows, count(*) - count(id) AS omitted, CASE WHEN count(*) > count(id) THEN 'partial' ELSE 'ok' END AS status FROM i GROUP BY 1""")
def current_courses(t: Tables):
    """Courses by owner, told apart by task, else by code; rows with neither are counted and told."""
    k = F.col("o_orderkey")
    rows = t.orders.select(F.col("o_custkey").alias("owner"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("t"), (k % 40).cast("string"))).alias("task"), F.when(k % 4 != 0, F.concat(F.lit("C"), (k % 9).cast("string"))).alias("code"))
    own = F.coalesce(F.concat(F.lit("task:"), F.nullif(F.trim("task"), F.lit(""))), F.concat(F.lit("code:"), F.nullif(F.trim("code"), F.lit(""))))
    n, known = F.count("*"), F.count(own)
    return rows.groupBy("owner").agg(F.countDistinct(own).alias("courses"), n.alias("rows"), (n - known).alias("omitted"), F.when(n > known, "partial").otherwise("ok").alias("status"))


@query("G03 G01 G02", """SELECT o_orderkey AS id, sha256(CASE o_orderkey % 3 WHEN 0 THEN '{"code":"' || o_orderstatus || '","date":"' || o_orderpriority || '"}' WHEN 1 THEN '{"code":"' || o_orderstatus || '","score":' || o_custkey || '}' ELSE '{"column":' || o_custkey || ',"due":"' || o_orderpriority || '"}' END) AS digest FROM orders""")
def comparable_forms(t: Tables):
    """Records of three sources without what changes by itself, as sorted JSON, digested."""
    k = F.col("o_orderkey")
    exam = N.comparable("exams", {"date": F.col("o_orderpriority"), "weekday": k.cast("string"), "code": F.col("o_orderstatus")})
    grade = N.comparable("grades", {"score": F.col("o_custkey"), "gpaPoints": k, "code": F.col("o_orderstatus")})
    due = N.comparable("blackboardDeadlines", {"due": F.col("o_orderpriority"), "daysLeft": k, "column": F.col("o_custkey")})
    return t.orders.select(k.alias("id"), S.digest(F.encode(_pick(k, exam, grade, due), "UTF-8")).alias("digest"))


@query("G04", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'r' || o_orderkey WHEN o_orderkey % 4 = 1 THEN o_orderstatus || '/' || o_custkey WHEN o_orderkey % 4 = 2 THEN o_orderstatus ELSE CASE WHEN o_orderkey % 4 = 3 THEN CAST(o_custkey AS VARCHAR) ELSE sha256(o_orderpriority) END END AS key FROM orders""")
def identity_keys(t: Tables):
    """Keys of records: the explicit one, else the parts that there are, else a digest."""
    k = F.col("o_orderkey")
    explicit = F.when(k % 3 == 0, F.concat(F.lit("r"), k.cast("string"))).otherwise(" ")
    parts = [F.when(k % 4 < 3, F.when(k % 4 > 0, F.col("o_orderstatus"))), F.when(k % 2 == 1, F.col("o_custkey").cast("string"))]
    return t.orders.select(k.alias("id"), S.identity_key(explicit, parts, F.col("o_orderpriority")).alias("key"))


@query("G06 T03", f"""WITH {SNAPSHOTS}, f AS (SELECT source, key, before, after, string_split(before, '|') AS b, string_split(after, '|') AS a FROM changes WHERE change_type = 'changed')
SELECT source, key, before, concat_ws('; ', CASE WHEN b[2] IS DISTINCT FROM a[2] THEN 'price: ' || b[2] || ' -> ' || a[2] END, CASE WHEN b[3] IS DISTINCT FROM a[3] THEN 'note: ' || b[3] || ' -> ' || a[3] END) AS fields FROM f""")
def field_changes(t: Tables):
    """What changed in each changed record, field by field."""
    rows = D.bag_diff(*snapshots(t)).where("change_type = 'changed'")
    part = lambda c, i: F.get(F.split(c, r"\|"), F.lit(i))
    fields = {"price": (part("before", 1), part("after", 1)), "note": (part("before", 2), part("after", 2))}
    return rows.select("source", "key", "before", F.array_join(S.changed_fields(fields), "; ").alias("fields"))


@query("C08", """SELECT s_suppkey AS id, CASE s_suppkey % 4 WHEN 0 THEN '北门' WHEN 1 THEN '图书馆' WHEN 2 THEN s_name ELSE '工学院 A' END AS zh, CASE s_suppkey % 4 WHEN 0 THEN s_name || ' gate' WHEN 1 THEN 'Library ' || s_name ELSE '' END AS en FROM supplier""")
def bilingual_names(t: Tables):
    """Names in two languages, split by line or where the Latin part begins."""
    k = F.col("s_suppkey")
    name = _pick(k, F.concat(F.lit("北门 \n "), "s_name", F.lit("\ngate")), F.concat(F.lit("图书馆  Library "), "s_name"), F.col("s_name"), F.lit("工学院 A"))
    parts = S.bilingual(F.when(k % 4 == 3, F.lit("工学院 A\n")).otherwise(name))
    return t.supplier.select(k.alias("id"), parts["zh"].alias("zh"), parts["en"].alias("en"))


@query("C18", r"SELECT doc_id, left(trim(regexp_replace(text, '\s+', ' ', 'g')), 160) AS sample FROM documents")
def text_samples(t: Tables):
    """The first 160 characters of texts, white space collapsed."""
    return t.documents.select("doc_id", S.sample(F.col("text"), 160).alias("sample"))


@query("M05", "SELECT o_orderkey AS id, CAST(greatest(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 50 END, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey % 50 END) AS BIGINT) AS most, CAST(greatest(0, least(100, o_orderkey % 300 - 100)) AS BIGINT) AS share FROM orders")
def declared_capacity(t: Tables):
    """The larger of two numbers that may be missing, and a share kept between bounds."""
    k = F.col("o_orderkey")
    return t.orders.select(k.alias("id"), F.greatest(F.when(k % 3 != 0, k % 50), F.when(k % 5 != 0, F.col("o_custkey") % 50)).alias("most"), S.clamp(k % 300 - 100, 0, 100).cast("long").alias("share"))


@query("R13 G07", """WITH b AS (SELECT DISTINCT o_custkey AS owner, o_orderkey % 5 + 1 AS day, o_orderkey % 9 + 1 AS ps, o_orderkey % 9 + 1 + o_orderkey % 2 AS pe FROM orders WHERE o_orderkey % 6 <> 0)
SELECT owner, string_agg(day || ':' || ps || '-' || pe, ' ' ORDER BY day, ps, pe) AS blocks FROM b GROUP BY 1""")
def blocked_times(t: Tables):
    """Blocked times of each owner from texts: once each, in order of day, start and end; what can't be read is dropped."""
    k = F.col("o_orderkey")
    day = F.get(F.array(*[F.lit(d) for d in ("mon", "TUE", "周三", "4", "Fri")]), (k % 5).cast("int"))
    spec = F.when(k % 6 == 0, F.lit("SOME:1-99")).otherwise(F.concat(day, F.lit(":"), (k % 9 + 1).cast("string"), F.lit("-"), (k % 9 + 1 + k % 2).cast("string")))
    own = t.orders.select(F.col("o_custkey").alias("owner"), S.block_of(spec).alias("b")).where("b is not null")
    text = lambda b: F.concat(b["day"].cast("string"), F.lit(":"), b["ps"].cast("string"), F.lit("-"), b["pe"].cast("string"))
    return own.groupBy("owner").agg(F.array_join(F.transform(F.array_sort(F.collect_set("b")), text), " ").alias("blocks"))


# Stored documents


@query("S12 G02 T07", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 = 0 THEN 'missing' WHEN o_orderkey % 7 = 0 THEN 'changed' WHEN o_orderkey % 13 = 0 THEN 'too_large' ELSE 'ok' END AS state FROM orders""")
def snapshot_states(t: Tables):
    """Stored bodies against the digests that were stored beside them."""
    k = F.col("o_orderkey")
    body = F.when(k % 11 != 0, F.concat(S.canonical(("key", k)), F.when((k % 13 == 0) & (k % 7 != 0), F.repeat(F.lit(" "), 300)).otherwise("")))
    stored = F.when(k % 7 == 0, S.digest(F.encode(F.lit("{}"), "UTF-8"))).otherwise(S.digest(F.encode(body, "UTF-8")))
    return t.orders.select(k.alias("id"), documents.snapshot_state(body, stored, 200).alias("state"))


@query("S14", """WITH c AS (SELECT event_type AS source, event_id AS id, epoch(TIMESTAMP '2024-01-20 12:00:00') - floor(epoch(max(ts) OVER (PARTITION BY event_type))) AS age FROM events WHERE ts <= TIMESTAMP '2024-01-20 12:00:00' AND event_id % 3 <> 0)
SELECT source, id, 'cache' AS origin FROM c WHERE age < 3600 UNION ALL SELECT event_type, event_id, 'live' FROM events WHERE event_type NOT IN (SELECT source FROM c WHERE age < 3600)""")
def cached_sources(t: Tables):
    """Rows of each source from its cache if that was saved within the hour, else live."""
    now = F.lit("2024-01-20 12:00:00").cast("timestamp")
    rows = t.events.select(F.col("event_type").alias("source"), F.col("event_id").alias("id"), "ts")
    saved = rows.where((F.col("ts") <= now) & (F.col("id") % 3 != 0)).withColumn("saved_at", F.max("ts").over(Window.partitionBy("source")))
    return documents.fresh_by_source(saved.select("source", "id", "saved_at"), rows.select("source", "id"), "saved_at", now)


@query("K07 S14", "SELECT o_orderkey AS id, o_orderstatus AS status FROM orders WHERE o_orderstatus = 'F'")
def cached_term(t: Tables):
    """A catalog saved by term, and one term of it read back: the others aren't read."""
    path = new_path(t.spark, "terms")
    sinks.write_by_term(t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderstatus").alias("term")), path)
    return t.spark.read.parquet(path).where("term = 'F'").select("id", "status")


@query("K03 K04 S11 S13", "SELECT n_nationkey AS id, n_name AS name FROM nation")
def saved_plan(t: Tables):
    """A document saved as JSON (a second save to its place is refused), and read back with its kind and version checked."""
    path = new_path(t.spark, "plan")
    rows = t.nation.agg(F.array_sort(F.collect_list(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")))).alias("items"))
    sinks.save_json(rows.select(F.lit("plan").alias("kind"), F.lit(1).alias("schemaVersion"), "items"), path)
    try:
        sinks.save_json(rows, path)
    except sinks.QueryError as e:
        refused = e.code
    read = documents.read_json(t.spark, path, "kind string, schemaVersion int, items array<struct<id:int,name:string>>", "plan")
    return read.where(F.lit(refused) == "EXISTS").select(F.explode("items").alias("x")).select("x.id", "x.name")


@query("K02", "SELECT o_orderkey % 6 AS form, CASE o_orderkey % 6 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 4 ELSE 5 END AS status, count(*) AS k FROM orders GROUP BY ALL")
def exit_codes(t: Tables):
    """Errors by kind as exit codes; none is 0 and any other error 1."""
    code = _pick(F.col("o_orderkey"), F.lit(None).cast("string"), "TIMEOUT", "USAGE", "AUTH", "NOT_FOUND", "REMOTE")
    return t.orders.groupBy((F.col("o_orderkey") % 6).alias("form"), sinks.exit_code(code).cast("long").alias("status")).agg(F.count("*").alias("k")).withColumn("status", F.col("status").cast("int"))


@query("S04 S03", "SELECT 'p' || range AS id, CAST(range AS INT) AS depth FROM range(9)")
def cursor_scan(t: Tables):
    """Pages that name the next one, followed from the first; the last names a page that was read already."""
    n = F.col("n_nationkey")
    pages = t.nation.where(n < 9).select(F.concat(F.lit("p"), n.cast("string")).alias("parent"), F.concat(F.lit("p"), F.when(n == 8, 3).otherwise(n + 1).cast("string")).alias("id"))
    return tree.walk(pages, t.rows([("p0",)], "id string")).select("id", "depth")


@query("S37 S27 O08", """WITH m AS (SELECT c_custkey AS id, n_name AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal > 0)
SELECT id, nation, (SELECT count(*) FROM m) AS total, (SELECT count(*) FROM m) > 50 AS has_more FROM m ORDER BY nation, id LIMIT 25 OFFSET 25""")
def roster_page(t: Tables):
    """The second page of members of two roles who are available, with their users."""
    members = t.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & (F.col("c_acctbal") > 0))
    rows = members.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("id"), F.col("n_name").alias("nation"))
    return K.paged(rows, [F.col("nation"), F.col("id")], 2, 25)


# Texts of several shapes


@query("S20 W06 W07", """WITH d AS (SELECT doc_id, source, lang, doc_id % 4 AS f FROM documents)
SELECT doc_id, s.n, s.level, s.title, s.path, s.until FROM d, LATERAL (VALUES (0, 2, 2, source, source, 5), (0, 4, 3, lang, source || ' > ' || lang, 5), (0, 6, 2, 'end', 'end', 7),
  (1, 1, 3, lang, lang, 3), (1, 4, 2, source, source, 6), (1, 5, 4, 'deep', source || ' > deep', 6), (2, 1, 2, 'a ' || source, 'a ' || source, 4), (2, 2, 3, 'b', 'a ' || source || ' > b', 3), (2, 3, 4, 'c', 'a ' || source || ' > b > c', 3), (2, 4, 3, 'd', 'a ' || source || ' > d', 4)) s(f, n, level, title, path, until) WHERE s.f = d.f""")
def heading_tree(t: Tables):
    """Sections of Markdown of four shapes: levels that skip, headings without text, no heading at all."""
    src, lang = F.col("source"), F.col("lang")
    text = lambda *lines: F.concat_ws("\n", *[x if isinstance(x, Column) else F.lit(x) for x in lines])
    h = lambda mark, c: F.concat(F.lit(mark + " "), c)
    shapes = [text("# Part", h("##", src), "body", h("###", lang), "more", "## end", "x"), text(h("###", lang), "x", "", h("##", src), "####   deep ", "y"), text(h("## a", src), "### b", "#### c", "### d"), text("no heading", "#", "##", "##### five", "#no")]
    return markdown.sections(t.documents.select("doc_id", _pick(F.col("doc_id"), *shapes).alias("md")), ["doc_id"], "md").select("doc_id", "n", "level", "title", "path", "until")


@query("D15 C07", """WITH d AS (SELECT doc_id, source, '2024-03-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') AS d, doc_id % 5 AS f FROM documents)
SELECT doc_id AS id, CASE f WHEN 0 THEN d || ' 14:30' WHEN 1 THEN d || ' 09:05' WHEN 2 THEN d || ' 08:00' WHEN 3 THEN d || ' 10:00' END AS begins, CASE f WHEN 0 THEN d || ' 16:00' WHEN 2 THEN '2024-04-02 09:30' END AS ends,
  CASE f WHEN 0 THEN 'A title' WHEN 1 THEN 'On ' || source WHEN 2 THEN 'x: y' WHEN 3 THEN '《S》 Who:' ELSE 'no colon ' || source END AS title, CASE f WHEN 0 THEN '《Series》' WHEN 3 THEN '《S》' END AS series, CASE f WHEN 0 THEN 'Speaker' WHEN 1 THEN 'Ann' WHEN 2 THEN source WHEN 3 THEN 'Who' END AS speaker, CASE f WHEN 0 THEN source END AS affiliation FROM d""")
def talk_labels(t: Tables):
    """Labels and times of talks of five shapes: with series and affiliation, several days, loose, without a colon, of no time."""
    k, src = F.col("doc_id"), F.col("source")
    day = (k % 28 + 1).cast("string")
    iso = F.concat(F.lit("2024-03-"), F.lpad(day, 2, "0"))
    label = S.split_label(_pick(k, F.concat(F.lit("《Series》 Speaker @ "), src, F.lit("： A title")), F.concat(F.lit("Ann: On "), src), F.concat(src, F.lit(" : x: y")), F.lit("《S》 Who:"), F.concat(F.lit("no colon "), src)))
    time = S.talk_time(_pick(k, F.concat(F.lit("2024年3月"), day, F.lit("日 14:30-16:00")), F.concat(F.lit("2024年3月"), day, F.lit("日 9:05")), F.concat(F.lit("2024年3月"), day, F.lit("日 - 2024年4月2日 8:00-9:30")), F.concat(F.lit("on "), iso, F.lit(" at 10:00 sharp")), F.lit("2024年2月30日 25:00")))
    return t.documents.select(k.alias("id"), time["start"].alias("begins"), time["end"].alias("ends"), label["title"].alias("title"), label["series"].alias("series"), label["speaker"].alias("speaker"), label["affiliation"].alias("affiliation"))


@query("C03", r"""SELECT doc_id AS id, CASE doc_id % 4 WHEN 0 THEN source || ' see docs' WHEN 1 THEN 'Use ' || lang || ' and ' || source WHEN 2 THEN 'plain ' || source ELSE '' END AS body FROM documents""")
def manual_text(t: Tables):
    """Manual pages of four shapes without code, containers, images, rules and link targets."""
    src, lang = F.col("source"), F.col("lang")
    shapes = [F.concat(F.lit("```js\nhidden\n```\n::: tip x\n![a](b.png) **"), src, F.lit("** [see docs](http://x.org/y)\n:::\n|---|---|\n")), F.concat(F.lit("Use `"), lang, F.lit("`  and\n\n> *"), src, F.lit("*\n")), F.concat(F.lit("plain "), src), F.lit("```\nonly code\n```\n")]
    return t.documents.select(F.col("doc_id").alias("id"), S.sanitise_manual(_pick(F.col("doc_id"), *shapes)).alias("body"))


@query("P22 G05", "SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN 'copies ' || o_orderkey % 4 WHEN 1 THEN 'two,' || o_orderstatus WHEN 4 THEN 'named' ELSE '' END AS labels FROM orders")
def embedded_options(t: Tables):
    """Labels of options in JSON strings of five shapes; broken and empty ones have none."""
    k = F.col("o_orderkey")
    shapes = [F.concat(F.lit('[{"label":"copies '), (k % 4).cast("string"), F.lit('"},{"name":" "}]')), F.concat(F.lit('[{"label":"two"},{"label":" two "},{"name":"'), "o_orderstatus", F.lit('"}]')), F.lit('[{"label":"cut'), F.lit(None).cast("string"), F.lit('[{"name":"named","size":3}]')]
    return t.orders.select(k.alias("id"), F.array_join(S.option_labels(_pick(k, *shapes)), ",").alias("labels"))


@query("S32 S33", """SELECT n_nationkey AS id, 'Region' AS label, CAST(n_regionkey AS VARCHAR) AS value FROM nation WHERE n_nationkey % 3 < 2 UNION ALL SELECT n_nationkey, 'Name', n_name FROM nation WHERE n_nationkey % 3 <> 1 UNION ALL SELECT n_nationkey, 'Empty', '' FROM nation WHERE n_nationkey % 3 = 1""")
def html_pairs(t: Tables):
    """Labels and values of tables and definition lists of three shapes: both, a table with an empty cell, a list in upper case."""
    key, name = F.col("n_regionkey").cast("string"), F.col("n_name")
    both = F.concat(F.lit("<table><tr><th>Region</th><td><b>"), key, F.lit("</b></td></tr></table><dl><dt>Name</dt><dd>"), name, F.lit("</dd></dl>"))
    table = F.concat(F.lit('<TABLE><tr><td class="k"> Region </td> <td>'), key, F.lit("</td></tr><tr><th>Empty</th><td> </td></tr><tr><td>alone</td></tr></TABLE>"))
    upper = F.concat(F.lit("<p>x</p><DL><DT>Name</DT>\n<DD><i>"), name, F.lit("</i></DD></DL>"))
    return html.pairs(t.nation.select(F.col("n_nationkey").alias("id"), _pick(F.col("n_nationkey"), both, table, upper).alias("html")), "id", "html")


@query("S16 S17 S18", """SELECT s_suppkey AS id, CASE s_suppkey % 4 WHEN 0 THEN s_name WHEN 1 THEN 'Dr. ' || s_name WHEN 2 THEN '' END AS name, CASE s_suppkey % 4 WHEN 0 THEN 'mail' || s_suppkey || '@x.org' END AS email, CASE WHEN s_suppkey % 4 < 2 THEN 'Research|' || s_nationkey ELSE '' END AS sections FROM supplier""")
def profile_pages(t: Tables):
    """Profiles in HTML: name, contact, and sections by heading; some pages lack parts, one in four is empty."""
    k = F.col("s_suppkey")
    section = F.concat(F.lit("<section><h2>Research</h2><p>"), F.col("s_nationkey").cast("string"), F.lit("</p></section>"))
    whole = F.concat(F.lit("<h1> "), "s_name", F.lit(' </h1><a href="mailto:mail'), k.cast("string"), F.lit('@x.org">write</a>'), section)
    page = _pick(k, whole, F.concat(F.lit("<h1><small>Dr.</small> "), "s_name", F.lit("</h1>"), section), F.lit("<h1></h1><section><h2>Empty</h2></section>"), F.lit(None).cast("string"))
    return html.profiles(t.supplier.select(k.alias("id"), page.alias("html")), "id", "html").select("id", "name", "email", F.array_join(F.transform("sections", lambda s: F.concat_ws("|", s["title"], s["text"])), ";").alias("sections"))


@query("P08 X14 C02", """SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS rating, trim(p_name || CASE WHEN p_partkey % 3 = 0 THEN ' & more' ELSE '' END) AS content, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'T' || p_partkey % 6 END AS author,
CASE p_partkey % 3 WHEN 0 THEN '2024秋' WHEN 1 THEN '2024春' ELSE '2024夏' END AS term, CASE WHEN p_size * 2 <= 33 THEN 'Hard' WHEN p_size * 2 <= 67 THEN 'Average' ELSE 'Easy' END AS difficulty FROM part""")
def course_reviews(t: Tables):
    """Reviews in JSON as typed rows: number, text without HTML, author, term by name, difficulty by label."""
    k, size = F.col("p_partkey"), F.col("p_size")
    body = F.to_json(F.struct(
        k.alias("id"), F.when(k % 5 == 0, "none").otherwise(F.concat(F.lit(" "), size.cast("string"))).alias("rate"), F.concat(F.lit("<p>"), "p_name", F.when(k % 3 == 0, " &amp; <b>more</b>").otherwise(""), F.lit("</p>")).alias("content"),
        F.when(k % 4 != 0, F.struct(F.concat(F.lit("T"), (k % 6).cast("string")).alias("name"))).alias("author"), F.concat(F.lit("2024"), (k % 3 + 1).cast("string")).alias("term"), (size * 2).alias("difficulty"),
    ))
    return N.review_rows(t.part.select(body.alias("body")), "body")


@query("P12 P13", """SELECT c_custkey AS id, '{"name":"' || left(c_name, 1) || repeat('*', length(c_name) - 1) || '"' || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ',"segment":"' || c_mktsegment || '"' END || '}' AS record FROM customer""")
def masked_identity(t: Tables):
    """Records of the fields that may be shown, the name masked, members without a value left out."""
    rows = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 3 == 0, " ").otherwise(F.col("c_mktsegment")).alias("segment"), F.col("c_acctbal").cast("string").alias("secret"))
    return rows.select("id", N.identity(rows, ("name", "segment"), masked=("name",)).alias("record"))


@query("J39 J18", """WITH h(name, lo, hi) AS (VALUES ('a', DATE '1995-01-28', DATE '1995-02-06'), ('b', DATE '1995-02-05', DATE '1995-02-07'), ('c', DATE '1996-09-30', DATE '1996-10-07')), w AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT day, count(name) AS holidays, coalesce(string_agg(name, ',' ORDER BY name), '') AS names FROM w LEFT JOIN h ON lo <= day + 13 AND hi >= day GROUP BY 1""")
def holidays_ahead(t: Tables):
    """The different holidays in the fortnight from each day."""
    h = t.rows([("a", "1995-01-28", "1995-02-06"), ("b", "1995-02-05", "1995-02-07"), ("c", "1996-09-30", "1996-10-07")], "name string, lo string, hi string").select("name", F.col("lo").cast("date").alias("lo"), F.col("hi").cast("date").alias("hi"))
    days = t.orders.select(F.to_date("o_orderdate").alias("day")).distinct()
    met = intervals.in_window(days, h, 14)
    return met.groupBy("day").agg(F.count("name").alias("holidays"), F.array_join(F.array_sort(F.collect_set("name")), ",").alias("names"))


@query("R08", f"""WITH {MEETINGS}, m AS (SELECT code, day, ps, min(section) AS section FROM meetings GROUP BY 1, 2, 3) SELECT code, string_agg(day || ':' || ps || '@' || section, ' ' ORDER BY section) AS meets FROM m GROUP BY 1""")
def distinct_meetings(t: Tables):
    """Meetings of a code, of which those equal in day and period count once, as the first of them."""
    own = meetings(t).groupBy("code").agg(F.array_sort(F.collect_list(F.struct("section", "day", "ps"))).alias("all"))
    text = lambda m: F.concat(m["day"].cast("string"), F.lit(":"), m["ps"].cast("string"), F.lit("@"), m["section"].cast("string"))
    return own.select("code", F.array_join(F.transform(K.distinct_structs("all", ["day", "ps"]), text), " ").alias("meets"))
