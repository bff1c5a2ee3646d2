"""Queries on feeds: pages, chunks of time, several sources, and filtered, sorted and paged lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import scalars as S
from plumbline.operators import feeds
from plumbline.operators import keys as K
from plumbline.operators import rank as X
from plumbline.plans.catalog import Tables, query
from plumbline.sources import documents

_ITEM = "struct<id:bigint,price:double>"


def _pages(t: Tables) -> DataFrame:
    """Orders as feeds of five thousand in pages of five hundred: bodies of several shapes, some pages short or broken."""
    k = F.col("o_orderkey")
    feed, page = F.floor(k / 5000), F.floor(k % 5000 / 500) + 1
    rows = t.orders.where(~((feed % 2 == 1) & (k % 5000 == 2077))).groupBy(feed.alias("feed"), page.cast("int").alias("page")).agg(F.sort_array(F.collect_list(F.struct(k.alias("id"), F.col("o_totalprice").alias("price")))).alias("own"))
    shape = F.when(F.col("page") % 3 == 0, F.to_json("own")).when(F.col("page") % 3 == 1, F.to_json(F.struct(F.col("own").alias("rows")))).otherwise(F.to_json(F.struct(F.lit(1).alias("code"), F.col("own").alias("list"))))
    body = F.when((F.col("feed") % 3 == 2) & (F.col("page") == 4), F.substring(shape, 1, 40)).otherwise(shape)
    return rows.select("feed", "page", body.alias("body"), F.when(F.col("feed") == 0, F.lit(1700)).alias("total"))


_PAGES = """k AS (SELECT o_orderkey AS id, o_orderkey // 5000 AS feed, CAST(o_orderkey % 5000 // 500 + 1 AS INT) AS page FROM orders WHERE NOT (o_orderkey // 5000 % 2 = 1 AND o_orderkey % 5000 = 2077)),
n AS (SELECT feed, page, CASE WHEN feed % 3 = 2 AND page = 4 THEN 0 ELSE count(*) END AS n, feed % 3 = 2 AND page = 4 AS bad FROM k GROUP BY feed, page),
h AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY feed ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS have FROM n),
s AS (SELECT *, CASE WHEN bad THEN 'failed' WHEN n < 500 OR have + n >= CASE WHEN feed = 0 THEN 1700 ELSE 4611686018427387904 END THEN 'last' WHEN page >= 8 THEN 'over' ELSE 'read' END AS status FROM h),
r AS (SELECT *, coalesce(max(CASE WHEN status <> 'read' THEN 1 ELSE 0 END) OVER (PARTITION BY feed ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ended FROM s)"""


@query("S01 S02 S25 S26", f"WITH {_PAGES} SELECT k.feed, k.page, k.id FROM k JOIN r ON k.feed = r.feed AND k.page = r.page WHERE ended = 0 AND NOT bad")
def page_items(t: Tables):
    """Items of the pages that scans read until they end."""
    read = feeds.read_pages(_pages(t), _ITEM, 500, 8)
    return read.select("feed", "page", F.explode("items").alias("x")).select("feed", "page", "x.id")


@query("S01 S02 S30 T08", f"WITH {_PAGES} SELECT feed, count(*) AS pages, CAST(sum(n) AS BIGINT) AS items, CASE max(CASE WHEN status <> 'read' THEN status END) WHEN 'last' THEN 'complete' WHEN 'failed' THEN 'failed' WHEN 'over' THEN 'over' ELSE 'open' END AS status FROM r WHERE ended = 0 GROUP BY 1")
def page_status(t: Tables):
    """How each scan ended: short page, declared total, broken page, or too many pages."""
    return feeds.feed_status(feeds.read_pages(_pages(t), _ITEM, 500, 8))


@query("S07", f"WITH {_PAGES}, o AS (SELECT feed, id, page, row_number() OVER (PARTITION BY feed ORDER BY id) AS place FROM k) SELECT o.feed, o.id FROM o JOIN r ON o.feed = r.feed AND o.page = r.page WHERE place <= 1250 AND ended = 0 AND NOT bad")
def first_cards(t: Tables):
    """Up to 1250 items of each feed: no page is read after the one in which they are complete."""
    read = feeds.read_pages(_pages(t), _ITEM, 500, 8, limit=1250)
    return read.select("feed", F.explode("items").alias("x")).select("feed", "x.id")


@query("S06 R02", """WITH e AS (SELECT user_id, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INT) AS pos, count(*) OVER (PARTITION BY user_id) AS total FROM events),
p AS (SELECT user_id, event_id, pos // 7 + 1 AS page, total FROM e UNION ALL SELECT user_id, event_id, pos // 7 + 2, total FROM e WHERE pos % 7 = 6),
w AS (SELECT * FROM p WHERE page <= least(greatest(CAST(ceil(total / 7.0) AS INT), 1), 20))
SELECT user_id AS course, event_id AS review, min(page) AS page FROM w GROUP BY ALL""")
def review_pages(t: Tables):
    """Reviews in pages whose number follows from the first page's total; one that comes again on the next page counts once."""
    w = Window.partitionBy("user_id")
    e = t.events.select("user_id", "event_id", (F.row_number().over(w.orderBy("event_id")) - 1).alias("pos"), F.count("*").over(w).alias("total"))
    page = F.floor(F.col("pos") / 7).cast("int")
    pages = e.withColumn("page", page + 1).unionByName(e.where("pos % 7 = 6").withColumn("page", page + 2)).where(F.col("page") <= feeds.page_count(F.col("total"), 7, 20))
    return K.keep_one(pages, ["user_id", "event_id"], [F.col("page")]).select(F.col("user_id").alias("course"), F.col("event_id").alias("review"), "page")


@query("S28 S29 T08 A22 J43", """WITH e AS (SELECT event_type AS source, event_id % 97 <> 0 AND event_type <> 'error' AS good FROM events), g AS (SELECT source, count(*) FILTER (WHERE good) AS items, count(*) FILTER (WHERE NOT good) AS failed FROM e GROUP BY 1),
w AS (SELECT DISTINCT event_type AS source FROM events UNION SELECT 'mail')
SELECT source, coalesce(items, 0) AS items, coalesce(failed, 0) AS failed, CASE WHEN items IS NULL THEN 'missing' WHEN failed = 0 THEN 'ok' WHEN items > 0 THEN 'partial' ELSE 'error' END AS status FROM w LEFT JOIN g USING (source)""")
def source_union(t: Tables):
    """Several sources read together: a body that can't be parsed fails alone, and each wanted source has a status."""
    broken = (F.col("event_id") % 97 == 0) | (F.col("event_type") == "error")
    body = F.when(broken, F.concat(F.lit("oops "), F.substring("props", 2, 9))).otherwise(F.col("props"))
    rows = t.events.select(F.col("event_type").alias("source"), F.from_json(body, "k int")["k"].isNotNull().alias("good"))
    wanted = t.events.select(F.col("event_type").alias("source")).unionByName(t.rows([("mail",)], "source string")).distinct()
    return feeds.source_report(rows, wanted)


@query("S09 S10 R04", """WITH c AS (SELECT range AS chunk, TIMESTAMP '2024-01-01' + range * INTERVAL 7 DAY AS lo, TIMESTAMP '2024-01-02' + (range + 1) * INTERVAL 7 DAY AS hi FROM range(5) WHERE range <> 2)
SELECT event_id, max(chunk) AS chunk FROM events JOIN c ON ts BETWEEN lo AND hi GROUP BY 1""")
def chunked_items(t: Tables):
    """Events by chunks of a week that overlap by a day, of which one failed: each event once, from the last chunk."""
    start = F.lit("2024-01-01").cast("timestamp")
    chunks = t.spark.range(5).select(F.col("id").alias("chunk"), (start + F.make_dt_interval(F.col("id").cast("int") * 7)).alias("lo"), (start + F.make_dt_interval(F.col("id").cast("int") * 7 + 8)).alias("hi"), (F.col("id") != 2).alias("ok"))
    return feeds.chunked(t.events.select("event_id", "ts"), chunks, "ts", "event_id").select("event_id", "chunk")


@query("S08", """SELECT o_custkey % 300 AS code, arg_max(o_orderpriority, o_orderkey) AS label, CAST(max(o_orderkey % 120) AS BIGINT) AS capacity FROM orders WHERE o_orderkey % 23 <> 0 GROUP BY 1""")
def room_catalog(t: Tables):
    """Rooms by code: the latest row, with the largest capacity that any row gave; rows without a label don't count."""
    k = F.col("o_orderkey")
    rows = t.orders.select((F.col("o_custkey") % 300).alias("code"), k.alias("n"), F.when(k % 23 == 0, "").otherwise(F.col("o_orderpriority")).alias("label"), (k % 120).alias("capacity")).where("label <> ''")
    return rows.groupBy("code").agg(F.max_by("label", "n").alias("label"), F.max("capacity").alias("capacity"))


@query("S34 F03 O08", """WITH r AS (SELECT o_orderkey AS id, o_orderdate AS begins FROM orders WHERE o_custkey % 2 = 0 AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-12-31')
SELECT id, begins, (SELECT count(*) FROM r) AS total, (SELECT count(*) FROM r) > 60 AS has_more FROM r ORDER BY begins DESC, id LIMIT 20 OFFSET 40""")
def reservations(t: Tables):
    """The third page of reservations between two dates, latest first."""
    rows = t.orders.where((F.col("o_custkey") % 2 == 0) & F.to_date("o_orderdate").between(F.lit("1996-01-01").cast("date"), F.lit("1997-12-31").cast("date"))).select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("begins"))
    return K.paged(rows, [F.col("begins").desc(), F.col("id")], 3, 20)


_SORTS = {"helpful": ["helpful"], "newest": ["at"], "rating": ["rating"], "size": ["size"], "id": ["id"]}


@query("S35 O07", """WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_shipdate AS at, CAST(l_quantity AS BIGINT) % 5 + 1 AS rating, CAST(floor(l_extendedprice) AS BIGINT) % 50 AS helpful FROM lineitem WHERE year(l_shipdate) = 1997)
SELECT id, rating, helpful, (SELECT count(*) FROM r WHERE rating = 4) AS total, (SELECT count(*) FROM r WHERE rating = 4) > 60 AS has_more FROM r WHERE rating = 4 ORDER BY helpful DESC, id LIMIT 30 OFFSET 30""")
def review_list(t: Tables):
    """Reviews of one term and rating, by helpfulness (one of five ways to sort), the second page."""
    reviews = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_shipdate").alias("at"), (F.col("l_quantity").cast("long") % 5 + 1).alias("rating"), (F.floor("l_extendedprice").cast("long") % 50).alias("helpful"), F.col("l_quantity").alias("size"))
    some = reviews.where((F.year("at") == 1997) & (F.col("rating") == 4))
    return K.paged(some.select("id", "rating", "helpful"), [*K.sort_by(some, "helpful(desc)", _SORTS), F.col("id")], 2, 30)


@query("S36 O08", """WITH m AS (SELECT conv_id, turn, role FROM conversations WHERE conv_id % 3 = 1 AND role = 'user' AND turn % 4 <> 0 AND length(coalesce(text, '')) % 2 = 0)
SELECT conv_id, turn, role, (SELECT count(*) FROM m) AS total, (SELECT count(*) FROM m) > 20 AS has_more FROM m ORDER BY conv_id, turn LIMIT 20""")
def message_scan(t: Tables):
    """Unread messages of a group, a user and a status, by page."""
    is_read = F.length(F.coalesce("text", F.lit(""))) % 2 == 1
    rows = t.conversations.select("conv_id", "turn", "role", (F.col("conv_id") % 3).alias("group_id"), F.when(F.col("turn") % 4 == 0, "draft").otherwise("published").alias("status"), is_read.alias("is_read"))
    wanted = {"group_id": 1, "role": "user", "status": "published", "is_read": False}
    return K.paged(K.where_equal(rows, wanted).select("conv_id", "turn", "role"), [F.col("conv_id"), F.col("turn")], 1, 20)


@query("F06 A07 O05 J28", """WITH l AS (SELECT l_orderkey AS k, l_shipdate, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'completed' WHEN l_returnflag = 'A' THEN 'submitted' WHEN l_linestatus = 'O' THEN 'open' ELSE 'other' END AS st FROM lineitem),
a AS (SELECT k, count(*) AS total, count(CASE WHEN st = 'completed' THEN 1 END) AS completed, count(CASE WHEN st = 'submitted' THEN 1 END) AS submitted, count(CASE WHEN st = 'open' THEN 1 END) AS open, max(l_shipdate) AS latest, arg_max(st, (l_shipdate, l_linenumber, st)) AS last FROM l GROUP BY 1),
s AS (SELECT k, total, latest, CASE WHEN last IN ('completed', 'submitted') THEN CASE WHEN open > 0 THEN 'mixed' ELSE last END WHEN last = 'open' THEN CASE WHEN submitted + completed > 0 THEN 'mixed' ELSE 'in_progress' END
  WHEN open > 0 AND submitted + completed > 0 THEN 'mixed' WHEN completed > 0 THEN 'completed' WHEN submitted > 0 THEN 'submitted' ELSE 'x' END AS state FROM a)
SELECT k AS id, latest, total FROM s JOIN orders ON o_orderkey = k WHERE state = 'submitted' ORDER BY latest DESC NULLS LAST, k LIMIT 100""")
def submitted_grades(t: Tables):
    """The hundred latest active assignments that were attempted and are in the state submitted."""
    from plumbline.plans.records import derived_state

    rows = derived_state(t).where((F.col("total") > 0) & (F.col("state") == "submitted"))
    return rows.orderBy(F.col("latest").desc_nulls_last(), "id").limit(100).select("id", "latest", "total")


@query("F07", """SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 6 IN (0, 4)""")
def pending_rows(t: Tables):
    """Rows of a status that stands for several codes."""
    rows = t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 6).cast("string").alias("code"))
    return rows.where(K.in_status(F.col("code"), "pending", {"pending": ["0", "4"], "draft": ["3"]})).select("id")


@query("F08 O06 D15", """WITH e AS (SELECT event_id AS id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS begins FROM events)
SELECT id, CASE WHEN begins IS NULL THEN 'unknown' WHEN begins > TIMESTAMP '2024-01-20' THEN 'upcoming' ELSE 'started' END AS timing FROM e WHERE begins IS NULL OR begins > TIMESTAMP '2024-01-20'""")
def timing_filter(t: Tables):
    """What is to come or has no time that could be read; an instant that is now has started."""
    at = F.when(F.col("event_id") % 7 != 0, F.col("ts"))
    timing = K.timing(at, F.lit("2024-01-20").cast("timestamp"))
    return t.events.select(F.col("event_id").alias("id"), timing.alias("timing")).where("timing <> 'started'")


@query("F11", """WITH o AS (SELECT o_orderkey AS id, CASE o_orderkey % 8 WHEN 0 THEN '2024-20251' WHEN 1 THEN 'x 2024秋季' WHEN 2 THEN '2025秋季学期' WHEN 3 THEN '2024-2025学年秋季' WHEN 4 THEN '2024春季' WHEN 5 THEN '2024-2025' WHEN 6 THEN '2024-2025-1' ELSE '' END AS label FROM orders)
SELECT id, label, CASE WHEN contains(label, '2024-2025-1') OR contains(label, '2024-20251') OR contains(label, '2024秋季') OR contains(label, '2025秋季') OR (contains(label, '2024-2025') AND contains(label, '秋季')) THEN true ELSE false END AS fits FROM o""")
def term_matches(t: Tables):
    """Which labels name the first term of 2024-2025, in any of their spellings."""
    labels = ["2024-20251", "x 2024秋季", "2025秋季学期", "2024-2025学年秋季", "2024春季", "2024-2025", "2024-2025-1", ""]
    label = F.get(F.array(*[F.lit(x) for x in labels]), (F.col("o_orderkey") % 8).cast("int"))
    return t.orders.select(F.col("o_orderkey").alias("id"), label.alias("label"), S.names_term(label, "2024-2025", 1).alias("fits"))


@query("F26 S24", "SELECT p_partkey AS id FROM part WHERE p_brand = 'Brand#13' AND contains(lower(p_type || chr(10) || p_name), 'eco')")
def registry_search(t: Tables):
    """Entries of one kind whose command or summary holds the text."""
    return t.part.where((F.col("p_brand") == "Brand#13") & F.lower(F.concat_ws("\n", "p_type", "p_name")).contains("eco")).select(F.col("p_partkey").alias("id"))


@query("F20", "SELECT p_name AS name, count(*) AS rows, CASE WHEN count(*) = 1 THEN 'found' ELSE 'ambiguous' END AS outcome FROM part GROUP BY 1")
def sole_rows(t: Tables):
    """Names that one row has, and those that more than one has."""
    return K.sole(t.part.select(F.col("p_name").alias("name")), ["name"])


@query("J30", """WITH m AS (SELECT n_name, s_suppkey, row_number() OVER (ORDER BY n_nationkey, s_suppkey) AS place FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE contains(lower(s_name), '1') OR contains(lower(s_name), '7')) SELECT n_name AS department, s_suppkey AS id FROM m WHERE place <= 25""")
def cross_department(t: Tables):
    """The first 25 people over all departments, in their order, whose card holds one of the terms."""
    cards = t.supplier.where(F.lower("s_name").contains("1") | F.lower("s_name").contains("7"))
    met = cards.join(F.broadcast(t.nation.select("n_nationkey", "n_name")), F.col("s_nationkey") == F.col("n_nationkey"))
    return met.orderBy("n_nationkey", "s_suppkey").limit(25).select(F.col("n_name").alias("department"), F.col("s_suppkey").alias("id"))


@query("O16", "SELECT p_partkey AS id, row_number() OVER (ORDER BY CASE WHEN p_brand = 'Brand#13' THEN 0 ELSE 1 END, p_partkey) AS place FROM part QUALIFY place <= 100")
def preferred_first(t: Tables):
    """Rows of the preferred key first, otherwise in their order."""
    top = t.part.orderBy(F.when(F.col("p_brand") == "Brand#13", 0).otherwise(1), "p_partkey").limit(100)
    return K.preferred_first(top, "p_brand", "Brand#13", [F.col("p_partkey")]).select(F.col("p_partkey").alias("id"), "place")


@query("O17", """WITH v AS (SELECT p_partkey AS id, 'v' || p_partkey % 12 || '.' || p_size || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '.' || p_partkey % 7 END || CASE WHEN p_partkey % 5 = 0 THEN '-rc1' ELSE '' END AS version, p_partkey % 12 AS a, p_size AS b, CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE p_partkey % 7 END AS c FROM part)
SELECT id, version, (a, b, c) >= (4, 20, 3) AS supported FROM v""")
def version_check(t: Tables):
    """Versions compared by their numbers."""
    k = F.col("p_partkey")
    version = F.concat(F.lit("v"), (k % 12).cast("string"), F.lit("."), F.col("p_size").cast("string"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("."), (k % 7).cast("string"))), F.when(k % 5 == 0, "-rc1").otherwise(""))
    return t.part.select(k.alias("id"), version.alias("version"), (K.version_parts(version) >= K.version_parts(F.lit("4.20.3"))).alias("supported"))


@query("O14 Y07", "SELECT event_type AS handler, count(*) AS k, row_number() OVER (ORDER BY count(*) DESC, event_type) AS place FROM events GROUP BY 1")
def counted_entries(t: Tables):
    """Entries of a count map, the most frequent first."""
    return t.events.groupBy(F.col("event_type").alias("handler")).agg(F.count("*").alias("k")).withColumn("place", F.row_number().over(Window.orderBy(F.col("k").desc(), "handler")).cast("long"))


@query("O11", "SELECT n_nationkey AS id, row_number() OVER (ORDER BY CASE n_nationkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 5 WHEN 2 THEN 4 WHEN 3 THEN 2 ELSE 3 END, n_nationkey) AS place FROM nation")
def locale_order(t: Tables):
    """Names in the order of a Chinese reader (by sound), which isn't that of their code points."""
    names = ["阿里", "中山", "王府", "北京", "海南"]
    name = F.get(F.array(*[F.lit(x) for x in names]), (F.col("n_nationkey") % 5).cast("int"))
    place = F.row_number().over(Window.orderBy(K.by_locale(name), "n_nationkey")).cast("long")
    return t.nation.select(F.col("n_nationkey").cast("int").alias("id"), place.alias("place"))


def served_page(page: int, size: int) -> list[tuple]:
    """What the service below serves: 480 rows in all, each page's last row once more on the next page."""
    first = (page - 1) * size
    again = [(first - 1, page)] if page > 1 else []
    return again + [(i, page) for i in range(first, min(first + size, 480))]


@query("S05 S30 R02", "SELECT CAST(range AS BIGINT) AS id, CAST(range // 50 + 1 AS INT) AS page FROM range(480)")
def fan_out_pages(t: Tables):
    """Ten pages of a service, read side by side through a Python data source, a partition a page; a row that comes twice
    counts where it came first."""
    t.spark.dataSource.register(documents.PagedSource)
    source = t.spark.read.format("paged").option("columns", "id long, page int").option("pages", 10).option("size", 50)
    rows = source.option("reader", "plumbline.plans.feeds:served_page").load()
    return rows.groupBy("id").agg(F.min("page").alias("page"))


@query("T04 A24", """WITH o AS (SELECT o_custkey AS target, o_orderkey AS k, o_orderstatus AS s, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders), f AS (SELECT target, min(n) FILTER (WHERE s IN ('O', 'P')) AS stop FROM o GROUP BY 1),
p AS (SELECT o.* FROM o JOIN f USING (target) WHERE n <= 4 AND n <= coalesce(stop, 4))
SELECT target, count(*) AS polls, CASE WHEN count(*) FILTER (WHERE s = 'P') > 0 THEN 'still_uncertain' WHEN arg_max(s, n) = 'O' THEN 'applied' WHEN count(*) FILTER (WHERE s = 'F') >= 2 AND count(*) FILTER (WHERE s = 'O') = 0 THEN 'not_applied' ELSE 'still_uncertain' END AS verdict FROM p GROUP BY 1""")
def polled_verdict(t: Tables):
    """Read-backs in order, four at most and none after a decisive one, and the verdict on them."""
    s = F.when(F.col("o_orderstatus") == "O", "desired").when(F.col("o_orderstatus") == "F", "inverse").otherwise("conflict")
    rows = t.orders.select(F.col("o_custkey").alias("target"), F.col("o_orderkey").alias("n"), s.alias("seen"))
    return X.polled(rows, 4)
