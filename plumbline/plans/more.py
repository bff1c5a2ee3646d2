"""Queries on scans, stored documents, rosters and live context."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.functions import scalars as S
from plumbline.operators import normalize as N
from plumbline.plans.catalog import Tables, query
from plumbline.sources import documents, html


@query("S27", "SELECT c_custkey AS id, n_name AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal > 0")
def roster(t: Tables):
    """Members of two roles who are available, with what their nation adds; the filters reach the scan."""
    members = t.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & (F.col("c_acctbal") > 0))
    return members.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("id"), F.col("n_name").alias("nation"))


@query("S17", """SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS title, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE TIMESTAMP '2024-05-01 10:00:00' + s_suppkey * INTERVAL 1 DAY END AS time, 'Hall' AS place FROM supplier""")
def html_cards(t: Tables):
    """Cards of a page, twice each; the first of an id stays, a time that can't be read is unknown."""
    day = F.date_format(F.date_add(F.lit("2024-05-01").cast("date"), F.col("s_suppkey").cast("int")), "yyyy-MM-dd")
    card = lambda title: F.concat(F.lit('<div class="card" data-id="'), F.col("s_suppkey").cast("string"), F.lit('"><h3 class="title">'), title, F.lit('</h3><p class="time">'), F.when(F.col("s_suppkey") % 3 == 0, "soon").otherwise(F.concat(day, F.lit(" 10:00:00"))), F.lit('</p><p class="place">Hall</p></div>'))
    return html.cards(t.supplier.select(F.concat(card(F.col("s_name")), card(F.lit("again"))).alias("html")), "html")


@query("P09 Y08 X14", """SELECT event_id AS id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS rating, CASE WHEN value >= 50 THEN 'high' ELSE 'other' END AS label, CAST(len(json_keys(props)) AS INT) AS points FROM events""")
def normalise_reviews(t: Tables):
    """Reviews from JSON with a distribution map."""
    props = F.from_json("props", "map<string,string>")
    return t.events.select(F.col("event_id").alias("id"), S.number(F.try_element_at(props, F.lit("k"))).alias("rating"), F.when(F.col("value") >= 50, "high").otherwise("other").alias("label"), F.size(F.map_entries(props)).alias("points"))


@query("P25 P14", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'WEEKLY' END AS frequency, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 5 AS INT) END AS interval_ FROM orders""")
def recurrences(t: Tables):
    """Recurrence carried as a struct, null where there is none, not expanded."""
    k = F.col("o_orderkey")
    raw = t.orders.select(k.alias("id"), F.when(k % 3 == 0, F.to_json(F.struct(F.lit("weekly").alias("freq"), (k % 5).alias("interval")))).alias("rule"))
    rule = F.from_json("rule", "struct<freq:string,interval:int>")
    return raw.select("id", F.when(rule["freq"].isNotNull(), F.struct(F.upper(rule["freq"]).alias("frequency"), rule["interval"].alias("interval_"))).alias("r")).select("id", "r.frequency", "r.interval_")


@query("P10 P11 P13", "SELECT o_orderkey AS id, o_orderstatus AS status FROM orders")
def planning_view(t: Tables):
    """Without the columns that planning may not see; nested ones would be an error."""
    return N.planning_view(t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("score"), F.col("o_orderstatus").alias("status")))


@query("J33 C10", """WITH g(gap, credits) AS (VALUES ('urgent', 4), ('low', 2), ('other', 1)) SELECT o_orderkey AS id, gap, credits FROM orders LEFT JOIN g ON gap = regexp_replace(lower(regexp_replace(o_orderpriority, '^[0-9]-', '')), '[ _-]', '', 'g')""")
def gap_labels(t: Tables):
    """Gaps by label in canonical form, so that spelling doesn't matter."""
    gaps = t.rows([("Urgent 课程", 4), ("l o-w", 2), ("Other_模块", 1)], "label string, credits int").select(S.plain_label(F.col("label")).alias("gap"), "credits")
    label = S.plain_label(F.regexp_replace("o_orderpriority", "^[0-9]-", ""))
    return t.orders.select(F.col("o_orderkey").alias("id"), label.alias("__l")).join(F.broadcast(gaps), F.col("__l") == F.col("gap"), "left").select("id", "gap", "credits")


@query("R09", "SELECT DISTINCT o_custkey AS owner, CAST(o_orderdate AS DATE) AS start, o_orderstatus AS title FROM orders WHERE o_orderkey % 11 <> 0")
def distinct_slots(t: Tables):
    """Slots once each, those without a date dropped."""
    day = F.when(F.col("o_orderkey") % 11 == 0, F.lit("?")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select(F.col("o_custkey").alias("owner"), S.iso_date(day).alias("start"), F.col("o_orderstatus").alias("title")).where("start is not null").dropDuplicates(["owner", "start", "title"])


@query("Y06 C13", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'borrowing' WHEN o_orderkey % 3 = 1 THEN 'course' ELSE 'unknown' END AS kind, array_to_string(generate_series(1, 4 + o_orderkey % 3), ',') AS weeks, CAST(3 AS INT) AS ps, 'Library-' || o_orderkey % 9 AS room FROM orders""")
def room_texts(t: Tables):
    """Live texts of rooms, and names with aliases of buildings."""
    k = F.col("o_orderkey")
    text = F.concat(F.when(k % 3 == 0, "【借用】").when(k % 3 == 1, "【本】").otherwise(""), F.lit("[1-"), (4 + k % 3).cast("string"), F.lit("周][J3-4]"))
    x = N.room_text(text)
    return t.orders.select(k.alias("id"), x["kind"].alias("kind"), F.array_join(x["weeks"], ",").alias("weeks"), x["ps"].alias("ps"), N.room_name(F.concat(F.lit("Lib "), (k % 9).cast("string")), {"Lib": "Library-", "L": "Hall-"}).alias("room"))


@query("T10 A22 O10", """SELECT (SELECT arg_min(event_id, (ts, event_id)) FROM events WHERE ts > TIMESTAMP '2024-01-20') AS next_event, (SELECT arg_min(o_orderkey, (o_orderdate, o_orderkey)) FROM orders WHERE o_orderdate > TIMESTAMP '1997-01-01') AS next_order,
'ok,ok,empty' AS statuses""")
def live_context(t: Tables):
    """One row of next items from three sources, each on its own, with their status."""
    at = lambda s: F.lit(s).cast("timestamp")
    e = t.events.where(F.col("ts") > at("2024-01-20")).agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("next_event"))
    o = t.orders.where(F.col("o_orderdate") > at("1997-01-01")).agg(F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("next_order"))
    n = t.events.where("value < -1e9").agg(F.count("*").alias("n"))
    state = lambda c: F.when(c, "ok").otherwise("empty")
    one = e.join(F.broadcast(o), F.lit(True)).join(F.broadcast(n), F.lit(True))  # a row each
    return one.select("next_event", "next_order", F.concat_ws(",", state(F.col("next_event").isNotNull()), state(F.col("next_order").isNotNull()), state(F.col("n") > 0)).alias("statuses"))


@query("W08 O02", "SELECT p_brand AS brand, p_partkey AS id, place FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_size, p_partkey) AS place FROM part) WHERE place <= 3")
def top_three(t: Tables):
    """The three dearest parts of each brand."""
    n = F.row_number().over(Window.partitionBy("p_brand").orderBy(F.col("p_retailprice").desc(), "p_size", "p_partkey")).cast("long")
    return t.part.withColumn("place", n).where("place <= 3").select(F.col("p_brand").alias("brand"), F.col("p_partkey").alias("id"), "place")
