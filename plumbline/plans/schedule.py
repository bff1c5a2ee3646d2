"""Queries on meetings, rooms, calendars and timetables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import scalars as S
from plumbline.operators import asof, intervals, solver
from plumbline.plans.adapters import MEETINGS, meetings, meetings_sql
from plumbline.plans.catalog import Tables, query


@query("J01 J02 Y01 R10", f"""WITH {MEETINGS} SELECT DISTINCT a.section AS section_a, b.section AS section_b FROM slots a JOIN slots b
ON a.room = b.room AND a.day = b.day AND a.week = b.week AND a.ps <= b.pe AND b.ps <= a.pe AND a.section < b.section""")
def conflict_pairs(t: Tables):
    """Meetings of one room that take place at once."""
    m = meetings(t)
    return intervals.conflict_pairs(m, m, ("room", "day"))


@query("J06 J05 F10 J07", f"WITH {MEETINGS} SELECT DISTINCT room FROM meetings WHERE room NOT IN (SELECT room FROM slots WHERE week = 5 AND day = 3 AND ps <= 4 AND pe >= 3)")
def free_rooms(t: Tables):
    m = meetings(t)
    return intervals.free_rooms(m.select("room").distinct(), m, 5, 3, 3, 4)


@query("J05 J07", f"WITH {MEETINGS} SELECT room, section, ps, pe FROM slots WHERE week = 5 AND day = 3 AND ps <= 4 AND pe >= 3")
def room_occupancy(t: Tables):
    return intervals.occupied(meetings(t), 5, 3, 3, 4).select("room", "section", "ps", "pe")


@query("A03 C13", f"WITH {MEETINGS} SELECT 'R' || room AS name, max(section % 120 + 1) AS capacity, count(*) AS slots, count(DISTINCT code) AS codes FROM meetings GROUP BY 1")
def room_rollup(t: Tables):
    return meetings(t).groupBy(F.concat(F.lit("R"), F.col("room").cast("string")).alias("name")).agg(F.max(F.col("section") % 120 + 1).alias("capacity"), F.count("*").alias("slots"), F.countDistinct("code").alias("codes"))


@query("J03 G07", f"""WITH {MEETINGS} SELECT section FROM meetings WHERE NOT ((day = 1 AND ps <= 4 AND pe >= 1) OR (day = 4 AND ps <= 9 AND pe >= 7))""")
def unblocked_meetings(t: Tables):
    """Meetings outside MON:1-4 and THU:7-9 (blocks given as text, twice and mixed)."""
    specs = t.rows([("MON:1-4",), ("thu:7-9",), ("MONDAY:1-4",), ("FUN:1-2",), ("TUE:9-20",)], "spec string")
    blocks = specs.select(S.block_of(F.col("spec")).alias("b")).where("b is not null").select("b.*").distinct()
    return intervals.unblocked(meetings(t), F.broadcast(blocks)).select("section")


@query("J08 J09 F17", """WITH b AS (SELECT user_id % 100 AS room, ts AS b0, ts + INTERVAL 20 MINUTE AS b1 FROM events WHERE event_id % 2 = 0),
q AS (SELECT event_id AS id, user_id % 100 AS room, ts AS s, ts + INTERVAL 30 MINUTE AS e, hour(ts) * 60 + minute(ts) AS m FROM events WHERE event_id % 2 = 1),
w AS (SELECT *, hour(e) * 60 + minute(e) AS n FROM q)
SELECT id, w.room, count(b0) AS overlaps, CASE WHEN NOT ((m >= 360 AND n <= 720) OR (m >= 750 AND n <= 1320)) OR w.room % 10 = 9 THEN 'unavailable' WHEN count(b0) > 0 THEN 'occupied' ELSE 'available' END AS status
FROM w LEFT JOIN b ON w.room = b.room AND b0 < e AND b1 > s GROUP BY id, w.room, s, e, m, n""")
def half_open_overlap_status(t: Tables):
    """Asked times (odd events) against bookings (even events) of a room, open from 6:00 to 12:00 and from 12:30 to 22:00;
    of every tenth room the bookings aren't all known."""
    e = t.events.select("event_id", (F.col("user_id") % 100).alias("room"), F.col("ts").alias("begin"))
    booked = e.where("event_id % 2 = 0").select("room", "begin", (F.col("begin") + F.expr("interval 20 minutes")).alias("end"))
    asked = e.where("event_id % 2 = 1").select(F.col("event_id").alias("id"), "room", "begin", (F.col("begin") + F.expr("interval 30 minutes")).alias("end"), (F.col("room") % 10 != 9).alias("complete"))
    return intervals.slot_status(asked, booked, [(360, 720), (750, 1320)], "complete").select("id", "room", "overlaps", "status")


@query("J16 X06", f"""WITH {MEETINGS}, anchor AS (SELECT day, week, ps, pe, section FROM slots WHERE code = 1),
hit AS (SELECT DISTINCT s.section FROM slots s JOIN anchor a ON s.day = a.day AND s.week = a.week AND s.ps <= a.pe AND a.ps <= s.pe AND s.code <> 1)
SELECT code, count(*) AS sections, count(hit.section) AS conflicting, count(hit.section) = count(*) AS all_conflict FROM meetings LEFT JOIN hit USING (section) WHERE code <> 1 GROUP BY code""")
def code_division_conflict(t: Tables):
    """Codes all of whose sections conflict with a section of code 1."""
    return intervals.all_conflict(meetings(t), 1)


@query("J39 extra: overlap without an equal key", """WITH i AS (SELECT o_orderkey AS id, date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS a FROM orders),
h(hid, lo, hi) AS (SELECT range, range * 37, range * 37 + 11 FROM range(100))
SELECT hid, count(*) AS k, CAST(sum(id) AS BIGINT) AS ids FROM i JOIN h ON a <= hi AND lo <= a + id % 9 GROUP BY hid""")
def bucketed_overlap(t: Tables):
    """Orders as intervals of days that overlap a hundred windows, joined by bucket."""
    a = F.datediff("o_orderdate", F.lit("1990-01-01")).cast("long")
    orders = t.orders.select(F.col("o_orderkey").alias("id"), a.alias("a"), (a + F.col("o_orderkey") % 9).alias("b"))
    windows = t.spark.range(100).select("id", (F.col("id") * 37).alias("a"), (F.col("id") * 37 + 11).alias("b"))
    return intervals.bucketed_overlap(orders, windows, "a", "b", 16).groupBy(F.col("id_b").alias("hid")).agg(F.count("*").alias("k"), F.sum("id").alias("ids"))


_HOLIDAYS = [("spring", "1995-01-28", "1995-02-06"), ("labour", "1995-05-01", "1995-05-05"), ("autumn", "1996-09-30", "1996-10-07"), ("overlap", "1996-10-05", "1996-10-09")]
_HOLIDAY_SQL = "h(name, lo, hi) AS (VALUES " + ", ".join(f"('{n}', DATE '{a}', DATE '{b}')" for n, a, b in _HOLIDAYS) + ")"


def holidays(t: Tables) -> DataFrame:
    return t.rows(_HOLIDAYS, "name string, lo string, hi string").select("name", F.col("lo").cast("date").alias("lo"), F.col("hi").cast("date").alias("hi"))


@query("J18 J39 F03", f"WITH {_HOLIDAY_SQL} SELECT o_orderkey AS id, (SELECT arg_min(name, lo) FROM h WHERE CAST(o_orderdate AS DATE) BETWEEN lo AND hi) AS holiday FROM orders")
def holiday_lookup(t: Tables):
    """Each order's holiday: of overlapping ones the first."""
    orders = t.orders.select(F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("day"))
    return intervals.range_lookup(orders, "id", holidays(t), F.col("day"), "lo", "hi", ["lo", "name"]).select("id", F.col("name").alias("holiday"))


@query("D02 D03 D04 D06 D09", f"""WITH {_HOLIDAY_SQL}, d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
w AS (SELECT day, isodow(day) - 1 AS wd, CASE WHEN day BETWEEN DATE '1995-02-10' AND DATE '1995-07-01' THEN CAST(floor(date_diff('day', DATE '1995-02-13', day) / 7.0) AS INT) + 1 ELSE 0 END AS week,
  EXISTS (SELECT 1 FROM h WHERE day BETWEEN lo AND hi) AS is_holiday FROM d)
SELECT day, CAST(wd AS INT) AS weekday, CAST(week AS INT) AS week, is_holiday, wd >= 5 AS is_weekend, week > 0 AND NOT is_holiday AND wd < 5 AND week < 18 AS is_teaching,
  CASE WHEN month(day) >= 9 THEN year(day) || '-' || (year(day) + 1) || '-1' WHEN month(day) <= 6 THEN (year(day) - 1) || '-' || year(day) || '-2' ELSE (year(day) - 1) || '-' || year(day) || '-3' END AS term FROM w""")
def day_flags(t: Tables):
    """What each day of the orders is: week of the spring term of 1995, weekend, holiday, teaching day."""
    days = t.orders.select(F.to_date("o_orderdate").alias("day")).distinct()
    lit = lambda x: F.lit(x).cast("date")
    own = intervals.range_lookup(days, "day", holidays(t), F.col("day"), "lo", "hi", ["lo"])
    week = S.week_of(F.col("day"), lit("1995-02-15"), lit("1995-02-10"), lit("1995-07-01"))
    own = own.withColumn("weekday", F.weekday("day")).withColumn("week", week).withColumn("is_holiday", F.col("name").isNotNull())
    teaching = (F.col("week") > 0) & ~F.col("is_holiday") & (F.col("weekday") < 5) & (F.col("week") < 18)
    return own.select("day", "weekday", "week", "is_holiday", (F.col("weekday") >= 5).alias("is_weekend"), teaching.alias("is_teaching"), S.term_of(F.col("day")).alias("term"))


@query("D03 D05 D06", """WITH k AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS d FROM orders), m AS (SELECT id, d, CAST(d - CAST(isodow(d) - 1 AS INT) AS DATE) AS m FROM k)
SELECT id, m AS monday, CAST(m + CAST((id % 16) * 7 + id % 7 AS INT) AS DATE) AS day, CASE WHEN id % 3 = 0 THEN CAST(d - 1 AS DATE) ELSE least(CAST(m + 97 AS DATE), CAST(d + 98 AS DATE)) END AS last_day FROM m""")
def week_dates(t: Tables):
    k, d = F.col("o_orderkey"), F.to_date("o_orderdate")
    finals = F.when(k % 3 == 0, F.array().cast("array<int>")).otherwise(F.array(F.lit(16), F.lit(15)))
    return t.orders.select(k.alias("id"), S.monday(d).alias("monday"), S.date_of(k % 16 + 1, k % 7, d).alias("day"), S.last_teaching_day(d, finals, F.date_add(d, 99)).alias("last_day"))


_PERIOD_SQL = "p(period, s) AS (VALUES " + ", ".join(f"({i}, {m})" for i, m in enumerate(S.OLD_PERIODS, 1)) + ")"


@query("J20 D17", f"""WITH {_PERIOD_SQL} SELECT event_id AS id, (SELECT min(period) FROM p WHERE m >= s AND m < s + 50) AS period FROM (SELECT event_id, CAST(hour(ts) * 60 + minute(ts) AS INT) AS m FROM events)""")
def teaching_period_lookup(t: Tables):
    """The period in which each event falls, end excluded."""
    periods = t.rows([(i, m, m + S.PERIOD_MINUTES) for i, m in enumerate(S.OLD_PERIODS, 1)], "period int, lo int, hi int")
    events = t.events.select(F.col("event_id").alias("id"), (F.hour("ts") * 60 + F.minute("ts")).alias("m"))
    return intervals.range_lookup(events, "id", periods, F.col("m"), "lo", "hi", ["lo"], half_open=True).select("id", "period")


@query("D17 T06", f"""WITH {MEETINGS} SELECT section, CAST(480 + 0 AS INT) * 0 + CASE ps WHEN 1 THEN 480 WHEN 2 THEN 540 WHEN 3 THEN 620 WHEN 4 THEN 680 WHEN 5 THEN 810 WHEN 6 THEN 870 WHEN 7 THEN 930 WHEN 8 THEN 990 ELSE 1080 END AS old_start,
  CASE ps WHEN 1 THEN 480 WHEN 2 THEN 540 WHEN 3 THEN 620 WHEN 4 THEN 680 WHEN 5 THEN 840 WHEN 6 THEN 900 WHEN 7 THEN 980 WHEN 8 THEN 1040 ELSE 1140 END AS new_start, section || '-2026-09-06-p' || ps AS uid FROM meetings""")
def period_clock(t: Tables):
    """Starts of periods before and after the timetable changed."""
    day = lambda x: F.lit(x).cast("date")
    return meetings(t).select("section", S.period_start(day("2026-09-06"), F.col("ps")).alias("old_start"), S.period_start(day("2026-09-07"), F.col("ps")).alias("new_start"), F.concat(F.col("section").cast("string"), F.lit("-2026-09-06-p"), F.col("ps").cast("string")).alias("uid"))


_MAKEUP = [("2024-04-07", 1, 3), ("2024-05-11", 0, 4), ("2024-09-29", 1, 1)]
_MAKEUP_SQL = "mk(day, parity, wd) AS (VALUES " + ", ".join(f"(DATE '{d}', {p}, {w})" for d, p, w in _MAKEUP) + ")"


@query("J21", f"""WITH {_MAKEUP_SQL}, w AS (SELECT CAST(range AS INT) AS week FROM range(1, 17)), c AS (SELECT day, week, CAST(DATE '2024-02-19' + CAST((week - 1) * 7 + wd - 1 AS INT) AS DATE) AS target FROM mk JOIN w ON week % 2 = parity),
f AS (SELECT * FROM c WHERE week IN (4, 7, 10, 11)) SELECT day, week, target FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY abs(date_diff('day', target, day)), week) AS n FROM f) WHERE n = 1""")
def nearest_makeup(t: Tables):
    """Each make-up day's nearest week of its parity in which classes fell out."""
    makeup = t.rows(_MAKEUP, "day string, parity int, wd int").withColumn("day", F.col("day").cast("date"))
    weeks = t.spark.range(1, 17).select(F.col("id").cast("int").alias("week")).where("week in (4, 7, 10, 11)")
    target = S.date_of(F.col("week"), F.col("wd") - 1, F.lit("2024-02-19").cast("date"))
    near = asof.nearest(makeup, weeks, F.abs(F.datediff(target, F.col("day"))), ["day"], [F.col("week")], F.col("week") % 2 == F.col("parity"))
    return near.select("day", "week", target.alias("target"))


@query("J22", """SELECT a.event_id AS id, n.event_id AS next_id FROM events a LEFT JOIN LATERAL (SELECT event_id FROM events b WHERE b.user_id = a.user_id AND b.event_type = 'purchase' AND b.ts > a.ts ORDER BY b.ts, b.event_id LIMIT 1) n ON true""")
def next_event_asof(t: Tables):
    """For each event its user's next purchase."""
    e = t.events.select("user_id", "event_id", "ts", "event_type")
    r = e.where("event_type = 'purchase'")
    return asof.next_after(e.select("user_id", "event_id", "ts"), r, ["user_id"], "ts", ["event_id"]).select(F.col("event_id").alias("id"), F.col("next_event_id").alias("next_id"))


@query("J40 O10", """SELECT o_orderkey AS id, o_orderdate AS due FROM orders WHERE o_orderstatus = 'P' ORDER BY CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN 0 WHEN o_orderdate IS NOT NULL THEN 1 ELSE 2 END, o_orderdate, o_orderkey LIMIT 1""")
def next_pending(t: Tables):
    rows = t.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("due"))
    return asof.next_or_overdue(rows, "due", F.lit("1997-01-01").cast("timestamp"), "id")


@query("J34 T06", f"""WITH {MEETINGS}, c AS (SELECT section, week, day, ps, CAST(DATE '2024-02-19' + CAST((week - 1) * 7 + day - 1 AS INT) AS DATE) AS dt FROM slots)
SELECT section, week, dt, section || '-' || CAST(dt AS VARCHAR) || '-p' || ps AS uid, false AS makeup FROM c WHERE dt NOT BETWEEN DATE '2024-04-04' AND DATE '2024-04-06' AND dt NOT BETWEEN DATE '2024-05-01' AND DATE '2024-05-05'
UNION ALL SELECT section, week, DATE '2024-04-07', section || '-2024-04-07-p' || ps, true FROM slots WHERE day = 5 AND week = 7""")
def expand_occurrences(t: Tables):
    """Meetings by date, without holidays, with those of a make-up day."""
    m = intervals.by_week(meetings(t)).withColumn("at", S.date_of(F.col("week"), F.col("day") - 1, F.lit("2024-02-19").cast("date")))
    off = F.broadcast(t.rows([("2024-04-04", "2024-04-06"), ("2024-05-01", "2024-05-05")], "lo string, hi string").select(F.col("lo").cast("date").alias("lo"), F.col("hi").cast("date").alias("hi")))
    runs = m.join(off, F.col("at").between(F.col("lo"), F.col("hi")), "left_anti").withColumn("makeup", F.lit(False))
    extra = m.where("day = 5 and week = 7").withColumn("at", F.lit("2024-04-07").cast("date")).withColumn("makeup", F.lit(True))
    uid = F.concat(F.col("section").cast("string"), F.lit("-"), F.col("at").cast("string"), F.lit("-p"), F.col("ps").cast("string"))
    return runs.unionByName(extra).select("section", "week", F.col("at").alias("dt"), uid.alias("uid"), "makeup")


_CODES = [1, 2, 4]
_AGG = """CAST(count(DISTINCT week) AS BIGINT) AS aw"""


@query("J04 A16 A17 O01 O02 W01 W08 T09", f"""WITH {meetings_sql("NOT (day = 2 AND ps <= 2)")}, x AS (SELECT DISTINCT LEAST(a.section, b.section) AS s1, GREATEST(a.section, b.section) AS s2 FROM slots a JOIN slots b ON a.day = b.day AND a.week = b.week AND a.ps <= b.pe AND b.ps <= a.pe AND a.section <> b.section
  AND a.code IN (1, 2, 4) AND b.code IN (1, 2, 4)),
k AS (SELECT code, count(*) AS n FROM meetings WHERE code IN (1, 2, 4) GROUP BY 1), o AS (SELECT code, row_number() OVER (ORDER BY n, code) AS pos FROM k),
c AS (SELECT section, pos, row_number() OVER (PARTITION BY code ORDER BY section) AS idx FROM meetings JOIN o USING (code)),
f AS (SELECT a.section AS a, b.section AS b, d.section AS d, row_number() OVER (ORDER BY a.idx, b.idx, d.idx) AS solution FROM c a, c b, c d WHERE a.pos = 1 AND b.pos = 2 AND d.pos = 3
  AND NOT EXISTS (SELECT 1 FROM x WHERE (s1 = LEAST(a.section, b.section) AND s2 = GREATEST(a.section, b.section)) OR (s1 = LEAST(a.section, d.section) AND s2 = GREATEST(a.section, d.section)) OR (s1 = LEAST(b.section, d.section) AND s2 = GREATEST(b.section, d.section)))),
l AS (SELECT * FROM f WHERE solution <= 5000),
m AS (SELECT solution, s.* FROM l JOIN slots s ON s.section IN (a, b, d)),
g AS (SELECT *, greatest(ps - lag(pe) OVER w - 1, 0) AS gap, coalesce(lag(campus) OVER w <> campus, false) AS sw FROM m WINDOW w AS (PARTITION BY solution, week, day ORDER BY ps, pe, campus)),
z AS (SELECT solution, greatest(count(DISTINCT week), 1) AS aw, count(CASE WHEN ps <= 2 THEN 1 END) AS early, count(CASE WHEN gap > 0 THEN 1 END) AS gs, coalesce(sum(gap), 0) AS gp, count(DISTINCT week * 10 + day) AS wd, count(CASE WHEN sw THEN 1 END) AS sw FROM g GROUP BY 1),
r AS (SELECT solution, floor(early / aw * 100 + 0.5) / 100 AS early, floor(gs / aw * 100 + 0.5) / 100 AS gs, floor(gp / aw * 100 + 0.5) / 100 AS gp, floor(wd / aw * 100 + 0.5) / 100 AS wd, floor(sw / aw * 100 + 0.5) / 100 AS sw FROM z),
q AS (SELECT r.*, floor((0 - early * 2 - gs * 5 - gp * 1 - wd * 4 - sw * 6) * 100 + 0.5) / 100 AS total, a || '|' || b || '|' || d AS sections FROM r JOIN l USING (solution))
SELECT row_number() OVER (ORDER BY total DESC, wd, gs, gp, early, sw, sections) AS rank, sections, total, list_sum([CAST(x AS BIGINT) % 4 + 0.5 FOR x IN string_split(sections, '|')])::DOUBLE AS credits, (SELECT count(*) FROM l) AS evaluated, (SELECT count(*) FROM l) >= 5000 AS search_truncated FROM q ORDER BY rank LIMIT 20""")
def timetable_topk(t: Tables):
    """The best twenty timetables of three codes, outside a blocked time, with their credits."""
    blocks = t.rows([("TUE:1-2",)], "spec string").select(S.block_of(F.col("spec")).alias("b")).select("b.*")
    credits = t.orders.select(F.col("o_orderkey").alias("section"), (F.col("o_orderkey") % 4 + 0.5).cast("double").alias("credits"))
    best = solver.timetables(meetings(t), _CODES, 20, blocks=blocks, credits=credits)
    return best.select(F.col("rank").cast("long").alias("rank"), F.array_join(F.transform("sections", lambda s: s.cast("string")), "|").alias("sections"), "total", "credits", "evaluated", "search_truncated")


_ASKED = [1, 2, 4, 3, 5, 900001]


@query("J17 J03 T08", """WITH m AS (SELECT o_orderkey AS section, o_custkey AS code, CAST(o_orderkey % 5 + 1 AS INT) AS day, CAST((o_orderkey // 5) % 9 + 1 AS INT) AS ps, CAST((o_orderkey // 5) % 9 + 1 + o_orderkey % 2 AS INT) AS pe,
  o_orderkey % 7 = 0 AS bare FROM orders), asked(code) AS (VALUES (1), (2), (4), (3), (5), (900001))
SELECT CAST(asked.code AS BIGINT) AS code, count(CASE WHEN NOT bare AND NOT (day = 2 AND ps <= 13 AND pe >= 1) AND NOT (day = 5 AND ps <= 3 AND pe >= 1) THEN 1 END) AS candidates, count(CASE WHEN bare THEN 1 END) AS unscheduled,
  count(CASE WHEN NOT bare AND NOT (day = 2 AND ps <= 13 AND pe >= 1) AND NOT (day = 5 AND ps <= 3 AND pe >= 1) THEN 1 END) = 0 AS missing FROM asked LEFT JOIN m USING (code) GROUP BY 1""")
def missing_codes(t: Tables):
    """Requested codes with how many of their sections can be taken outside the blocked times, and which have none."""
    blocks = t.rows([("TUE:1-13",), ("FRI:1-3",), ("FRI:1-3",)], "spec string").select(S.block_of(F.col("spec")).alias("b")).select("b.*").distinct()
    m = meetings(t).withColumn("weeks", F.when(F.col("section") % 7 == 0, F.array().cast("array<int>")).otherwise(F.col("weeks")))
    return solver.code_report(m, _ASKED, blocks).withColumn("code", F.col("code").cast("long"))


@query("F04 D12 T05", """SELECT event_id AS id, CASE WHEN epoch(TIMESTAMP '2024-01-20 12:00:00') - floor(epoch(ts)) > 10800 THEN 'stale' ELSE 'fresh' END AS freshness FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 7 DAY AND ts <= TIMESTAMP '2024-01-20 12:00:00'""")
def lookback_window(t: Tables):
    """Events of the last seven days before an instant, and whether they are fresh."""
    now = F.lit("2024-01-20 12:00:00").cast("timestamp")
    rows = t.events.where((F.col("ts") >= now - F.expr("interval 7 days")) & (F.col("ts") <= now))
    return rows.select(F.col("event_id").alias("id"), S.freshness(now, F.col("ts")).alias("freshness"))


@query("F05 D13 D14", """SELECT o_orderkey AS id, CAST(date_diff('day', CAST(TIMESTAMP '1997-03-01 20:00:00' + INTERVAL 8 HOUR AS DATE), CAST(o_orderdate + INTERVAL 8 HOUR AS DATE)) AS INT) AS days_left FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-03-01 20:00:00' AND date_diff('day', CAST(TIMESTAMP '1997-03-01 20:00:00' + INTERVAL 8 HOUR AS DATE), CAST(o_orderdate + INTERVAL 8 HOUR AS DATE)) <= 30""")
def due_window(t: Tables):
    """Orders due in the next thirty days of the zone's calendar."""
    now = F.lit("1997-03-01 20:00:00").cast("timestamp")
    left = S.days_left(F.col("o_orderdate"), now)
    return t.orders.where((F.col("o_orderdate") >= now) & (left <= 30)).select(F.col("o_orderkey").alias("id"), left.alias("days_left"))


@query("S10", """SELECT CAST(range AS INT) AS chunk, TIMESTAMP '2024-01-01' + range * INTERVAL 7 DAY AS lo, LEAST(TIMESTAMP '2024-01-01' + (range + 1) * INTERVAL 7 DAY, TIMESTAMP '2024-01-31') AS hi,
  (SELECT count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-01' + range * INTERVAL 7 DAY AND ts < LEAST(TIMESTAMP '2024-01-01' + (range + 1) * INTERVAL 7 DAY, TIMESTAMP '2024-01-31')) AS k FROM range(5)""")
def chunked_range(t: Tables):
    """A range of time in chunks of a week, with the rows of each."""
    chunks = t.spark.range(5).select(F.col("id").cast("int").alias("chunk"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.col("id").cast("int") * 7)).alias("lo"))
    chunks = chunks.withColumn("hi", F.least(F.col("lo") + F.expr("interval 7 days"), F.lit("2024-01-31").cast("timestamp")))
    hits = t.events.groupBy(F.floor(F.datediff("ts", F.lit("2024-01-01")) / 7).cast("int").alias("chunk")).agg(F.count("*").alias("k"))
    return chunks.join(hits, "chunk", "left").select("chunk", "lo", "hi", F.coalesce("k", F.lit(0)).alias("k"))
