"""Queries on calendars put together from several sources, on exams, and on what is on now or next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import scalars as S
from plumbline.operators import agenda as G
from plumbline.operators import intervals
from plumbline.operators.normalize import exam_omission
from plumbline.operators.normalize import provenance as of
from plumbline.plans.adapters import MEETINGS, meetings
from plumbline.plans.catalog import Tables, query

_HOLIDAYS = [("Tomb Sweeping", "2024-04-04", "2024-04-06"), ("Labour", "2024-05-01", "2024-05-05")]
_START = "2024-02-19"


def _holidays(t: Tables) -> DataFrame:
    return t.rows(_HOLIDAYS, "name string, lo string, hi string").select("name", F.col("lo").cast("date").alias("lo"), F.col("hi").cast("date").alias("hi"))


def occurrences(t: Tables) -> DataFrame:
    """section, day_of, ps, pe: meetings by date, without holidays."""
    m = intervals.by_week(meetings(t)).withColumn("day_of", S.date_of(F.col("week"), F.col("day") - 1, F.lit(_START).cast("date")))
    return m.join(F.broadcast(_holidays(t)), F.col("day_of").between(F.col("lo"), F.col("hi")), "left_anti")


_START_MINUTE = "CASE {0} WHEN 1 THEN 480 WHEN 2 THEN 540 WHEN 3 THEN 620 WHEN 4 THEN 680 WHEN 5 THEN 810 WHEN 6 THEN 870 WHEN 7 THEN 930 WHEN 8 THEN 990 WHEN 9 THEN 1080 ELSE 1140 END"
_UTC = lambda day, minute: f"CAST({day} AS TIMESTAMP) + to_minutes(CAST({minute} AS INT)) - INTERVAL 8 HOUR"
_OCCURRENCES = f"""{MEETINGS}, oc AS (SELECT section, room, ps, pe, CAST(DATE '{_START}' + CAST((week - 1) * 7 + day - 1 AS INT) AS DATE) AS day_of FROM slots),
occ AS (SELECT * FROM oc WHERE NOT (day_of BETWEEN DATE '2024-04-04' AND DATE '2024-04-06' OR day_of BETWEEN DATE '2024-05-01' AND DATE '2024-05-05'))"""
#: Exams as a service sends them: dates and times as texts, some of them odd, some of another term.
_EXAMS = """ex AS (SELECT c_custkey AS k, CASE c_custkey % 9 WHEN 4 THEN '2024-06-31' WHEN 7 THEN 'soon' ELSE '2024-06-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') END AS d, CASE c_custkey % 5 WHEN 3 THEN 'morning' ELSE '14:00-' || (15 + c_custkey % 3) || ':30' END AS tm,
  CASE c_custkey % 11 WHEN 5 THEN '' WHEN 6 THEN '2023-2024-1' ELSE '2023-2024-2' END AS sem FROM customer),
er AS (SELECT *, CASE WHEN sem = '' THEN 'term_missing' WHEN sem <> '2023-2024-2' THEN 'term_mismatch' WHEN k % 9 IN (4, 7) THEN 'bad_date' WHEN k % 5 = 3 THEN 'bad_time' END AS reason FROM ex)"""


def _exams(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    day = F.when(k % 9 == 4, "2024-06-31").when(k % 9 == 7, "soon").otherwise(F.concat(F.lit("2024-06-"), F.lpad((k % 28 + 1).cast("string"), 2, "0")))
    hours = F.when(k % 5 == 3, "morning").otherwise(F.concat(F.lit("14:00-"), (15 + k % 3).cast("string"), F.lit(":30")))
    term = F.when(k % 11 == 5, "").when(k % 11 == 6, "2023-2024-1").otherwise("2023-2024-2")
    own = t.customer.select(k.alias("k"), S.iso_date(day).alias("day"), hours.alias("hours"), term.alias("semester"))
    return own.withColumn("at", S.local_range(F.col("day"), F.col("hours")))


def _agenda(t: Tables) -> tuple[DataFrame, DataFrame]:
    minute = S.period_start(F.col("day_of"), F.col("ps"))
    occ = occurrences(t)
    uid = F.concat_ws("-", F.col("section").cast("string"), F.col("day_of").cast("string"), F.concat(F.lit("p"), F.col("ps").cast("string")))
    classes = G.timed_events(occ, "schedule", uid, F.concat(F.lit("section "), F.col("section").cast("string")), S.utc_at(F.col("day_of"), minute), S.utc_at(F.col("day_of"), S.period_start(F.col("day_of"), F.col("pe")) + S.PERIOD_MINUTES))
    exams = _exams(t).withColumn("why", exam_omission(F.col("day"), F.col("at.start"), F.col("semester"), "2023-2024-2"))
    why = exams.select(F.concat_ws("-", F.lit("exams"), F.col("k").cast("string")).alias("uid"), "why")
    exam_events = G.timed_events(exams, "exams", F.col("k"), F.concat(F.lit("exam "), F.col("k").cast("string")), F.col("at.start"), F.col("at.end")).join(why, "uid").select("source", "uid", "summary", "begin", "end", "all_day", "why")
    due = t.orders.select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderdate")).alias("due"))
    deadlines = G.timed_events(due, "deadlines", F.col("k"), F.concat(F.lit("due "), F.col("k").cast("string")), F.col("due"), F.col("due"))
    reason = F.when(F.col("begin").isNull(), "no_due_date")
    drop = lambda df: df.select("source", "uid", "summary", "begin", "end", "all_day")
    kept, left = G.agenda({"schedule": (classes, None), "deadlines": (deadlines, reason), "holidays": (G.holiday_events(_holidays(t)), None)})
    more, out = G.agenda({"exams": (exam_events, F.col("why"))})
    return kept.unionByName(drop(more)), left.unionByName(out)


@query("R14 P28 P29 J34 T06", f"""WITH {_OCCURRENCES}, {_EXAMS}
SELECT 'schedule' AS source, 'schedule-' || section || '-' || CAST(day_of AS VARCHAR) || '-p' || ps AS uid, 'section ' || section AS summary, {_UTC('day_of', _START_MINUTE.format('ps'))} AS begins, {_UTC('day_of', _START_MINUTE.format('pe') + ' + 50')} AS ends, false AS all_day FROM occ
UNION ALL SELECT 'exams', 'exams-' || k, 'exam ' || k, {_UTC('CAST(d AS DATE)', 840)}, {_UTC('CAST(d AS DATE)', '(15 + k % 3) * 60 + 30')}, false FROM er WHERE reason IS NULL
UNION ALL SELECT 'deadlines', 'deadlines-' || o_orderkey, 'due ' || o_orderkey, o_orderdate, o_orderdate, false FROM orders WHERE o_orderkey % 10 <> 0
UNION ALL SELECT 'holiday', 'holiday-' || n || '-' || lo, n, CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) + INTERVAL 1 DAY, true FROM (VALUES ('Tomb Sweeping', '2024-04-04', '2024-04-06'), ('Labour', '2024-05-01', '2024-05-05')) h(n, lo, hi)""")
def calendar_events(t: Tables):
    """Classes, exams, deadlines and holidays as one calendar."""
    return _agenda(t)[0].select("source", "uid", "summary", F.col("begin").alias("begins"), F.col("end").alias("ends"), "all_day")


@query("R14 R15 T08 A29", f"""WITH {_EXAMS} SELECT 'exams' AS source, reason, count(*) AS k FROM er WHERE reason IS NOT NULL GROUP BY ALL UNION ALL SELECT 'deadlines', 'no_due_date', count(*) FROM orders WHERE o_orderkey % 10 = 0""")
def calendar_omissions(t: Tables):
    """What was left out of the calendar, and why."""
    return _agenda(t)[1].groupBy("source", "reason").agg(F.count("*").alias("k"))


@query("R14 A22 T08 T10", f"""WITH {_OCCURRENCES}, {_EXAMS}, n AS (SELECT 'schedule' AS source, count(*) AS e, 0 AS o FROM occ UNION ALL SELECT 'exams', count(*) FILTER (WHERE reason IS NULL), count(reason) FROM er UNION ALL SELECT 'deadlines', count(*) FILTER (WHERE o_orderkey % 10 <> 0), count(*) FILTER (WHERE o_orderkey % 10 = 0) FROM orders UNION ALL SELECT 'holiday', 2, 0 UNION ALL SELECT 'talks', 0, 0)
SELECT source, CAST(e AS BIGINT) AS events, CAST(o AS BIGINT) AS omitted, CASE WHEN o > 0 THEN 'partial' WHEN e > 0 THEN 'ok' ELSE 'empty' END AS status FROM n""")
def calendar_status(t: Tables):
    """Events and omissions of each wanted source."""
    wanted = t.rows([("schedule",), ("exams",), ("deadlines",), ("holiday",), ("talks",)], "source string")
    return G.agenda_status(*_agenda(t), wanted)


@query("J22 J23", f"""WITH {_OCCURRENCES}, o AS (SELECT room, section || '-' || CAST(day_of AS VARCHAR) AS uid, {_UTC('day_of', _START_MINUTE.format('ps'))} AS b, {_UTC('day_of', _START_MINUTE.format('pe') + ' + 50')} AS e FROM occ),
q AS (SELECT DISTINCT CAST(event_id % 200 AS INT) AS room, ts + INTERVAL 50 DAY AS moment FROM events WHERE event_id % 3 = 0),
p AS (SELECT q.*, (SELECT max((b, e, uid)) FROM o WHERE o.room = q.room AND b <= moment) AS l, (SELECT min((b, e, uid)) FROM o WHERE o.room = q.room AND b > moment) AS a FROM q)
SELECT room, moment, CASE WHEN moment < l[2] THEN l[3] END AS on_now, CASE WHEN moment < l[2] THEN NULL ELSE a[3] END AS next FROM p""")
def room_agenda(t: Tables):
    """For rooms and instants the meeting that is on, else the next one, holidays left out."""
    day, ps, pe = F.col("day_of"), F.col("ps"), F.col("pe")
    occ = occurrences(t).select("room", F.concat_ws("-", F.col("section").cast("string"), day.cast("string")).alias("uid"), S.utc_at(day, S.period_start(day, ps)).alias("begin"), S.utc_at(day, S.period_start(day, pe) + S.PERIOD_MINUTES).alias("end"))
    asked = t.events.where("event_id % 3 = 0").select((F.col("event_id") % 200).cast("int").alias("room"), (F.col("ts") + F.expr("interval 50 days")).alias("at")).distinct()
    return G.now_and_next(occ, asked, "room").withColumnRenamed("at", "moment")


@query("J24 J25 A29", f"""WITH {_EXAMS}, c AS (SELECT k % 50 AS owner, 'C' || k AS code, CASE WHEN k % 9 NOT IN (4, 7) THEN CAST(d AS DATE) END AS day, CASE WHEN k % 5 <> 3 THEN 840 END AS f, CASE WHEN k % 5 <> 3 THEN (15 + k % 3) * 60 + 30 END AS u FROM ex WHERE sem = '2023-2024-2'),
r AS (SELECT *, CASE WHEN day IS NULL THEN 'bad_date' WHEN day >= DATE '2024-06-10' AND f IS NULL THEN 'bad_time' END AS reason FROM c),
s AS (SELECT *, reason IS NULL AND f IS NOT NULL AND (day > DATE '2024-06-10' OR (day = DATE '2024-06-10' AND u > 960)) AS come FROM r)
SELECT owner, min((day, f, code)) FILTER (WHERE come)[3] AS code, min((day, f, code)) FILTER (WHERE come)[1] AS day, count(reason) AS omitted FROM s GROUP BY 1""".replace("min((day, f, code)) FILTER (WHERE come)[3]", "(min((day, f, code)) FILTER (WHERE come))[3]").replace("min((day, f, code)) FILTER (WHERE come)[1]", "(min((day, f, code)) FILTER (WHERE come))[1]"))
def upcoming_exams(t: Tables):
    """Each owner's next exam of the term at 16:00 on the tenth of June, one that is still on included; and how many can't be placed."""
    minute = lambda c: F.hour(F.from_utc_timestamp(c, S.ZONE)) * 60 + F.minute(F.from_utc_timestamp(c, S.ZONE))
    own = _exams(t).where("semester = '2023-2024-2'")
    timed = F.col("hours").rlike("^[0-9]")
    begin, end = F.when(timed, F.lit(840)), F.when(timed, F.split_part(F.split_part("hours", F.lit("-"), F.lit(2)), F.lit(":"), F.lit(1)).try_cast("int") * 60 + 30)
    rows = own.select((F.col("k") % 50).alias("owner"), F.concat(F.lit("C"), F.col("k").cast("string")).alias("code"), F.lit("exam").alias("name"), "day", F.coalesce(minute(F.col("at.start")), begin).alias("from_minute"), F.coalesce(minute(F.col("at.end")), end).alias("to_minute"))
    return G.next_exam(G.exam_candidates(rows, F.lit("2024-06-10").cast("date"), F.lit(960)))


_TERMS = [("spring", "2024-02-19", "2024-06-30", 0), ("summer", "2024-06-24", "2024-08-04", 1), ("fall", "2024-09-09", "2025-01-19", 2)]
_TERM_SQL = "tm(name, lo, hi, rnk) AS (VALUES " + ", ".join(f"('{n}', DATE '{a}', DATE '{b}', {k})" for n, a, b, k in _TERMS) + ")"


@query("J19", f"WITH {_TERM_SQL}, d AS (SELECT DISTINCT CAST(DATE '2024-01-01' + CAST(o_orderkey % 400 AS INT) AS DATE) AS day FROM orders) SELECT day, (SELECT arg_min(name, rnk) FROM tm WHERE day BETWEEN lo AND hi) AS term FROM d")
def term_lookup(t: Tables):
    """The term of a day; where two overlap, spring goes before summer and summer before fall."""
    terms = t.rows(_TERMS, "name string, lo string, hi string, rank int").select("name", F.col("lo").cast("date").alias("lo"), F.col("hi").cast("date").alias("hi"), "rank")
    days = t.orders.select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 400).cast("int")).alias("day")).distinct()
    return G.term_of_day(days, terms)


@query("D07 D08", """SELECT event_id AS id, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y%m%dT%H%M%SZ') WHEN 1 THEN strftime(ts - INTERVAL 8 HOUR, '%Y%m%dT%H%M%SZ') END AS stamp FROM events""")
def utc_stamps(t: Tables):
    """ISO dates and times with a zone as stamps; those without a zone, of no day of the calendar or with other text have none."""
    k = F.col("event_id")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(k % 5 == 0, F.concat(iso, F.lit(".5Z"))).when(k % 5 == 1, F.concat(iso, F.lit("+08:00"))).when(k % 5 == 2, iso).when(k % 5 == 3, "2024-02-30T10:00:00Z").otherwise(F.concat(F.lit("at "), iso, F.lit("Z")))
    return t.events.select(k.alias("id"), S.utc_stamp(text).alias("stamp"))


@query("P17 D11 S12", """SELECT p_partkey AS id, array_to_string(list_filter(['COMMUNITY_MAINTAINED', CASE WHEN p_partkey % 4 = 0 THEN 'SOURCE_UPDATE_UNKNOWN' END, CASE WHEN p_partkey % 4 <> 0 AND p_partkey * 5 % 700 >= 365 THEN 'STALE_SOURCE' END], lambda x: x IS NOT NULL), ',') AS advisories FROM part""")
def provenance(t: Tables):
    """Where community pages come from, and what to be wary of: unknown or old updates."""
    k, now = F.col("p_partkey"), F.lit("2024-06-01 00:00:00").cast("timestamp")
    updated = F.when(k % 4 != 0, now - F.make_dt_interval((k * 5 % 700).cast("int")))
    return t.part.select(k.alias("id"), F.array_join(of(F.concat(F.lit("https://x.org/"), k.cast("string")), now, updated)["advisories"], ",").alias("advisories"))
