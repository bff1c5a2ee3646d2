"""Queries on reservations and selections: rules before a write, and what is read back after it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import scalars as S
from plumbline.operators import booking as B
from plumbline.operators import intervals
from plumbline.plans.catalog import Tables, query

_NOW = "2024-01-10 12:00:00"


def _names(cases: dict[str, str], name: str) -> str:
    return f"array_to_string(list_filter([{', '.join(f"CASE WHEN {c} THEN '{k}' END" for k, c in cases.items())}], lambda x: x IS NOT NULL), ',') AS {name}"


_BOOKED = "bk AS (SELECT user_id % 100 AS room, ts AS b0, ts + INTERVAL 20 MINUTE AS b1 FROM events WHERE event_id % 2 = 0)"
_ROOM = "found AND e IS NOT NULL"
_MEETING = {
    "TITLE_REQUIRED": "trim(title) = ''", "PARTICIPANTS_INVALID": "participants < 1", "ROOM_NOT_FOUND": "NOT found", "TIME_INVALID": "e IS NULL", "START_IN_PAST": f"b < TIMESTAMP '{_NOW}'", "TIME_ORDER_INVALID": "e <= b",
    "DURATION_EXCEEDS_LIMIT": "e IS NOT NULL AND mins > 480", "MULTI_DAY_UNSUPPORTED": "CAST(b AS DATE) <> CAST(e AS DATE)", "ROOM_UNAVAILABLE": f"{_ROOM} AND p_size % 9 = 0", "PARTICIPANTS_EXCEED_CAPACITY": f"{_ROOM} AND p_size % 12 > 0 AND participants > p_size % 12",
    "ADVANCE_WINDOW_EXCEEDED": f"{_ROOM} AND room % 20 > 0 AND date_diff('day', DATE '{_NOW[:10]}', CAST(b AS DATE)) > room % 20", "OUTSIDE_BOOKABLE_WINDOW": f"{_ROOM} AND NOT (hour(b) * 60 + minute(b) >= 420 + room % 3 * 60 AND hour(e) * 60 + minute(e) <= 1320)",
    "SLOT_OCCUPIED": f"{_ROOM} AND slot = 'occupied'", "SLOT_CHECK_FAILED": f"{_ROOM} AND slot = 'unavailable'",
}


@query("F22 J08", f"""WITH {_BOOKED}, q AS (SELECT event_id AS id, user_id % 100 AS room, CASE WHEN event_id % 11 = 1 THEN ' ' ELSE event_type END AS title, event_id % 14 - 1 AS participants, (event_id % 12 - 1) * 55 AS mins, ts AS b,
  CASE WHEN event_id % 29 <> 0 THEN ts + to_minutes(CAST((event_id % 12 - 1) * 55 AS INT)) END AS e FROM events WHERE event_id % 2 = 1),
h AS (SELECT id, count(b0) AS n FROM q LEFT JOIN bk ON q.room = bk.room AND b0 < e AND b1 > b GROUP BY 1),
x AS (SELECT q.*, p_size, p_partkey IS NOT NULL AS found, CASE WHEN e IS NULL OR e <= b THEN 'unavailable' WHEN n > 0 THEN 'occupied' ELSE 'available' END AS slot FROM q JOIN h USING (id) LEFT JOIN part ON p_partkey = room AND p_partkey % 13 <> 0)
SELECT id, {_names(_MEETING, 'blockers')}, {_names({"APPROVAL_REQUIRED": f"{_ROOM} AND p_size % 5 = 0", "SLOT_AVAILABILITY_POINT_IN_TIME": f"{_ROOM} AND slot = 'available'"}, 'warnings')} FROM x""")
def meeting_rules(t: Tables):
    """What blocks each asked meeting, against rooms and other bookings."""
    k, e = F.col("event_id"), t.events
    booked = e.where(k % 2 == 0).select((F.col("user_id") % 100).alias("room"), F.col("ts").alias("begin"), (F.col("ts") + F.expr("interval 20 minutes")).alias("end"))
    end = F.when(k % 29 != 0, F.col("ts") + F.make_dt_interval(mins=((k % 12 - 1) * 55).cast("int")))
    asked = e.where(k % 2 == 1).select(k.alias("id"), (F.col("user_id") % 100).alias("room"), F.col("ts").alias("begin"), end.alias("end"), F.when(k % 11 == 1, " ").otherwise(F.col("event_type")).alias("title"), (k % 14 - 1).alias("participants"))
    status = intervals.slot_status(asked, booked).withColumnRenamed("status", "slot")
    p, size = F.col("p_partkey"), F.col("p_size")
    rooms = t.part.where(p % 13 != 0).select(p.alias("room"), (size % 9 != 0).alias("available"), (size % 12).alias("capacity"), (p % 20).alias("days_ahead"), (p % 3 * 60 + 420).alias("opens"), F.lit(1320).alias("closes"), (size % 5 == 0).alias("approval"), F.lit(True).alias("found"))
    out = B.meeting_findings(status.join(rooms, "room", "left").fillna(False, ["found"]), F.lit(_NOW).cast("timestamp"))
    return out.select("id", F.array_join("blockers", ",").alias("blockers"), F.array_join("warnings", ",").alias("warnings"))


_LIBRARY = {
    "TITLE_REQUIRED": "trim(title) = ''", "ROOM_NOT_FOUND": "NOT found", "MEMBER_LIST_INVALID": "invalid", "START_IN_PAST": f"b < TIMESTAMP '{_NOW}'", "TIME_ORDER_INVALID": "e <= b", "DURATION_EXCEEDS_LIMIT": "mins > 120",
    "MULTI_DAY_UNSUPPORTED": "CAST(b AS DATE) <> CAST(e AS DATE)", "ADVANCE_WINDOW_EXCEEDED": f"date_diff('day', DATE '{_NOW[:10]}', CAST(b AS DATE)) > 2", "DURATION_INVALID": "mins <= 0", "DURATION_BELOW_ROOM_MINIMUM": "found AND p_size % 4 * 30 > 0 AND mins < p_size % 4 * 30",
    "SLOT_CHECK_FAILED": "found AND mins <= 0", "ROOM_CAPACITY_POLICY_UNKNOWN": "found AND room % 4 = 3", "GROUP_MEMBER_KIND_REQUIRED": "found AND room % 4 IN (1, 2) AND kind <> 2", "GROUP_MEMBERS_REQUIRED": "found AND room % 4 IN (1, 2) AND len(vals) < 3",
    "SELF_MEMBER_MISMATCH": "kind = 1 AND (len(vals) <> 1 OR vals[1] <> booker)", "GROUP_TOO_SMALL": "kind <> 1 AND len(vals) < 2", "BOOKER_MISSING": "kind <> 1 AND NOT list_contains(vals, booker)",
}


@query("F23 F21 C16", f"""WITH q AS (SELECT event_id AS id, user_id % 100 AS room, user_id + 10 AS booker, CASE WHEN event_id % 10 = 2 THEN ' ' ELSE event_type END AS title, (event_id // 2 % 16 - 1) * 10 AS mins, ts AS b, event_id // 2 % 2 + 1 AS kind, event_id // 2 % 6 AS m FROM events WHERE event_id % 2 = 0),
g AS (SELECT *, b + to_minutes(CAST(mins AS INT)) AS e, CASE m WHEN 0 THEN [booker] WHEN 1 THEN [booker] WHEN 2 THEN [booker, 7, 9] WHEN 3 THEN [7, 7] WHEN 4 THEN [0, booker] ELSE [7, 9] END AS given FROM q),
x AS (SELECT g.*, p_size, p_partkey IS NOT NULL AS found, m IN (3, 4) AS invalid, CASE m WHEN 3 THEN [CAST(7 AS BIGINT)] WHEN 4 THEN [booker] ELSE given END AS vals, CASE WHEN mins <= 0 THEN 'unavailable' ELSE 'available' END AS slot FROM g LEFT JOIN part ON p_partkey = room AND p_partkey % 13 <> 0)
SELECT id, {_names(_LIBRARY, 'blockers')}, {_names({"CANCELLATION_WINDOW_SHORT": f"floor(epoch(b)) - epoch(TIMESTAMP '{_NOW}') >= 0 AND floor(epoch(b)) - epoch(TIMESTAMP '{_NOW}') < 600", "SLOT_AVAILABILITY_POINT_IN_TIME": "found AND slot = 'available'", "GROUP_NOT_REQUIRED": "found AND room % 4 = 0 AND kind <> 1"}, 'warnings')} FROM x""")
def library_rules(t: Tables):
    """What blocks each asked library reservation: times, members and the room's class by its name."""
    k, own = F.col("event_id"), F.col("user_id") + 10
    half = F.floor(k / 2)
    given = F.when(half % 6 == 0, F.array().cast("array<bigint>")).when(half % 6 == 1, F.array(own)).when(half % 6 == 2, F.array(own, F.lit(7), F.lit(9))).when(half % 6 == 3, F.array(F.lit(7), F.lit(7)).cast("array<bigint>")).when(half % 6 == 4, F.array(F.lit(0), own)).otherwise(F.array(F.lit(7), F.lit(9)).cast("array<bigint>"))
    asked = t.events.where(k % 2 == 0).select(k.alias("id"), (F.col("user_id") % 100).alias("room"), F.col("ts").alias("begin"), (F.col("ts") + F.make_dt_interval(mins=((half % 16 - 1) * 10).cast("int"))).alias("end"), F.when(k % 10 == 2, " ").otherwise(F.col("event_type")).alias("title"), (half % 2 + 1).alias("member_kind"), B.member_list(given, own).alias("members"), own.alias("booker"))
    asked = asked.withColumn("slot", F.when(F.col("end") <= F.col("begin"), "unavailable").otherwise("available"))
    p = F.col("p_partkey")
    label = F.get(F.array(*[F.lit(x) for x in ("Room A (1-2)", "Room B（3～6人）", "Room C (8 people or more)", "Room D")]), (p % 4).cast("int"))
    rooms = t.part.where(p % 13 != 0).select(p.alias("room"), (F.col("p_size") % 4 * 30).alias("minimum"), S.capacity_class(label).alias("capacity_class"), F.lit(True).alias("found"))
    out = B.library_findings(asked.join(rooms, "room", "left").fillna(False, ["found"]), F.lit(_NOW).cast("timestamp"))
    return out.select("id", F.array_join("blockers", ",").alias("blockers"), F.array_join("warnings", ",").alias("warnings"))


_OPERATIONS = ["cart.add", "cart.remove", "drop", "bid.update", "enroll", "rename"]


def _selection(t: Tables) -> DataFrame:
    k, task = F.col("o_orderkey"), F.col("o_orderkey") % 50
    course = F.when(k % 8 == 1, task + 101).otherwise(task + 100)
    rows = t.orders.select(F.col("o_custkey").alias("owner"), task.alias("task"), course.alias("course"), F.when(k % 3 != 0, k % 5 + 1).alias("bid"), k.alias("k"))
    operation = F.get(F.array(*[F.lit(x) for x in _OPERATIONS]), (F.floor(k / 4) % 6).cast("int"))
    live = F.when(k % 17 == 0, "R2").when(k % 19 == 0, F.lit(None)).otherwise("R1")
    targets = t.orders.select(k.alias("id"), F.col("o_custkey").alias("owner"), task.alias("task"), (task + 100).alias("course"), operation.alias("operation"), F.when(k % 2 == 0, "cart").otherwise("enrolled").alias("place"), (k % 5 + 1).alias("bid"), F.lit("R1").alias("round_asked"), live.alias("round_live"))
    catalog = t.spark.range(40).select(F.col("id").alias("task"), (F.col("id") + 100).alias("course"))
    return B.observed(targets, rows.where(F.col("k") % 4 == 1), rows.where(F.col("k") % 4 == 3), catalog)


_SELECTION = """r AS (SELECT o_orderkey AS k, o_custkey AS owner, o_orderkey % 50 AS task, CASE WHEN o_orderkey % 8 = 1 THEN o_orderkey % 50 + 101 ELSE o_orderkey % 50 + 100 END AS course, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 5 + 1 END AS bid FROM orders),
c AS (SELECT owner, task, max(course) AS cc, max(bid) AS cb FROM r WHERE k % 4 = 1 GROUP BY ALL), n AS (SELECT owner, task, max(course) AS ec, max(bid) AS eb FROM r WHERE k % 4 = 3 GROUP BY ALL),
s AS (SELECT o_orderkey AS id, o_orderkey % 50 + 100 AS course, ['cart.add', 'cart.remove', 'drop', 'bid.update', 'enroll', 'rename'][o_orderkey // 4 % 6 + 1] AS op, o_orderkey % 2 = 0 AS in_place, o_orderkey % 5 + 1 AS bid,
  CASE WHEN o_orderkey % 17 = 0 THEN 'R2' WHEN o_orderkey % 19 = 0 THEN NULL ELSE 'R1' END AS live, cc, cb, ec, eb, cc IS NOT NULL AS in_cart, ec IS NOT NULL AS enrolled, o_orderkey % 50 < 40 AS bound
  FROM orders LEFT JOIN c ON c.owner = o_custkey AND c.task = o_orderkey % 50 LEFT JOIN n ON n.owner = o_custkey AND n.task = o_orderkey % 50)"""


@query("F24 F25 J35 J36 J37 J38", f"""WITH {_SELECTION} SELECT id, CASE WHEN live <> 'R1' THEN 'other_round' WHEN op IN ('cart.add', 'enroll') THEN CASE WHEN NOT bound THEN 'not_in_catalog' WHEN op = 'cart.add' AND in_cart THEN 'in_cart' WHEN enrolled THEN 'enrolled' ELSE 'ok' END
  WHEN op = 'cart.remove' THEN CASE WHEN in_cart THEN 'ok' ELSE 'not_in_cart' END WHEN op = 'drop' THEN CASE WHEN enrolled THEN 'ok' ELSE 'not_enrolled' END
  WHEN op = 'bid.update' THEN CASE WHEN in_place AND in_cart OR NOT in_place AND enrolled THEN 'ok' WHEN in_place THEN 'not_in_cart' ELSE 'not_in_enrolled' END ELSE 'unsupported' END AS precheck,
CASE WHEN coalesce(live = 'R1', false) AND coalesce(CASE op WHEN 'cart.add' THEN in_cart AND cc = course AND (cb IS NULL OR cb = bid) WHEN 'cart.remove' THEN NOT in_cart WHEN 'drop' THEN NOT enrolled
  WHEN 'bid.update' THEN CASE WHEN in_place THEN in_cart AND cc = course AND cb = bid ELSE enrolled AND ec = course AND eb = bid END WHEN 'enroll' THEN enrolled AND ec = course ELSE false END, false) THEN 'confirmed' ELSE 'not_observed' END AS outcome FROM s""")
def selection_writes(t: Tables):
    """Operations on a cart and an enrolment: what is found before, and whether it is there after."""
    return B.confirmed(B.precheck(_selection(t))).select("id", "precheck", "outcome")


@query("A19 A20 A21", """WITH p AS (SELECT o_custkey AS owner, o_orderkey % 6 AS item, o_orderkey AS n, CASE o_orderkey % 7 WHEN 0 THEN 12 WHEN 4 THEN 9 WHEN 6 THEN 40 END AS v FROM orders),
l AS (SELECT owner, item, arg_max(v, n) FILTER (WHERE v IS NOT NULL) AS v, count(*) FILTER (WHERE v IS NULL) AS refused FROM p GROUP BY ALL)
SELECT owner, CAST(coalesce(sum(v), 0) AS BIGINT) AS total, count(v) AS items, CAST(sum(refused) AS BIGINT) AS refused, coalesce(sum(v), 0) > 100 AS over_limit FROM l GROUP BY 1""")
def bid_plan(t: Tables):
    """Bids given as texts: which are valid, what they come to, and whether that is over the limit."""
    k = F.col("o_orderkey")
    text = F.get(F.array(*[F.lit(x) for x in ("12", "0", "x", "3.5", " 9 ", "-4", "40")]), (k % 7).cast("int"))
    return B.bid_plan(t.orders.select(F.col("o_custkey").alias("owner"), (k % 6).alias("item"), text.alias("bid"), k.alias("n")), 100)
