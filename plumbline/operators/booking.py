"""Rules on reservations and selections: what blocks a write, what it should warn of, and whether it took effect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.audit import findings

#: The longest meeting and library reservation, how far ahead the latter may begin, and late cancellation.
MEETING_HOURS, LIBRARY_MINUTES, LIBRARY_DAYS, CANCEL_MINUTES = 8, 120, 2, 10


def _minutes(a: str, b: str) -> Column:
    return F.round((F.unix_timestamp(b) - F.unix_timestamp(a)) / 60)


def _clock(c: str) -> Column:
    return F.hour(c) * 60 + F.minute(c)


def _times(now: Column, hours_limit: Column) -> dict[str, Column]:
    return {
        "START_IN_PAST": F.col("begin") < now,
        "TIME_ORDER_INVALID": F.col("end") <= F.col("begin"),
        "DURATION_EXCEEDS_LIMIT": hours_limit,
        "MULTI_DAY_UNSUPPORTED": F.to_date("begin") != F.to_date("end"),
    }


def meeting_findings(asked: DataFrame, now: Column) -> DataFrame:
    """asked with blockers, warnings and allowed.

    asked: title, participants, begin, end, found (the room is known), available, capacity, days_ahead (0: any), opens and
    closes (minutes of the day), approval, slot (available, occupied or unavailable).
    """
    bad_time = F.col("begin").isNull() | F.col("end").isNull()
    room = F.col("found") & ~bad_time
    rules = {
        "TITLE_REQUIRED": F.coalesce(F.trim("title"), F.lit("")) == "",
        "PARTICIPANTS_INVALID": F.col("participants") < 1,
        "ROOM_NOT_FOUND": ~F.col("found"),
        "TIME_INVALID": bad_time,
        **_times(now, _minutes("begin", "end") > MEETING_HOURS * 60),
        "ROOM_UNAVAILABLE": room & ~F.col("available"),
        "PARTICIPANTS_EXCEED_CAPACITY": room & (F.col("capacity") > 0) & (F.col("participants") > F.col("capacity")),
        "ADVANCE_WINDOW_EXCEEDED": room & (F.col("days_ahead") > 0) & (F.datediff("begin", now) > F.col("days_ahead")),
        "OUTSIDE_BOOKABLE_WINDOW": room & ~((_clock("begin") >= F.col("opens")) & (_clock("end") <= F.col("closes"))),
        "SLOT_OCCUPIED": room & (F.col("slot") == "occupied"),
        "SLOT_CHECK_FAILED": room & (F.col("slot") == "unavailable"),
    }
    warnings = {"APPROVAL_REQUIRED": room & F.col("approval"), "SLOT_AVAILABILITY_POINT_IN_TIME": room & (F.col("slot") == "available")}
    out = asked.withColumns({"blockers": findings(rules), "warnings": findings(warnings)})
    return out.withColumn("allowed", F.size("blockers") == 0)


def member_list(values: Column, own: Column) -> Column:
    """values (different ones, positive; the booker alone where none are given) and invalid: why the list is wrong."""
    given = F.when(F.coalesce(F.size(values), F.lit(0)) > 0, values).otherwise(F.array(own))
    once = F.array_distinct(given)
    bad = F.exists(once, lambda x: F.coalesce(x < 1, F.lit(True)))
    why = F.when(bad, "not_positive").when(F.size(once) != F.size(given), "not_unique")
    return F.struct(F.filter(once, lambda x: x >= 1).alias("values"), why.alias("invalid"))


def library_findings(asked: DataFrame, now: Column) -> DataFrame:
    """asked with blockers, warnings and allowed.

    asked: title, begin, end, found, minimum (minutes, 0: none), slot, capacity_class (solo, group or unknown), member_kind
    (1: alone, 2: a group), members (of member_list), booker.
    """
    minutes, until = _minutes("begin", "end"), (F.unix_timestamp("begin") - F.unix_timestamp(now)) / 60
    found, alone = F.col("found"), F.col("member_kind") == 1
    n, group = F.size("members.values"), F.col("found") & (F.col("capacity_class") == "group")
    rules = {
        "TITLE_REQUIRED": F.coalesce(F.trim("title"), F.lit("")) == "",
        "ROOM_NOT_FOUND": ~found,
        "MEMBER_LIST_INVALID": F.col("members.invalid").isNotNull(),
        **_times(now, minutes > LIBRARY_MINUTES),
        "ADVANCE_WINDOW_EXCEEDED": F.datediff("begin", now) > LIBRARY_DAYS,
        "DURATION_INVALID": minutes <= 0,
        "DURATION_BELOW_ROOM_MINIMUM": found & (F.col("minimum") > 0) & (minutes < F.col("minimum")),
        "SLOT_OCCUPIED": found & (F.col("slot") == "occupied"),
        "SLOT_CHECK_FAILED": found & (F.col("slot") == "unavailable"),
        "ROOM_CAPACITY_POLICY_UNKNOWN": found & (F.col("capacity_class") == "unknown"),
        "GROUP_MEMBER_KIND_REQUIRED": group & (F.col("member_kind") != 2),
        "GROUP_MEMBERS_REQUIRED": group & (n < 3),
        "SELF_MEMBER_MISMATCH": alone & ((n != 1) | (F.get("members.values", F.lit(0)) != F.col("booker"))),
        "GROUP_TOO_SMALL": ~alone & (n < 2),
        "BOOKER_MISSING": ~alone & ~F.array_contains("members.values", F.col("booker")),
    }
    warnings = {
        "CANCELLATION_WINDOW_SHORT": (until >= 0) & (until < CANCEL_MINUTES),
        "SLOT_AVAILABILITY_POINT_IN_TIME": found & (F.col("slot") == "available"),
        "GROUP_NOT_REQUIRED": found & (F.col("capacity_class") == "solo") & ~alone,
    }
    out = asked.withColumns({"blockers": findings(rules), "warnings": findings(warnings)})
    return out.withColumn("allowed", F.size("blockers") == 0)


def observed(targets: DataFrame, cart: DataFrame, enrolled: DataFrame, catalog: DataFrame) -> DataFrame:
    """[J35, J36] targets (owner, task, course) with what their owner's cart and enrolment hold of the task: in_cart,
    cart_course, cart_bid, is_enrolled, enrolled_course, enrolled_bid; and bound: whether the catalog has task and course."""
    side = lambda df, p, here: df.groupBy("owner", "task").agg(F.max("course").alias(f"{p}_course"), F.max("bid").alias(f"{p}_bid")).withColumn(here, F.lit(True))
    out = targets.join(side(cart, "cart", "in_cart"), ["owner", "task"], "left").join(side(enrolled, "enrolled", "is_enrolled"), ["owner", "task"], "left")
    out = out.join(catalog.select("task", "course").distinct().withColumn("bound", F.lit(True)), ["task", "course"], "left")
    return out.fillna(False, ["in_cart", "is_enrolled", "bound"])


def precheck(state: DataFrame) -> DataFrame:
    """What an operation (operation, place, round_asked, round_live) finds before it writes: ok, or why not."""
    op, there = F.col("operation"), F.when(F.col("place") == "cart", F.col("in_cart")).otherwise(F.col("is_enrolled"))
    found = F.when((F.coalesce("round_live", F.lit("")) != "") & (F.col("round_live") != F.col("round_asked")), "other_round")
    add = F.when(~F.col("bound"), "not_in_catalog").when((op == "cart.add") & F.col("in_cart"), "in_cart").when(F.col("is_enrolled"), "enrolled").otherwise("ok")
    own = F.when(op.isin("cart.add", "enroll"), add).when(op == "cart.remove", F.when(F.col("in_cart"), "ok").otherwise("not_in_cart")).when(op == "drop", F.when(F.col("is_enrolled"), "ok").otherwise("not_enrolled"))
    own = own.when(op == "bid.update", F.when(there, "ok").otherwise(F.concat(F.lit("not_in_"), F.col("place")))).otherwise("unsupported")
    return state.withColumn("precheck", F.coalesce(found, own))


def confirmed(state: DataFrame) -> DataFrame:
    """[F25, J37, J38] Whether an operation took effect, from what is read back after it: confirmed or not_observed."""
    op, same = F.col("operation"), lambda p: F.coalesce(F.col(f"{p}_course") == F.col("course"), F.lit(False))
    in_place = F.col("place") == "cart"
    there = F.when(in_place, F.col("in_cart") & same("cart")).otherwise(F.col("is_enrolled") & same("enrolled"))
    bid = F.when(in_place, F.col("cart_bid")).otherwise(F.col("enrolled_bid"))
    yes = (
        F.when(op == "cart.add", F.col("in_cart") & same("cart") & (F.col("cart_bid").isNull() | (F.col("cart_bid") == F.col("bid"))))
        .when(op == "cart.remove", ~F.col("in_cart")).when(op == "drop", ~F.col("is_enrolled"))
        .when(op == "bid.update", there & F.coalesce(bid == F.col("bid"), F.lit(False))).when(op == "enroll", F.col("is_enrolled") & same("enrolled")).otherwise(False)
    )
    known = F.coalesce(F.col("round_live") == F.col("round_asked"), F.lit(False))
    return state.withColumn("outcome", F.when(known & F.coalesce(yes, F.lit(False)), "confirmed").otherwise("not_observed"))


def bid_plan(picks: DataFrame, limit: int) -> DataFrame:
    """[A20, A21] By owner: bids that are whole numbers from 1 (the last one of each item counts), their total, whether it is
    over the limit, and how many were refused. picks: owner, item, bid (text), n (their order)."""
    value = F.trim("bid").try_cast("int")
    own = picks.withColumn("value", F.when(F.trim("bid").rlike(r"^[+-]?\d+$") & (value >= 1), value))
    last = own.groupBy("owner", "item").agg(F.max_by("value", F.when(F.col("value").isNotNull(), F.col("n"))).alias("value"), F.count_if(F.col("value").isNull()).alias("refused"))
    return last.groupBy("owner").agg(F.coalesce(F.sum("value"), F.lit(0)).alias("total"), F.count("value").alias("items"), F.sum("refused").alias("refused")).withColumn("over_limit", F.col("total") > limit)
