"""Interval joins: conflicts by week, day and periods, free capacity, bookings, and range lookups without an equal key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.staging import checked_broadcast, materialise


def meets(a: DataFrame, b: DataFrame) -> Column:
    """Periods overlap, both ends included."""
    return (a["ps"] <= b["pe"]) & (b["ps"] <= a["pe"])


def by_week(slots: DataFrame) -> DataFrame:
    """A row for each week of a slot: the week joins as an equal key with the day, and nothing is compared but periods."""
    return slots.withColumn("week", F.explode("weeks")).drop("weeks")


def _week_sets(weeks: Column) -> tuple[Column, Column]:
    """Weeks as a bit for each of 0 to 62, and those outside as an array, null if there are none."""
    inside = lambda w: (w >= 0) & (w <= 62)
    bits = F.aggregate(F.filter(weeks, inside), F.lit(0).cast("long"), lambda bits, w: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), w.cast("int"))))
    rest = F.filter(weeks, lambda w: ~inside(w))
    return bits, F.when(F.size(rest) > 0, rest)


def conflict_pairs(left: DataFrame, right: DataFrame, keys: tuple[str, ...] = ("day",)) -> DataFrame:
    """[J01, J02, R10] section_a < section_b that have a meeting in common by keys, week and periods.

    Slots join by keys and period, and two of them count at their first common period, so that they come once; weeks are
    compared as sets, so that a pair isn't made for each week. Only a section with several slots can bring a pair again:
    those sections are counted first, and their pairs alone are made distinct. All other pairs leave the join unshuffled.
    """
    several = lambda df: df.groupBy("section").count().where("count > 1").select("section")
    more = materialise(several(left) if left is right else several(left).union(several(right)).distinct(), "several")
    if more.isEmpty():
        return _slot_pairs(left, right, keys)
    more = checked_broadcast(more)
    once, many = (lambda df, how=how: df.join(more, "section", how) for how in ("left_anti", "left_semi"))
    again = _slot_pairs(many(left), right, keys).unionByName(_slot_pairs(once(left), many(right), keys))
    return _slot_pairs(once(left), once(right), keys).unionByName(again.distinct())


def _slot_pairs(left: DataFrame, right: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """A row for two slots in conflict. The join is told to sort and shuffle: a size estimated from a file doesn't know of the
    rows made here, and could have them broadcast."""

    def side(df: DataFrame, s: str) -> DataFrame:
        bits, rest = _week_sets(F.col("weeks"))
        return df.where("ps <= pe").select(*keys, F.explode(F.sequence("ps", "pe")).alias("period"), F.col("ps").alias(f"ps_{s}"), bits.alias(f"bits_{s}"), rest.alias(f"rest_{s}"), F.col("section").alias(f"section_{s}"))

    weeks = (F.col("bits_a").bitwiseAND(F.col("bits_b")) != 0) | (F.col("rest_a").isNotNull() & F.col("rest_b").isNotNull() & F.arrays_overlap("rest_a", "rest_b"))
    hit = (F.col("section_a") < F.col("section_b")) & (F.col("period") == F.greatest("ps_a", "ps_b")) & weeks
    return side(left, "a").join(side(right, "b").hint("merge"), [*keys, "period"]).where(hit).select("section_a", "section_b")


def slots_at(asked: DataFrame, slots: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """[J07, J44] asked (keys, week, period and others) with the section of each slot (keys, ps, pe, weeks, section) that takes
    place then. They join by keys and period, and the week is looked up in a slot's set, so that no slot is repeated for
    each week; as in conflict_pairs, the join doesn't broadcast."""
    bits, rest = _week_sets(F.array_distinct("weeks"))
    there = slots.where("ps <= pe").select(*keys, F.explode(F.sequence("ps", "pe")).alias("period"), bits.alias("__bits"), rest.alias("__rest"), "section")
    inside = F.col("week").between(0, 62) & (F.call_function("shiftright", F.col("__bits"), F.col("week").cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1)
    return asked.join(there.hint("merge"), [*keys, "period"]).where(inside | F.coalesce(F.array_contains("__rest", F.col("week")), F.lit(False))).drop("__bits", "__rest")


def unblocked(slots: DataFrame, blocks: DataFrame) -> DataFrame:
    """[J03] Slots that overlap no block of their day."""
    return slots.join(blocks.select(F.col("day").alias("bd"), F.col("ps").alias("bp"), F.col("pe").alias("be")), (F.col("day") == F.col("bd")) & (F.col("ps") <= F.col("be")) & (F.col("bp") <= F.col("pe")), "left_anti")


def occupied(slots: DataFrame, week: int, day: int, ps: int, pe: int) -> DataFrame:
    """[J05, J07, F10]"""
    return slots.where((F.col("day") == day) & F.array_contains("weeks", week) & (F.col("ps") <= pe) & (F.col("pe") >= ps))


def free_rooms(rooms: DataFrame, slots: DataFrame, week: int, day: int, ps: int, pe: int) -> DataFrame:
    """[J06]"""
    return rooms.join(occupied(slots, week, day, ps, pe).select("room").distinct(), "room", "left_anti")


def slot_status(asked: DataFrame, booked: DataFrame, windows: list[tuple[int, int]] | None = None, complete: str | None = None, width: int = 6 * 3600) -> DataFrame:
    """[J08, J09, F17] asked (id, room, begin, end) against booked (room, begin, end), half open: overlaps and status.

    unavailable where the end isn't after the begin, where no opening window (minutes of the day, both ends included) holds
    both, or where the column complete says that the bookings aren't all known; else occupied or available. Rooms join by
    stretches of width seconds, and a pair counts in the stretch where the later of the two begins.
    """
    stretch = lambda c: F.floor(F.unix_timestamp(c) / width)
    cut = lambda df, a, b: df.withColumn("__k", F.explode_outer(F.sequence(stretch(a), F.greatest(stretch(a), stretch(b)))))
    b = cut(booked.select(F.col("room").alias("__room"), F.col("begin").alias("__b0"), F.col("end").alias("__b1")).where("__b0 < __b1"), "__b0", "__b1").withColumnRenamed("__k", "__kb")
    met = (F.col("room") == F.col("__room")) & (F.col("__k") == F.col("__kb")) & (F.col("__b0") < F.col("end")) & (F.col("__b1") > F.col("begin")) & (F.col("__k") == stretch(F.greatest("__b0", "begin")))
    out = cut(asked, "begin", "end").join(b, met, "left").groupBy(*asked.columns).agg(F.count("__b0").alias("overlaps"))
    minute = lambda c: F.hour(c) * 60 + F.minute(c)
    open_ = F.lit(windows is None)
    for begins, ends in windows or []:
        open_ = open_ | ((minute("begin") >= begins) & (minute("end") <= ends))
    known = F.lit(True) if complete is None else F.coalesce(F.col(complete), F.lit(False))
    return out.withColumn("status", F.when(F.coalesce((F.col("end") <= F.col("begin")) | ~open_, F.lit(True)) | ~known, "unavailable").when(F.col("overlaps") > 0, "occupied").otherwise("available"))


def all_conflict(slots: DataFrame, anchor) -> DataFrame:
    """[J16] By code: whether each of its sections has a meeting in conflict with one of the anchor's code."""
    a = by_week(slots.where(F.col("code") == anchor)).select(F.col("week").alias("aw"), F.col("day").alias("ad"), F.col("ps").alias("ap"), F.col("pe").alias("ae")).distinct()
    others = slots.where(F.col("code") != anchor)
    met = (F.col("week") == F.col("aw")) & (F.col("day") == F.col("ad")) & (F.col("ps") <= F.col("ae")) & (F.col("ap") <= F.col("pe"))
    hit = by_week(others).join(a, met, "left_semi").select("section").distinct().withColumn("hit", F.lit(1))
    marked = others.select("section", "code").join(hit, "section", "left")
    return marked.groupBy("code").agg(F.count("*").alias("sections"), F.count("hit").alias("conflicting"), (F.count("hit") == F.count("*")).alias("all_conflict"))


def bucketed_overlap(a: DataFrame, b: DataFrame, begin: str, end: str, width: int) -> DataFrame:
    """Overlap join (both ends included) without an equal key: intervals are cut into buckets that join as one.

    A pair is kept in the bucket where the later of the two begins, so none comes twice. a and b have whole begin and end;
    b's columns end in _b.
    """
    cut = lambda df, p: df.withColumn("__k", F.explode(F.sequence(F.floor(F.col(p[0]) / width), F.floor(F.col(p[1]) / width))))
    other = b.select(*[F.col(c).alias(f"{c}_b") for c in b.columns])
    joined = cut(a, (begin, end)).join(cut(other, (f"{begin}_b", f"{end}_b")), "__k")
    hit = (F.col(begin) <= F.col(f"{end}_b")) & (F.col(f"{begin}_b") <= F.col(end))
    return joined.where(hit & (F.col("__k") == F.floor(F.greatest(begin, f"{begin}_b") / width))).drop("__k")


def in_window(days: DataFrame, dim: DataFrame, width: int) -> DataFrame:
    """[J39] days (day) with each interval of dim (lo, hi) that meets the window of so many days from there, or nulls. dim
    is a calendar table: broadcast."""
    return days.join(F.broadcast(dim), (F.col("lo") < F.date_add("day", width)) & (F.col("hi") >= F.col("day")), "left")


def range_lookup(facts: DataFrame, key: str, dim: DataFrame, at: Column, low: str, high: str, order: list[str], half_open: bool = False) -> DataFrame:
    """[J18, J19, J20, J39] facts with the first dim row (by order) whose range holds at, or nulls.

    dim is a calendar table (a few rows a year), so it is broadcast; facts with several fitting rows keep the first.
    """
    inside = (F.col("__at") >= F.col(low)) & ((F.col("__at") < F.col(high)) if half_open else (F.col("__at") <= F.col(high)))
    fits = facts.withColumn("__at", at).join(F.broadcast(dim), inside, "left").drop("__at")
    best = F.min_by(F.struct(*dim.columns), F.struct(*order)).alias("__d")
    return fits.groupBy(*facts.columns).agg(best).select(*facts.columns, "__d.*") if key else fits
