"""Calendars put together: events of several sources, what was left out of them and why, and what is on now or next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.scalars import utc_at


def holiday_events(holidays: DataFrame) -> DataFrame:
    """[P29] All-day events of holidays (name, lo, hi); their end is excluded."""
    z = lambda d: d.cast("timestamp")
    return holidays.select(F.lit("holiday").alias("source"), F.concat_ws("-", F.lit("holiday"), "name", F.col("lo").cast("string")).alias("uid"), F.col("name").alias("summary"), z(F.col("lo")).alias("begin"), z(F.date_add("hi", 1)).alias("end"), F.lit(True).alias("all_day"))


def timed_events(rows: DataFrame, source: str, key: Column, summary: Column, begin: Column, end: Column) -> DataFrame:
    """[P28] Timed events; a deadline has the same begin and end."""
    return rows.select(F.lit(source).alias("source"), F.concat_ws("-", F.lit(source), key.cast("string")).alias("uid"), summary.alias("summary"), begin.alias("begin"), end.alias("end"), F.lit(False).alias("all_day"))


def agenda(parts: dict[str, tuple[DataFrame, Column | None]]) -> tuple[DataFrame, DataFrame]:
    """[R14, R15, T08] The events of all sources, and what was left out: source, uid and reason.

    parts: by source the events and a reason (null for those that are kept).
    """
    kept = left = None
    for df, why in parts.values():
        reason = F.lit(None).cast("string") if why is None else why
        own = df.withColumn("reason", reason)
        good, bad = own.where("reason is null").drop("reason"), own.where("reason is not null").select("source", "uid", "reason")
        kept, left = (good, bad) if kept is None else (kept.unionByName(good), left.unionByName(bad))
    return kept, left


def agenda_status(kept: DataFrame, left: DataFrame, wanted: DataFrame) -> DataFrame:
    """[R14, A22] By wanted source: events, omissions, and ok, partial, or empty."""
    n = lambda df, c: df.groupBy("source").agg(F.count("*").alias(c))
    out = wanted.join(n(kept, "events"), "source", "left").join(n(left, "omitted"), "source", "left").fillna(0, ["events", "omitted"])
    return out.withColumn("status", F.when(F.col("omitted") > 0, "partial").when(F.col("events") > 0, "ok").otherwise("empty"))


def now_and_next(occurrences: DataFrame, instants: DataFrame, key: str) -> DataFrame:
    """[J22, J23] For each instant (key, at) of an owner the occurrence (key, uid, begin, end) that is on, and if none is, the next.

    Occurrences of an owner that begin at once are first put together, the last of them and the first of them by end and uid.
    Then both are sorted by begin, forward and backward (Spark computes a frame that ends with its partition anew for each
    row): the last occurrence that began is carried forward to the instant, the first one after it backward.
    """
    blank = F.lit(None)
    each = F.struct("begin", "end", "uid")
    occ = occurrences.where("begin is not null").groupBy(key, F.col("begin").alias("t")).agg(F.max(each).alias("l"), F.min(each).alias("f")).select(key, "t", F.lit(0).alias("late"), "l", "f", blank.cast("timestamp").alias("at"))
    ask = instants.select(key, F.col("at").alias("t"), F.lit(1).alias("late"), blank.cast(occ.schema["l"].dataType).alias("l"), blank.cast(occ.schema["f"].dataType).alias("f"), "at")
    carried = lambda c, *order: F.last(c, ignorenulls=True).over(Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    both = occ.unionByName(ask).withColumn("last", carried("l", "t", "late")).withColumn("after", carried("f", F.desc("t"), F.desc("late")))
    on = F.when(F.col("at") < F.col("last.end"), F.col("last.uid"))
    return both.where("at is not null").select(key, "at", on.alias("on_now"), F.when(on.isNull(), F.col("after.uid")).alias("next"))


def exam_candidates(exams: DataFrame, today: Column, minutes: Column) -> DataFrame:
    """[J24, J25] exams (owner, code, name, day: a date or null, from_minute, to_minute) with why they are left out
    (bad_date, bad_time) and whether they are still to come: a later day, or today until the exam ends."""
    bad_date, bad_time = F.col("day").isNull(), F.col("from_minute").isNull()
    past = F.coalesce((F.col("day") < today) | ((F.col("day") == today) & (F.coalesce("to_minute", "from_minute") <= minutes)), F.lit(False))
    reason = F.when(bad_date, "bad_date").when((F.col("day") >= today) & bad_time, "bad_time")
    return exams.withColumns({"reason": reason, "to_come": reason.isNull() & ~past & ~bad_time})


def next_exam(candidates: DataFrame) -> DataFrame:
    """[J24, J25] By owner: the next exam by day, start, code and name, and how many were left out."""
    first = F.min(F.when(F.col("to_come"), F.struct("day", "from_minute", "code", "name"))).alias("x")
    return candidates.groupBy("owner").agg(first, F.count("reason").alias("omitted")).select("owner", F.col("x.code").alias("code"), F.col("x.day").alias("day"), "omitted")


def exam_start(day: Column, minute: Column) -> Column:
    return utc_at(day, minute)


def term_of_day(days: DataFrame, terms: DataFrame) -> DataFrame:
    """[J19] days (day) with term: of the terms (name, lo, hi, rank) that hold the day the first by rank. A year has three: broadcast."""
    met = days.join(F.broadcast(terms), F.col("day").between(F.col("lo"), F.col("hi")), "left")
    return met.groupBy(*days.columns).agg(F.min_by("name", "rank").alias("term"))
