"""Queries that the reference has no counterpart of, labelled as such: streams of events."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.plans.catalog import Tables, query
from plumbline.streaming import watch


@query("extra: T01 as a stream; tumbling windows with a watermark", """SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS hour, event_type, count(*) AS k FROM events GROUP BY ALL""")
def hourly_events(t: Tables):
    """The plan of the stream watch.hourly, over the whole table."""
    return watch.hourly(t.events).select(F.col("window.start").alias("hour"), "event_type", "k")
