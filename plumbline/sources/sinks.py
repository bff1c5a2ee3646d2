"""Writers: envelopes of JSON lines, calendars, Markdown, tables by term."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import scalars as S


class QueryError(Exception):
    """[K02] An error with a code and the exit status of its kind."""

    STATUS = {"USAGE": 2, "AUTH": 3, "NOT_FOUND": 4, "REMOTE": 5}

    def __init__(self, message: str, code: str = "ERROR"):
        super().__init__(message)
        self.code, self.status = code, self.STATUS.get(code, 1)

    def envelope(self) -> dict:
        return {"ok": False, "error": {"code": self.code, "message": str(self)}}


def exit_code(code: Column) -> Column:
    """[K02] The exit status of an error's code; 0 without an error and 1 for any other."""
    out = F.lit(1)
    for name, status in QueryError.STATUS.items():
        out = F.when(code == name, status).otherwise(out)
    return F.when(code.isNull(), 0).otherwise(out)


def save_json(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """[K03, K04] Documents of a few rows as JSON, committed as a whole; an existing place is an error unless overwriting is asked for."""
    spark = df.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not overwrite and at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        raise QueryError(f"{path} exists", "EXISTS")
    df.coalesce(1).write.mode("overwrite" if overwrite else "errorifexists").json(path)


def json_lines(df: DataFrame, name: str) -> DataFrame:
    """[K01] line: each row as JSON, then one line with the count. place orders them."""
    items = df.select(F.lit(0).alias("place"), F.to_json(F.struct(*df.columns)).alias("line"))
    summary = df.agg(F.lit(1).alias("place"), F.to_json(F.struct(F.lit(name).alias("summary"), F.count("*").alias("items"))).alias("line"))
    return items.unionByName(summary)


def write_new(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """[K03, K04] Committed as a whole; an existing place is an error unless overwriting is asked for."""
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def write_by_term(df: DataFrame, path: str, term: str = "term") -> None:
    """[K07, S14] Partitioned by term, so that a term is replaced and read alone."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(term).parquet(path)


def event_text(uid: Column, summary: Column, description: Column, start: Column, end: Column, stamp: str) -> Column:
    """[K05, G08] One calendar event; start and end are UTC."""
    z = lambda c: F.date_format(c, "yyyyMMdd'T'HHmmss'Z'")
    lines = [F.lit("BEGIN:VEVENT"), F.concat(F.lit("UID:"), S.ics_escape(uid)), F.lit(f"DTSTAMP:{stamp}"), F.concat(F.lit("DTSTART:"), z(start)), F.concat(F.lit("DTEND:"), z(end)), F.concat(F.lit("SUMMARY:"), S.ics_escape(summary)), F.concat(F.lit("DESCRIPTION:"), S.ics_escape(description)), F.lit("END:VEVENT")]
    return F.concat_ws("\r\n", *lines)


def calendar(events: DataFrame, by: list[str], text: str, order: list[str], name: str) -> DataFrame:
    """[K05] One calendar for each key, its events in order."""
    head = "\r\n".join(["BEGIN:VCALENDAR", "VERSION:2.0", f"PRODID:-//{name}//EN", "CALSCALE:GREGORIAN"])
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, text))), lambda x: x[text]), "\r\n")
    return events.groupBy(*by).agg(F.concat(F.lit(head + "\r\n"), body, F.lit("\r\nEND:VCALENDAR\r\n")).alias("calendar"))


def is_calendar(body: Column, most: int = 5_000_000) -> Column:
    """[S31]"""
    return body.startswith("BEGIN:VCALENDAR") & (F.length(body) <= most)


def markdown_page(title: Column, fields: dict[str, Column]) -> Column:
    """[K06] A heading and a list of what isn't blank."""
    return F.concat_ws("\n", F.concat(F.lit("# "), title), *[F.when(S.text(c) != "", F.concat(F.lit(f"- **{k}**: "), c)) for k, c in fields.items()])
