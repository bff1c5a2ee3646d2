"""Readers of HTML and GeoJSON held in text columns."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def links(df: DataFrame, key: str, html: str) -> DataFrame:
    """[S07, S16] key, n (from 1), href."""
    return df.select(key, F.posexplode(F.regexp_extract_all(html, F.lit('<a href="([^"]*)"'), 1)).alias("n", "href")).withColumn("n", F.col("n") + 1)


def profile(df: DataFrame, key: str, html: str) -> DataFrame:
    """[S18, S33] key, title, lang, paragraphs."""
    return df.select(key, F.regexp_extract(html, "(?is)<title>(.*?)</title>", 1).alias("title"), F.regexp_extract(html, '<html lang="([a-z]+)"', 1).alias("lang"), F.regexp_count(html, F.lit("(?i)<p[ >]")).alias("paragraphs"))


def profiles(df: DataFrame, key: str, html: str) -> DataFrame:
    """[S16, S18] key, name (of the first heading, null without one), email, and sections (title, text) that aren't empty."""
    tag = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"\s+", " "))
    heading = F.when(F.col(html).rlike("(?is)<h1[ >]"), tag(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1)))
    found = F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?is)<section[^>]*>(.*?)</section>"), 1), lambda s: F.struct(tag(F.regexp_extract(s, r"(?is)<h2[^>]*>(.*?)</h2>", 1)).alias("title"), tag(F.regexp_replace(s, r"(?is)<h2[^>]*>.*?</h2>", " ")).alias("text")))
    email = F.nullif(F.regexp_extract(html, r'(?i)href="mailto:([^"?]+)', 1), F.lit(""))
    return df.select(key, heading.alias("name"), email.alias("email"), F.filter(found, lambda s: s["text"] != "").alias("sections"))


def pairs(df: DataFrame, key: str, html: str) -> DataFrame:
    """[S33, S32] key, label, value of table rows and definition lists."""
    row = r"(?is)<t[hd][^>]*>(.*?)</t[hd]>\s*<td[^>]*>(.*?)</td>|<dt[^>]*>(.*?)</dt>\s*<dd[^>]*>(.*?)</dd>"
    found = df.select(key, F.explode(F.regexp_extract_all(html, F.lit(row), 0)).alias("m"))
    tag = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"\s+", " "))
    return found.select(key, tag(F.regexp_extract("m", r"(?is)^<(?:t[hd]|dt)[^>]*>(.*?)</", 1)).alias("label"), tag(F.regexp_extract("m", r"(?is)<(?:td|dd)[^>]*>((?:(?!<td|<dd).)*)</(?:td|dd)>$", 1)).alias("value"))


def geojson(df: DataFrame, body: str) -> DataFrame:
    """[S15, P14] id, name, lat, lng of point features."""
    kind = "struct<features:array<struct<properties:struct<id:bigint,name:string>,geometry:struct<coordinates:array<double>>>>>"
    own = df.select(F.explode(F.from_json(body, kind)["features"]).alias("f"))
    return own.select("f.properties.id", "f.properties.name", F.get("f.geometry.coordinates", F.lit(1)).alias("lat"), F.get("f.geometry.coordinates", F.lit(0)).alias("lng"))


class _Cards(HTMLParser):
    def __init__(self, marker: str):
        super().__init__(convert_charrefs=True)
        self.marker, self.cards, self.depth, self.field = marker, [], 0, None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        classes = (a.get("class") or "").split()
        if self.marker in classes:
            self.cards.append({"id": a.get("data-id")})
            self.depth = 1
        elif self.depth:
            self.depth += tag not in ("br", "img", "input", "hr", "meta", "link")
            self.field = next((c for c in classes if c in ("title", "time", "place")), self.field)

    def handle_endtag(self, tag):
        self.depth = max(0, self.depth - 1)
        self.field = None

    def handle_data(self, data):
        if self.depth and self.field and data.strip():
            self.cards[-1].setdefault(self.field, data.strip())


def cards(df: DataFrame, html: str, marker: str = "card") -> DataFrame:
    """[S17] id, title, time, place of cards; the first of each id stays, an odd time stays null. Needs a DOM, so Python."""
    def run(batches):
        for pdf in batches:
            out = []
            for body in pdf["body"]:
                p = _Cards(marker)
                p.feed(body or "")
                out += [{k: c.get(k) for k in ("id", "title", "time", "place")} | {"pos": i} for i, c in enumerate(p.cards)]
            yield pd.DataFrame(out, columns=["id", "title", "time", "place", "pos"])

    found = df.select(F.col(html).alias("body")).mapInPandas(run, "id string, title string, time string, place string, pos int")
    first = found.groupBy("id").agg(F.min_by(F.struct("title", "time", "place"), "pos").alias("x"))
    return first.select("id", "x.title", F.try_to_timestamp("x.time").alias("time"), "x.place")
