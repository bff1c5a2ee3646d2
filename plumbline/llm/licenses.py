"""License scans: sentences and licence files against templates by sparse TF-IDF cosine, then inheritance by directory.

A file's own licence is the one that it declares: by an SPDX identifier, else by the first usual wording of a header,
notice or licence text that it holds as a whole, across lines and comment marks and whatever else the sentence says.
Without either it is that of the template closest to one of its sentences that name a licensing term (its header, or a
notice anywhere), or, for a file named like a licence, to its whole text as well; the cosine must reach a threshold.
What only reserves all rights comes last.
The licence files' licences hold for their directory. A file without its own takes that of the nearest directory above
it that has one, found by joining the distinct directories' ancestors with the directories that have a licence.

Weights: count of the term times 1 + ln((1 + T) / (1 + t)), t of T templates having it, with t = 0 for other terms; so
they depend on the templates alone. Defined results: null or blank texts have no licence of their own but may inherit;
a null path is in no directory and inherits nothing; a declared licence scores 1; of an SPDX expression the first
identifier counts, without -only, -or-later and +; a licence named without its version isn't a declaration, and a wording
counts wherever it stands; of equal cosines the template's name decides, of licence files in one directory one that
grants something, then the closest, then the name; repeated rows are scanned once and all returned; columns named like the
results are replaced by them; an empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import checked_broadcast, fresh, literal_rows, materialise, named, others, table

#: Licence names and the notices that stand for them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0"),
    ("Proprietary", "All rights reserved"),
]
#: A sentence is looked at if it has one of these.
CUES = r"(?i)licen[sc]|copyright|all rights reserved|redistribution|public domain|permission is hereby|spdx"
LICENSE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice)[^/]*$"
THRESHOLD = 0.6
RESERVED = "Proprietary"
SPDX = r"(?i)spdx-licen[sc]e-identifier\s*:[\s(]*([a-z0-9][a-z0-9.+-]*)"
#: Texts that may declare a licence without one of CUES.
SHORT_CUES = r"(?i)\b[al]?gpl|\bmpl|\bbsd\b|creative ?commons|\bcc[ -]?(0|by)|unencumbered software"
TERM = r"[a-z]+|[0-9]+(?:\.[0-9]+)*"

_LICENCE = "licen[sc]e"


def _gnu(kind: str, short: str, number: str) -> str:
    """A GNU licence by its long name before or after the version, or by its short name."""
    own = rf"(?<!lesser |library |affero ){'' if kind else 'general public '}{kind and kind + ' general public '}{_LICENCE}"
    return rf"{own}(?: {short})?(?: as published by the free software foundation)?(?: inc)?(?: either)?(?: version| v)? {number}|version {number} of the (?:gnu )?{own}|{short}v?(?: {_LICENCE})?(?: version| v)? {number}"


def _cc(long: str, short: str) -> str:
    return rf"(?:cc|creativecommons org licenses) {short} 4\.0|creative commons {long}(?: {_LICENCE})?(?: version| v)? 4\.0"


_BSD = "redistribution and use in source and binary forms with or without modification are permitted"
_ENDORSE = "(?:neither the names? of|names? of [a-z0-9. ]{1,200} may not be used to endorse)"
#: Wordings as patterns over a text's terms with one space between them; of two at one place the first here counts.
WORDINGS = [
    ("Apache-2.0", rf"apache(?: software)? {_LICENCE}(?: version| v)? 2(?:\.0)?|apache 2(?:\.0)? {_LICENCE}|apache org licenses license 2\.0"),
    ("MIT", rf"mit {_LICENCE}d?|permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("AGPL-3.0", _gnu("affero", "agpl", r"3(?:\.0)?")),
    ("LGPL-3.0", _gnu("lesser", "lgpl", r"3(?:\.0)?")),
    ("LGPL-2.1", _gnu("lesser", "lgpl", r"2\.1")),
    ("LGPL-2.0", _gnu("library", "lgpl", r"2(?:\.0)?")),
    ("GPL-3.0", _gnu("", "gpl", r"3(?:\.0)?")),
    ("GPL-2.0", _gnu("", "gpl", r"2(?:\.0)?")),
    ("BSD-2-Clause", rf"bsd 2 clause|2 clause bsd|simplified bsd {_LICENCE}|{_BSD}(?=.* redistributions in binary form )(?!.* {_ENDORSE} )"),
    ("BSD-3-Clause", rf"bsd 3 clause|3 clause bsd|(?:new|modified) bsd {_LICENCE}|{_BSD}"),
    ("MPL-2.0", rf"mozilla public {_LICENCE}(?: version| v)? 2(?:\.0)?|mplv?(?: version| v)? 2(?:\.0)?"),
    ("EPL-2.0", rf"eclipse public {_LICENCE}(?: version| v)? 2(?:\.0)?"),
    ("BSL-1.0", rf"boost software {_LICENCE}(?: version| v)? 1\.0"),
    ("ISC", rf"isc {_LICENCE}|permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that"),
    ("Unlicense", "this is free and unencumbered software released into the public domain"),
    ("CC-BY-NC-SA-4.0", _cc("attribution non ?commercial share ?alike", "by nc sa")),
    ("CC-BY-NC-ND-4.0", _cc("attribution non ?commercial no ?deriv(?:ative)?s", "by nc nd")),
    ("CC-BY-SA-4.0", _cc("attribution share ?alike", "by sa")),
    ("CC-BY-ND-4.0", _cc("attribution no ?deriv(?:ative)?s", "by nd")),
    ("CC-BY-NC-4.0", _cc("attribution non ?commercial", "by nc")),
    ("CC-BY-4.0", _cc("attribution", "by")),
    ("CC0-1.0", rf"cc 0 (?:1\.0|universal|{_LICENCE})|creative commons zero|publicdomain zero 1\.0"),
]

RESULTS = ("own_license", "own_score", "license", "license_from")


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), 0)


def template_weights(spark) -> tuple[DataFrame, float]:
    """id, name, term, weight (of unit length) and idf; the idf of a term that no template has."""
    rows = literal_rows(spark, [(i, *t) for i, t in enumerate(TEMPLATES)], ["id", "name", "notice"])
    counts = rows.select("id", "name", F.explode(terms(F.col("notice"))).alias("term")).groupBy("id", "name", "term").agg(F.count("*").alias("tf"))
    n = len(TEMPLATES)
    idf = counts.groupBy("term").agg((1 + F.ln((1 + n) / (1 + F.count("*")))).alias("idf"))
    counts = counts.join(idf, "term").withColumn("raw", F.col("tf") * F.col("idf"))
    norms = counts.groupBy("id").agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
    return counts.join(norms, "id").select("id", "name", "term", "idf", (F.col("raw") / F.col("norm")).alias("weight")), 1 + math.log(1 + n)


def declared_licenses(files: DataFrame) -> DataFrame:
    """path, mark, name, score and rank of the files that declare a licence (rank 2) or reserve all rights (0)."""
    known = {name.lower(): name for name, _ in [*WORDINGS, *TEMPLATES]}
    id_ = F.regexp_replace(F.lower(F.regexp_extract("text", SPDX, 1)), r"(-only|-or-later|\+|\.)+$", "")
    raw = F.regexp_replace(F.regexp_extract("text", SPDX, 1), r"(?i)(-only|-or-later|\+|\.)+$", "")
    spdx = F.when(id_ != "", F.coalesce(*[F.when(id_ == low, F.lit(name)) for low, name in known.items()], raw))
    cued = files.where(F.col("text").rlike(CUES) | F.col("text").rlike(SHORT_CUES)).select("path", "mark", spdx.alias("spdx"), F.concat(F.lit(" "), F.array_join(terms(F.col("text")), " "), F.lit(" ")).alias("words"))
    at = lambda i, p: F.when(F.col("words").rlike(f" (?:{p}) "), F.struct(F.length(F.regexp_extract("words", f"^(.*?) (?:{p}) ", 1)).alias("at"), F.lit(i).alias("i")))
    found = F.array_min(F.array_compact(F.array(*[at(i, p) for i, (_, p) in enumerate(WORDINGS)])))
    wording = F.get(F.array(*[F.lit(name) for name, _ in WORDINGS]), found["i"])
    reserved = F.when(F.col("words").contains(" all rights reserved "), F.lit(RESERVED))
    out = cued.select("path", "mark", F.coalesce("spdx", wording).alias("granted"), reserved.alias("reserved"))
    return out.select("path", "mark", F.coalesce("granted", "reserved").alias("name"), F.lit(1.0).alias("score"), F.when(F.col("granted").isNotNull(), 2).otherwise(0).alias("rank")).where("name is not null")


def own_licenses(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """path, mark (of the text), own_license, own_score for the files that have one."""
    named = F.coalesce(F.col("path").rlike(LICENSE_FILE), F.lit(False))
    cued = files.where(F.col("text").rlike(CUES) | (named & F.col("text").isNotNull()))
    sentences = F.filter(F.split("text", r"\n|(?<=[.!?])[ \t]+"), lambda s: s.rlike(CUES))
    parts = cued.select("path", "mark", F.explode(F.array_distinct(F.concat(sentences, F.when(named, F.array("text")).otherwise(F.array().cast("array<string>"))))).alias("part"))
    parts = parts.distinct().withColumn("n", F.xxhash64("part"))
    weights, unknown = template_weights(files.sparkSession)
    weights = materialise(weights, "templates")  # a row a term of a template: of fixed size
    idf = weights.select("term", "idf").distinct()
    counts = parts.select("path", "mark", "n", F.explode(terms(F.col("part"))).alias("term")).groupBy("path", "mark", "n", "term").agg(F.count("*").alias("tf"))
    counts = counts.join(F.broadcast(idf), "term", "left").withColumn("raw", F.col("tf") * F.coalesce("idf", F.lit(unknown)))
    counts = materialise(counts.select("path", "mark", "n", "term", "raw"), "terms")
    key = ["path", "mark", "n"]
    null_safe = lambda a, b: a["path"].eqNullSafe(b["path"]) & (a["mark"] == b["mark"]) & (a["n"] == b["n"])
    norms = counts.groupBy(*key).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm")).alias("x")
    dots = counts.join(F.broadcast(weights), "term").groupBy(*key, "id", "name").agg(F.sum(F.col("raw") * F.col("weight")).alias("dot")).alias("d")
    score = dots.join(norms, null_safe(_Names("d"), _Names("x"))).select("d.path", "d.mark", "name", F.round(F.col("dot") / F.col("norm"), 6).alias("score"))
    close = score.where(F.col("score") >= threshold).withColumn("rank", F.when(F.col("name") == RESERVED, 0).otherwise(1))
    best = F.max_by(F.struct("name", "score"), F.struct("rank", "score", "name")).alias("best")
    return close.unionByName(declared_licenses(files)).groupBy("path", "mark").agg(best).select("path", "mark", F.col("best.name").alias("own_license"), F.col("best.score").alias("own_score"))


class _Names:
    def __init__(self, alias: str):
        self.alias = alias

    def __getitem__(self, name: str) -> Column:
        return F.col(f"{self.alias}.{name}")


def parent(path: Column) -> Column:
    """The directory of a path ('' at the top)."""
    return F.when(F.instr(path, "/") > 0, F.regexp_extract(path, r"^(.*)/[^/]*$", 1)).otherwise(F.when(path.isNotNull(), F.lit("")))


def inherited(dirs: DataFrame, licensed: DataFrame) -> DataFrame:
    """dir, license, license_from: the nearest of each directory and its ancestors (dirs: dir; licensed: dir, license)."""
    names = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(names))), lambda k: F.array_join(F.slice(names, F.lit(1), k), "/"))
    up = dirs.where("dir is not null").distinct().select("dir", F.posexplode(F.array_distinct(above)).alias("depth", "up"))
    own = licensed.select(F.col("dir").alias("up"), "license")
    found = up.join(checked_broadcast(own), "up").groupBy("dir").agg(F.max_by(F.struct("license", F.col("up").alias("license_from")), "depth").alias("x"))
    return found.select("dir", "x.license", "x.license_from")


def license_scan(files: DataFrame, path: str = "path", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """files (without the text) with own_license, own_score, license and license_from ('' is the top; null: its own or none)."""
    mark, place, p, m, d, above_, from_ = fresh(files, "mark", "dir", "own_path", "own_mark", "own_dir", "above", "above_dir")
    kept = others(files, path, text, *RESULTS)
    rows = files.select(*kept, named(path).alias("path"), named(text).alias("text")).withColumn(mark, F.xxhash64("text"))
    own = materialise(own_licenses(rows.select("path", F.col(mark).alias("mark"), "text"), threshold), "licenses")
    narrow = rows.select(*kept, "path", mark, parent(F.col("path")).alias(place))
    licensed = own.where(F.col("path").rlike(LICENSE_FILE)).groupBy(parent(F.col("path")).alias("dir")).agg(F.max_by("own_license", F.struct(F.col("own_license") != RESERVED, "own_score", "own_license")).alias("license"))
    licensed = materialise(licensed, "licensed")
    above = materialise(inherited(narrow.select(F.col(place).alias("dir")), licensed), "inherited").select(F.col("dir").alias(d), F.col("license").alias(above_), F.col("license_from").alias(from_))
    found = own.select(F.col("path").alias(p), F.col("mark").alias(m), "own_license", "own_score")
    out = narrow.join(checked_broadcast(found), F.col("path").eqNullSafe(F.col(p)) & (F.col(mark) == F.col(m)), "left")
    out = out.join(checked_broadcast(above), F.col(place) == F.col(d), "left")
    return out.select(*kept, "path", "own_license", "own_score", F.coalesce("own_license", above_).alias("license"), F.when(F.col("own_license").isNull(), F.col(from_)).alias("license_from"))


def document_path() -> Column:
    """Documents have no paths: they lie by source, language and thousands and hundreds of doc_id; every hundredth is its directory's licence file."""
    thousand, hundred = (F.floor(F.col("doc_id") / k).cast("string") for k in (1000, 100))
    name = F.when(F.col("doc_id") % 100 == 0, F.lit("LICENSE")).otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    place = F.when(F.col("doc_id") % 1000 == 0, F.concat(thousand, F.lit("/"), name)).otherwise(F.concat(thousand, F.lit("/"), hundred, F.lit("/"), name))
    return F.concat(F.coalesce("source", F.lit("")), F.lit("/"), F.coalesce("lang", F.lit("")), F.lit("/"), place)


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select("doc_id", document_path().alias("path"), "text")
    return license_scan(files).select("doc_id", "path", "own_license", "own_score", "license", "license_from")


_VALUES = ", ".join("({}, '{}', '{}')".format(i, *t) for i, t in enumerate(TEMPLATES))
OP2_SQL = rf"""
WITH t(id, name, notice) AS (VALUES {_VALUES}),
tt AS (SELECT id, name, unnest(regexp_extract_all(lower(notice), '{TERM}')) AS term FROM t),
tc AS (SELECT id, name, term, count(*) AS tf FROM tt GROUP BY ALL),
idf AS (SELECT term, 1 + ln((1 + {len(TEMPLATES)}) / (1 + count(*))) AS idf FROM tc GROUP BY term),
tr AS (SELECT id, name, term, tf * idf AS raw FROM tc JOIN idf USING (term)),
tw AS (SELECT id, name, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM tr),
f AS (SELECT doc_id, text, coalesce(source, '') || '/' || coalesce(lang, '') || '/' || (doc_id // 1000) ||
  CASE WHEN doc_id % 1000 = 0 THEN '/LICENSE' WHEN doc_id % 100 = 0 THEN '/' || (doc_id // 100) || '/LICENSE'
  ELSE '/' || (doc_id // 100) || '/' || doc_id || '.txt' END AS path FROM documents),
c AS (SELECT * FROM f WHERE regexp_matches(text, '{CUES}') OR (doc_id % 100 = 0 AND text IS NOT NULL)),
s AS (SELECT doc_id, path, unnest(string_split_regex(regexp_replace(text, '([.!?])[ \t]+', '\1' || chr(10), 'g'), '\n')) AS part FROM c),
p AS (SELECT DISTINCT doc_id, path, part FROM s WHERE regexp_matches(part, '{CUES}') UNION SELECT doc_id, path, text FROM c WHERE doc_id % 100 = 0),
w AS (SELECT doc_id, path, part, unnest(regexp_extract_all(lower(part), '{TERM}')) AS term FROM p),
wc AS (SELECT doc_id, path, part, term, count(*) AS tf FROM w GROUP BY ALL),
wr AS (SELECT doc_id, path, part, term, tf * coalesce(idf, 1 + ln({1 + len(TEMPLATES)})) AS raw FROM wc LEFT JOIN idf USING (term)),
wn AS (SELECT doc_id, part, sqrt(sum(raw * raw)) AS norm FROM wr GROUP BY ALL),
d AS (SELECT doc_id, path, part, id, name, sum(raw * weight) AS dot FROM wr JOIN tw USING (term) GROUP BY ALL),
sc AS (SELECT doc_id, path, name, round(dot / norm, 6) AS score FROM d JOIN wn USING (doc_id, part)),
own AS (SELECT doc_id, path, name, score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, name DESC) AS k FROM sc WHERE score >= {THRESHOLD}) WHERE k = 1),
ld AS (SELECT dir, name FROM (SELECT regexp_replace(path, '/[^/]*$', '') AS dir, name, row_number() OVER (PARTITION BY regexp_replace(path, '/[^/]*$', '') ORDER BY score DESC, name DESC) AS k
  FROM own WHERE ends_with(path, '/LICENSE')) WHERE k = 1),
u AS (SELECT f.doc_id, ld.name, ld.dir, row_number() OVER (PARTITION BY f.doc_id ORDER BY length(ld.dir) DESC) AS k FROM f JOIN ld ON starts_with(f.path, ld.dir || '/'))
SELECT f.doc_id, f.path, own.name AS own_license, own.score AS own_score, coalesce(own.name, u.name) AS license,
  CASE WHEN own.name IS NULL THEN u.dir END AS license_from
FROM f LEFT JOIN own ON f.doc_id = own.doc_id LEFT JOIN u ON f.doc_id = u.doc_id AND u.k = 1
"""
