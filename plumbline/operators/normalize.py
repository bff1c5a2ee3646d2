"""Raw records (columns of text, as services send them) to typed ones. Survey ids stand in brackets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import scalars as S
from plumbline.operators.rank import score_label


#: Prefixes of bundle ids by where the id comes from.
BUNDLE, SELECTION, TASK = "tis-bundle:", "tis-selection:", "tis-task:"


def _get(df: DataFrame, *names: str) -> Column:
    """The first of the columns, by any case, that isn't blank; '' if none is there."""
    have = {c.lower(): c for c in df.columns}
    found = [F.col(have[n.lower()]).cast("string") for n in names if n.lower() in have]
    return S.first_text(*found) if found else F.lit("")


def _number(df: DataFrame, *names: str) -> Column:
    have = {c.lower(): c for c in df.columns}
    found = [S.number(F.col(have[n.lower()]).cast("string")) for n in names if n.lower() in have]
    return F.coalesce(*found) if found else F.lit(None).cast("double")


def schedule(html: Column) -> Column:
    """[Y03, Y04] Slots of the paragraphs of a schedule in HTML."""
    lines = F.transform(F.regexp_extract_all(html, F.lit("<p>([^<]*)</p>"), 1), lambda p: F.trim(F.replace(F.replace(p, F.lit("&nbsp;"), F.lit(" ")), F.lit("&amp;"), F.lit("&"))))
    return F.filter(F.transform(lines, S.slot_of), lambda s: s.isNotNull())


def sections(raw: DataFrame) -> DataFrame:
    """[P01, P02, Y05] Sections of courses, with their bundle: explicit, else by selection, else by task."""
    task, own = _get(raw, "rwh"), _get(raw, "id", "courseId", "course_id")
    explicit = _get(raw, "bundleId", "bundle_id", "kczid", "zhrwid", "parentRwh", "parent_rwh")
    bundle = F.when(task == "", F.lit(None)).when(explicit != "", F.concat(F.lit(BUNDLE), explicit)).when(own != "", F.concat(F.lit(SELECTION), own)).otherwise(F.concat(F.lit(TASK), task))
    teachers = S.distinct_texts(F.split(_get(raw, "dgjsmc"), "[,，、]"))
    return raw.select(
        _get(raw, "kcdm").alias("code"), _get(raw, "kcmc").alias("name"), task.alias("task"), F.coalesce(F.nullif(_get(raw, "kxh"), F.lit("")), F.element_at(F.split(task, "-"), -1)).alias("class_group"),
        F.coalesce(_number(raw, "xf"), F.lit(0.0)).alias("credits"), F.coalesce(_number(raw, "zxs"), F.lit(0.0)).alias("hours"), _number(raw, "zrl").alias("capacity"), _number(raw, "bkrs", "yxrs", "xkrs").alias("enrolled"),
        teachers.alias("teachers"), schedule(_get(raw, "kcxx")).alias("schedule"), bundle.alias("bundle"), S.component_type(_get(raw, "componentType", "rwlxmc", "rwlx")).alias("component"), F.coalesce(S.truth(_get(raw, "required", "sfbd")), F.lit(True)).alias("required"),
    )


def entries(raw: DataFrame) -> DataFrame:
    """[P03] Entries of a personal timetable: periods by column, else by key, else by description; weeks by bitmap, else by description."""
    key, text = _get(raw, "KEY"), _get(raw, "SKSJ")
    meet = r"\[([\d,，、\s-]+)(单|双)?周\]\s*\[([^\[\]]*)\]\s*\[(\d+)(?:-(\d+))?节\]"
    g = lambda k: F.regexp_extract(text, meet, k)
    by_key = lambda k: F.regexp_extract(key, r"(?i)^xq(\d+)_jc(\d+)", k).try_cast("int")
    start = F.coalesce(_number(raw, "KSJC").cast("int"), by_key(2), g(4).try_cast("int"))
    end = F.coalesce(_number(raw, "JSJC").cast("int"), g(5).try_cast("int"), g(4).try_cast("int"), start)
    bitmap = _get(raw, "ZC")
    weeks = F.when(bitmap != "", S.bitmap_weeks(bitmap)).when(text.rlike(meet), S.weeks_of(F.regexp_replace(g(1), "[，、]", ","), g(2))).otherwise(F.array().cast("array<int>"))
    return raw.select(_get(raw, "RWH").alias("task"), _get(raw, "KCDM").alias("code"), F.coalesce(F.nullif(_get(raw, "KCMC", "KCWZSM"), F.lit("")), F.trim(F.split_part(text, F.lit("\n"), F.lit(1)))).alias("name"), F.coalesce(F.nullif(_get(raw, "SKDD", "JXDD"), F.lit("")), F.trim(g(3))).alias("room"), by_key(1).alias("day"), start.alias("ps"), end.alias("pe"), weeks.alias("weeks"))


def grade_records(raw: DataFrame) -> DataFrame:
    """[P04]"""
    letter, score = _get(raw, "xscj"), _number(raw, "zzcj")
    return raw.select(_get(raw, "kcdm").alias("code"), _get(raw, "kcmc").alias("name"), _get(raw, "xnxqmc").alias("semester"), F.coalesce(_number(raw, "xf"), F.lit(0.0)).alias("credits"), letter.alias("letter"), score.alias("score"), _get(raw, "kcxz").alias("nature"), _get(raw, "yxmc").alias("department"), S.letter_points(letter, score).alias("points"))


def exams(raw: DataFrame) -> DataFrame:
    """[P05, P28] with start and end in UTC where date and time can be read."""
    day, hours = S.iso_date(_get(raw, "KSRQ")), _get(raw, "KSJTSJ")
    at = S.local_range(day, hours)
    return raw.select(_get(raw, "KCDM").alias("code"), _get(raw, "KCMC").alias("name"), day.alias("day"), hours.alias("hours"), at["start"].alias("start"), at["end"].alias("end"), S.join_text(" ", _get(raw, "JXLMC"), _get(raw, "JXCDMC")).alias("room"))


def exam_omission(day: Column, start: Column, semester: Column, wanted: str) -> Column:
    """[R15] Why an exam isn't in the calendar; null if it is."""
    return F.when(semester == "", "term_missing").when(semester != wanted, "term_mismatch").when(day.isNull(), "bad_date").when(start.isNull(), "bad_time")


def usage(raw: DataFrame) -> DataFrame:
    """[P16, D16] Printing records: three amounts in cents as one cost, packed whole numbers as a time."""
    n = lambda *names: F.coalesce(_number(raw, *names), F.lit(0.0)).cast("long")
    day = n("dwDate")
    return raw.select(n("dwSID").alias("id"), F.when(day != 0, S.packed_stamp(day, n("dwTime"))).alias("at"), n("dwPages").alias("pages"), ((n("dwUsedCardMoney") + n("dwUsedFreeMoney") + n("dwUsedMoney")) / 100).alias("cost"))


def stations(raw: DataFrame) -> DataFrame:
    """[P21, M04] Printers: abilities as bits, distinct papers in order, group of a thousand."""
    n = lambda name: F.coalesce(_number(raw, name), F.lit(0.0)).cast("long")
    bits = {"can_print": 1, "can_copy": 2, "can_scan": 4, "can_color": 8}
    papers = F.array_distinct(F.array_compact(F.array(*[F.nullif(_get(raw, f"dwTrayPaper{i}"), F.lit("")) for i in (1, 2, 3, 4)])))
    return raw.select(n("dwDevSN").alias("id"), _get(raw, "szName").alias("name"), *[S.flag(n("dwProperty"), b).alias(k) for k, b in bits.items()], papers.alias("papers"), F.floor(n("dwDevSN") / 1000).alias("server_group"))


def programs(raw: DataFrame) -> DataFrame:
    """[P23, D18]"""
    return raw.select(_get(raw, "ID").alias("id"), S.collapse(_get(raw, "Name")).alias("name"), F.coalesce(S.legacy_date(_get(raw, "ApplyBeginDate")).cast("string"), _get(raw, "ApplyBeginDateText")).alias("begins"), F.coalesce(S.legacy_date(_get(raw, "ApplyEndDate")).cast("string"), _get(raw, "ApplyEndDateText")).alias("ends"))


def degree_progress(rows: DataFrame) -> DataFrame:
    """[P07] id, required, completed, remaining, disagrees from an overview and a summary.

    The overview's number goes first; what remains is required less completed, never below 0, if both are known, else as
    the summary says; disagrees where both sources give a number and they aren't the same."""
    required = F.coalesce("overview_required", "summary_required")
    remaining = F.when(required.isNotNull() & F.col("completed").isNotNull(), F.greatest(required - F.col("completed"), F.lit(0.0))).otherwise(F.col("summary_remaining"))
    apart = F.coalesce(F.abs(F.col("overview_required") - F.col("summary_required")) >= 1e-6, F.lit(False))
    return rows.select("id", required.alias("required"), "completed", remaining.alias("remaining"), apart.alias("disagrees"))


LEVELS = ("terse", "normal", "verbose")


def at_level(df: DataFrame, level: str, columns: dict[str, list[str]]) -> DataFrame:
    """[P18] The columns of the level and of those below it; columns of higher levels aren't there at all."""
    if level not in LEVELS:
        raise ValueError(f"no level {level}")
    return df.select(*[c for name in LEVELS[: LEVELS.index(level) + 1] for c in columns.get(name, [])])


def catalog_rows(df: DataFrame, body: str) -> DataFrame:
    """[P20] df with doc_id, context (L unless it is given), title, format and full_text of library records in JSON; those
    without an id or a title go."""
    many = "array<string>"
    kind = f"struct<context:string,docid:string,pnx:struct<control:struct<recordid:{many}>,display:struct<title:{many},type:{many}>,links:struct<lds:{many}>>>"
    own = df.withColumn("__r", F.from_json(body, kind))
    first = lambda c: F.nullif(F.trim(F.get(F.col(c), F.lit(0))), F.lit(""))
    shown = lambda c: F.nullif(S.html_text(first(c)), F.lit(""))
    labels = F.coalesce("__r.pnx.links.lds", F.array().cast(many))
    out = own.select(*df.columns, F.coalesce(first("__r.pnx.control.recordid"), F.nullif(F.col("__r.docid"), F.lit(""))).alias("doc_id"), F.coalesce(F.nullif(F.col("__r.context"), F.lit("")), F.lit("L")).alias("context"), shown("__r.pnx.display.title").alias("title"), shown("__r.pnx.display.type").alias("format"), has_full_text(F.lit(None).cast("string"), labels).alias("full_text"))
    return out.where("doc_id is not null and title is not null")


def review_rows(df: DataFrame, body: str) -> DataFrame:
    """[P08] Reviews in JSON: id, rating, content, author, term, difficulty."""
    own = df.select(F.from_json(body, "struct<id:bigint,rate:string,content:string,author:struct<name:string>,term:string,difficulty:double>").alias("r"))
    return own.select("r.id", S.number(F.col("r.rate")).alias("rating"), S.html_text(F.coalesce("r.content", F.lit(""))).alias("content"), S.text(F.col("r.author.name")).alias("author"), S.term_label(F.col("r.term")).alias("term"), score_label(F.col("r.difficulty"), "difficulty").alias("difficulty"))


def identity(df: DataFrame, shown: tuple[str, ...], masked: tuple[str, ...] = ()) -> Column:
    """[P12, P13] A record of the shown columns only, in JSON; of masked ones the first character stays, and blank members go."""
    def value(name: str) -> Column:
        v = F.nullif(F.trim(df[name]), F.lit(""))
        return F.concat(F.substring(v, 1, 1), F.repeat(F.lit("*"), F.length(v) - 1)) if name in masked else v

    return F.to_json(F.struct(*[value(n).alias(n) for n in shown]))


#: What changes by itself in records of a source.
VOLATILE = {"blackboardDeadlines": {"daysLeft"}, "grades": {"gpaPoints"}, "exams": {"weekday", "weekdayEn"}}


def comparable(source: str, fields: dict[str, Column]) -> Column:
    """[G03] A record as sorted JSON, without what changes by itself."""
    return S.canonical(*[(name, c) for name, c in fields.items() if name not in VOLATILE.get(source, ())])


def categories(raw: DataFrame) -> DataFrame:
    """[P06] Credit categories: what remains is as reported, else required less earned, never below 0."""
    required, done = F.coalesce(_number(raw, "required"), F.lit(0.0)), F.coalesce(_number(raw, "completed"), F.lit(0.0))
    return raw.select(_get(raw, "name").alias("name"), required.alias("required"), done.alias("completed"), F.coalesce(_number(raw, "remaining"), F.greatest(required - done, F.lit(0.0))).alias("remaining"))


def works(raw: DataFrame, wanted: tuple[str, ...] = ("journal-article", "proceedings-article", "posted-content")) -> DataFrame:
    """[P19] Papers of the wanted kinds (or of none), without supplements by their identifier."""
    doi = F.lower(F.coalesce("doi", F.lit("")))
    extra = doi.contains("/suppl") | doi.rlike(r"\.s00\d$")
    kind = F.coalesce("type", F.lit(""))
    return raw.where(((kind == "") | kind.isin(*wanted)) & ~extra)


#: Words that deny a full text, and that offer one.
DENIED_RE = r"(^|[\s_-])(false|no|none|unavailable)([\s_-]|$)|no_fulltext|no_full_text|no_link|without_fulltext"
OFFERED_RE = r"full[\s_-]?text|online|electronic|view[\s_-]?online|link[\s_-]?to[\s_-]?source"


def has_full_text(flag: Column, labels: Column) -> Column:
    """[P24] The explicit flag (true, false, 1 or 0) if there is one; else the labels, of which a denial decides first."""
    own = F.when(F.lower(F.trim(flag)).isin("true", "1"), True).when(F.lower(F.trim(flag)).isin("false", "0"), False)
    any_ = lambda p: F.exists(labels, lambda x: F.lower(x).rlike(p))
    return F.coalesce(own, F.when(any_(DENIED_RE), False).when(any_(OFFERED_RE), True), F.lit(False))


#: Forms inside a room's live text.
LIVE = {"kind": "^【(借用|本|研|研本|本研|其他)】", "weeks": r"\[([0-9,\-]+)周\]", "periods": r"(?:第|\[J)(\d+)(?:-(\d+))?(?:节|\])", "borrower": r"使用人[:：]([^\n]+)", "course": r"^【[^】]+】([^\[\n]+)"}


def room_text(c: Column) -> Column:
    """[Y06] kind, weeks, periods, borrower and course of a room's live text; null if it is blank."""
    t = F.trim(c)
    kind, ps = F.regexp_extract(t, LIVE["kind"], 1), F.regexp_extract(t, LIVE["periods"], 1).try_cast("int")
    weeks = F.regexp_extract(t, LIVE["weeks"], 1)
    got = lambda k: F.nullif(F.trim(F.regexp_extract(t, LIVE[k], 1)), F.lit(""))
    return F.when(S.text(c) != "", F.struct(
        F.when(kind == "借用", "borrowing").when(kind.isin("本", "研", "研本", "本研"), "course").otherwise("unknown").alias("kind"),
        F.when(weeks != "", S.weeks_of(weeks)).otherwise(F.array().cast("array<int>")).alias("weeks"), ps.alias("ps"), F.coalesce(F.regexp_extract(t, LIVE["periods"], 2).try_cast("int"), ps).alias("pe"), got("borrower").alias("borrower"), got("course").alias("course"),
    ))


def room_name(c: Column, aliases: dict[str, str]) -> Column:
    """[C13] The longest alias that begins the name is replaced."""
    name = F.regexp_replace(F.trim(c), r"\s+", "")
    out = name
    for alias in sorted(aliases, key=len):
        out = F.when(name.startswith(alias), F.concat(F.lit(aliases[alias]), F.substr(name, F.lit(len(alias) + 1)))).otherwise(out)
    return out


def provenance(url: Column, fetched: Column, updated: Column, ai: bool = False, stale_days: int = 365) -> Column:
    """[P17, D11]"""
    notes = F.array_compact(F.array(F.lit("COMMUNITY_MAINTAINED"), F.when(F.lit(ai), "AI_PROCESSED_SOURCE"), F.when(updated.isNull(), "SOURCE_UPDATE_UNKNOWN"), F.when(S.stale(fetched, updated, stale_days), "STALE_SOURCE")))
    return F.struct(F.lit("community").alias("authority"), url.alias("source_url"), updated.alias("source_updated_at"), fetched.alias("fetched_at"), notes.alias("advisories"))


def planning_view(df: DataFrame, forbidden: tuple[str, ...] = ("score", "letter", "points", "gpa")) -> DataFrame:
    """[P10, P11, P13] Without the forbidden columns; a nested field of such a name is an error."""
    def visit(kind: T.DataType, path: str) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                if f.name.lower() in forbidden:
                    raise ValueError(f"{path}{f.name} may not be shown")
                visit(f.dataType, f"{path}{f.name}.")
        elif isinstance(kind, T.ArrayType):
            visit(kind.elementType, path)
        elif isinstance(kind, T.MapType):
            visit(kind.valueType, path)

    out = df.drop(*[c for c in df.columns if c.lower() in forbidden])
    visit(out.schema, "")
    return out


#: Kinds of content by handler.
HANDLERS = {"resource/x-bb-file": "file", "resource/x-bb-folder": "folder", "resource/x-bb-assignment": "assignment", "resource/x-bb-asmt-test-link": "assignment", "resource/x-bb-document": "document"}


def handler_kind(c: Column) -> Column:
    """[P27]"""
    out = F.lit("unknown")
    for handler, kind in HANDLERS.items():
        out = F.when(c == handler, kind).otherwise(out)
    return out
