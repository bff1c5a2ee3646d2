"""Numbers, dates, strings, arrays, maps and JSON as Column functions. Survey ids stand in brackets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Asia/Shanghai"
#: Grade points by letter.
LETTER_POINTS = {"A+": 4.0, "A": 3.94, "A-": 3.85, "B+": 3.73, "B": 3.55, "B-": 3.32, "C+": 3.09, "C": 2.78, "C-": 2.42, "D+": 2.08, "D": 1.63, "D-": 1.15, "F": 0.0}
#: Lower bounds of scores and their points.
SCORE_POINTS = [(90, 4.0), (85, 3.7), (80, 3.3), (77, 3.0), (73, 2.7), (70, 2.3), (67, 2.0), (63, 1.7), (60, 1.0)]
#: Start of each teaching period (minutes), before and from the day that the timetable changed.
OLD_PERIODS = [480, 540, 620, 680, 810, 870, 930, 990, 1080, 1140, 1200, 1260, 1320]
NEW_PERIODS = [480, 540, 620, 680, 840, 900, 980, 1040, 1140, 1200, 1260]
PERIODS_CHANGE, PERIOD_MINUTES = "2026-09-07", 50


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text(c: Column) -> Column:
    """A blank or missing string as ''."""
    return F.coalesce(F.trim(c), F.lit(""))


def first_text(*cs: Column) -> Column:
    """The first that isn't blank, trimmed; else ''."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cs], F.lit(""))


def join_text(sep: str, *cs: Column) -> Column:
    """Those that aren't blank."""
    return F.concat_ws(sep, *[F.nullif(F.trim(c), F.lit("")) for c in cs])


# Numbers


def js_round(x: Column, places: int = 0) -> Column:
    """[M01] Halves go up, also below zero."""
    f = float(10**places)
    return F.floor(x * f + 0.5) / f


def number(c: Column) -> Column:
    """[2.1] A number from dirty text, null if it isn't one; accepts no NaN, infinity or type suffix."""
    t = F.trim(c)
    return F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), t.try_cast("double"))


def number_or_zero(c: Column) -> Column:
    return F.coalesce(number(c), F.lit(0.0))


def letter_points(letter: Column, score: Column) -> Column:
    """[M02] By letter if it is known, else by score from 60 to 100."""
    out = F.lit(None).cast("double")
    for low, points in reversed(SCORE_POINTS):
        out = F.when(score >= low, F.lit(points)).otherwise(out)
    known = F.lit(None).cast("double")
    for name, points in LETTER_POINTS.items():
        known = F.when(F.upper(letter) == name, F.lit(points)).otherwise(known)
    return F.coalesce(known, F.when((score >= 60) & (score <= 100), out))


def score_points(score: Column) -> Column:
    return letter_points(F.lit(""), score)


def bounded_int(c: Column, fallback: int, low: int, high: int) -> Column:
    """[M03] The whole number if it is in the bounds, else the fallback."""
    return F.when((c == F.floor(c)) & c.between(low, high), c.cast("long")).otherwise(F.lit(fallback).cast("long"))


def flag(c: Column, bit: int) -> Column:
    """[M04]"""
    return c.bitwiseAND(F.lit(bit)) != 0


def clamp(c: Column, low, high) -> Column:
    """[M05, X14]"""
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def truth(c: Column, extended: bool = True) -> Column:
    """Yes and no words in lower case; null for others."""
    yes = ["1", "true", "yes", "required", "是", "必修"] if extended else ["1", "true", "yes"]
    no = ["0", "false", "no", "optional", "否", "选修"] if extended else []
    v = F.lower(F.trim(c))
    return F.when(v.isin(yes), True).when(v.isin(no) if no else F.lit(True), False)


# Dates


def iso_date(c: Column) -> Column:
    """[D01] A date of the form YYYY-MM-DD that exists."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(c, "yyyy-MM-dd"))


def monday(d: Column) -> Column:
    """[D06] The Monday of the date's week."""
    return F.date_sub(d, F.weekday(d))


def week_of(d: Column, teaching_start: Column, begin: Column, end: Column) -> Column:
    """[D02] Weeks from the Monday of the first, from 1; 0 outside the term."""
    return F.when(d.between(begin, end), F.floor(F.datediff(d, monday(teaching_start)) / 7) + 1).otherwise(0).cast("int")


def date_of(week: Column, weekday: Column, teaching_start: Column) -> Column:
    """[D03] weekday from 0 for Monday."""
    return F.date_add(monday(teaching_start), ((week - 1) * 7 + weekday).cast("int"))


def last_teaching_day(teaching_start: Column, final_weeks: Column, final_end: Column) -> Column:
    """[D05] The Sunday before the first final week, or the day before the finals end if that is earlier; the day before
    the start if no week is left."""
    last = F.coalesce(F.array_min(final_weeks), F.lit(1)) - 1
    return F.when(last < 1, F.date_add(teaching_start, -1)).otherwise(F.least(F.date_add(monday(teaching_start), (last * 7 - 1).cast("int")), F.date_add(final_end, -1)))


def term_of(d: Column) -> Column:
    """[D09] Academic year and term: from September the first, to June the second, else the third."""
    m, y = F.month(d), F.year(d)
    year = F.when(m >= 9, y).otherwise(y - 1)
    return F.concat(year.cast("string"), F.lit("-"), (year + 1).cast("string"), F.lit("-"), F.when(m >= 9, "1").when(m <= 6, "2").otherwise("3"))


def term_label(code: Column) -> Column:
    """[D10] 20241 reads 2024秋, then 春 and 夏; shorter codes stay."""
    name = F.try_element_at(F.create_map(*[F.lit(x) for x in ("1", "秋", "2", "春", "3", "夏")]), F.substring(code, 5, 1))
    return F.when(F.length(code) < 5, code).otherwise(F.concat(F.substring(code, 1, 4), F.coalesce(name, F.lit(""))))


def term_code(year: Column, term: Column) -> Column:
    """[D10] 2024-2025 and 2 as 20252: the first term is named by the year it begins in, the others by the next."""
    return F.when(term == "1", F.concat(F.substring(year, 1, 4), F.lit("1"))).otherwise(F.concat(F.substring(year, 6, 4), term))


#: Seasons of the three terms in labels.
SEASONS = {1: "秋季", 2: "春季", 3: "夏季"}


def names_term(label: Column, year: str, term: int) -> Column:
    """Whether a label names the term of a year (2024-2025): by its value with or without a dash, by either year and
    the season, or by both years and the season anywhere."""
    season = SEASONS[term]
    spellings = [f"{year}-{term}", f"{year}{term}", f"{year[:4]}{season}", f"{year[5:]}{season}"]
    out = label.contains(year) & label.contains(season)
    for spelling in spellings:
        out = out | label.contains(spelling)
    return F.coalesce(out, F.lit(False))


def stale(fetched: Column, updated: Column, days: int) -> Column:
    """[D11]"""
    return F.coalesce(F.unix_timestamp(fetched) - F.unix_timestamp(updated) >= days * 86400, F.lit(False))


def freshness(now: Column, at: Column, hours: int = 3) -> Column:
    """[D12, T05]"""
    return F.when(at.isNull(), "unknown").when(F.unix_timestamp(now) - F.unix_timestamp(at) > hours * 3600, "stale").otherwise("fresh")


def days_left(due: Column, now: Column, zone: str = ZONE) -> Column:
    """[D13, D14] Calendar days in the zone."""
    return F.datediff(F.from_utc_timestamp(due, zone), F.from_utc_timestamp(now, zone))


def packed_stamp(day: Column, time: Column) -> Column:
    """[D16] From yyyymmdd and hhmmss as whole numbers."""
    return F.try_to_timestamp(F.concat(F.lpad(day.cast("string"), 8, "0"), F.lpad(time.cast("string"), 6, "0")), F.lit("yyyyMMddHHmmss"))


def legacy_date(c: Column, zone: str = ZONE) -> Column:
    """[D18] /Date(ms)/ as a date of the zone; none for negative ones."""
    ms = F.regexp_extract(c, r"/Date\((\d+)", 1).try_cast("long")
    return F.to_date(F.from_utc_timestamp(F.timestamp_millis(ms), zone))


def period_start(d: Column, period: Column) -> Column:
    """[D17] Minutes from midnight, by the timetable of that day."""
    old, new = (F.array(*[F.lit(m) for m in t]) for t in (OLD_PERIODS, NEW_PERIODS))
    return F.when(d < F.lit(PERIODS_CHANGE).cast("date"), F.get(old, period - 1)).otherwise(F.get(new, period - 1))


def utc_at(d: Column, minutes: Column, zone: str = ZONE) -> Column:
    return F.to_utc_timestamp(F.timestamp_seconds(F.unix_date(d).cast("long") * 86400 + minutes * 60), zone)


def utc_stamp(c: Column) -> Column:
    """[D07] A strict ISO date and time with a zone as yyyyMMdd'T'HHmmss'Z'."""
    ok = c.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})$")
    return F.date_format(F.when(ok, F.try_to_timestamp(c)), "yyyyMMdd'T'HHmmss'Z'")


def local_range(d: Column, hours: Column) -> Column:
    """[D08] start and end minutes of HH:MM-HH:MM, if the end is later."""
    m = lambda k: F.nullif(F.regexp_extract(hours, r"^\s*(\d{1,2}):(\d{2})\s*[-~–]\s*(\d{1,2}):(\d{2})\s*$", k), F.lit("")).cast("int")
    begin, end = m(1) * 60 + m(2), m(3) * 60 + m(4)
    ok = (m(1) < 24) & (m(2) < 60) & (m(3) < 24) & (m(4) < 60) & (end > begin)
    return F.when(ok, F.struct(utc_at(d, begin).alias("start"), utc_at(d, end).alias("end")))


#: Forms of the times of talks, on one day and over several.
ONE_DAY = r"^(\d{4})年(\d{1,2})月(\d{1,2})日\s+(\d{1,2}:\d{2})(?:-(\d{1,2}:\d{2}))?$"
SOME_DAYS = r"^(\d{4})年(\d{1,2})月(\d{1,2})日\s*-\s*(\d{4})年(\d{1,2})月(\d{1,2})日\s+(\d{1,2}:\d{2})(?:-(\d{1,2}:\d{2}))?$"


def clock(c: Column) -> Column:
    """HH:MM, padded; null if it is no time of day."""
    padded = F.lpad(c, 5, "0")
    return F.when(padded.rlike(r"^([01]\d|2[0-3]):[0-5]\d$"), padded)


def talk_time(c: Column, slug_date: Column | None = None, slug_time: Column | None = None) -> Column:
    """[D15] start and end (local, YYYY-MM-DD HH:MM): one day, several days, else any date and time inside, else the slug's."""
    none = F.lit(None).cast("string")

    def form(pattern: str, day: int, last: int, time: int) -> Column:
        g = lambda k: F.regexp_extract(c, pattern, k)
        date = lambda k: iso_date(F.concat_ws("-", g(k), F.lpad(g(k + 1), 2, "0"), F.lpad(g(k + 2), 2, "0")))
        begin, until, start, end = date(day), date(last), clock(g(time)), clock(g(time + 1))
        ok = c.rlike(pattern) & (begin <= until) & start.isNotNull() & ((g(time + 1) == "") | end.isNotNull())
        return F.when(ok, F.struct(F.concat_ws(" ", begin.cast("string"), start).alias("start"), F.when(end.isNotNull(), F.concat_ws(" ", until.cast("string"), end)).alias("end")))

    inside = lambda p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    date = F.coalesce(iso_date(inside(r"(\d{4}-\d{2}-\d{2})")).cast("string"), none if slug_date is None else slug_date)
    time = F.coalesce(clock(inside(r"(\d{1,2}:\d{2})")), none if slug_time is None else slug_time)
    loose = F.when(date.isNotNull() & time.isNotNull(), F.struct(F.concat_ws(" ", date, time).alias("start"), none.alias("end")))
    return F.coalesce(form(ONE_DAY, 1, 1, 4), form(SOME_DAYS, 1, 4, 7), loose)


# Strings


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


#: How Markdown is taken off, in order.
MARKDOWN_STEPS = [
    (r"!\[[^\]]*\]\(([^)]+)\)", " $1 "), (r"\[([^\]]+)\]\(([^)]+)\)", "$1"), (r"`([^`]+)`", "$1"), (r"[*_~>#]", " "), (r"<Badge[^>]*/>", " "),
    (r"(?m):::.+$", " "), (r"(?m)^\s*[-*+]\s+", " "), (r"\|", " "), (r"</?[^>]+>", " "),
]


def strip_markdown(c: Column) -> Column:
    """[C01]"""
    for pattern, to in MARKDOWN_STEPS:
        c = F.regexp_replace(c, pattern, to)
    return collapse(c)


#: Named entities, decoded in this order.
ENTITIES = {"&nbsp;": " ", "&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'"}


def html_text(c: Column) -> Column:
    """[C02] Tags taken out, entities decoded (names, then hexadecimal and decimal numbers), white space collapsed."""
    c = F.regexp_replace(c, r"<[^>]+>", "")
    for name, to in ENTITIES.items():
        c = F.regexp_replace(c, f"(?i){name}", to)
    return collapse(_numeric(_numeric(c, r"(?i)&#x[0-9a-f]+;", 16), r"&#[0-9]+;", 10))


def _numeric(c: Column, pattern: str, base: int) -> Column:
    """With numeric entities decoded, each distinct one once."""
    return let(c, lambda x: F.aggregate(F.array_distinct(F.regexp_extract_all(x, F.lit(pattern), 0)), x, lambda acc, e: F.replace(acc, e, _character(e, base))))


def _character(entity: Column, base: int) -> Column:
    """What a numeric entity stands for; itself where there is no such character."""
    digits = F.regexp_extract(entity, r"([0-9a-fA-F]+);$", 1)
    code = F.conv(digits, base, 10).cast("long")
    real = (F.length(digits) <= 8) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(real, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(entity)


#: How a manual page becomes text, in order.
MANUAL_STEPS = [
    (r"```[\s\S]*?```", " "), (r"(?i)<iframe[\s\S]*?</iframe>", " "), (r"(?i)<AdSenseDisplayAD\s*/>", " "), (r"!\[[^\]]*\]\(([^)]+)\)", " "), (r"(?i)<a\b[^>]*>", " "), (r"(?i)</a>", " "),
    (r"\[([^\]]+)\]\(([^)]+)\)", "$1"), (r"<Badge[^>]*/>", " "), (r"(?i):::\s*(?:tip|warning|details)[^\n]*\n", " "), (r"(?m)^:::\s*$", " "), (r"(?m)^\s*[-+*]\s+", " "), (r"(?m)^\s*\d+\.\s+", " "),
    (r"(?m)^\s*>\s*", " "), (r"(?m)^\s*\|?(?:\s*:?-{3,}:?\s*\|)+\s*$", " "), (r"\|", " "), (r"`([^`]+)`", "$1"), (r"[*_~#]", " "), (r"</?[^>]+>", " "),
]


def sanitise_manual(c: Column) -> Column:
    """[C03]"""
    for pattern, to in MANUAL_STEPS:
        c = F.regexp_replace(c, pattern, to)
    return collapse(c)


def slug(prefix: str, c: Column) -> Column:
    """[C04]"""
    return F.concat(F.lit(prefix + ":"), F.regexp_replace(F.regexp_replace(F.lower(collapse(c)), r"\s+", "-"), r"[^\p{L}\p{N}-]", ""))


def distinct_texts(a: Column) -> Column:
    """[R06, Y05] In order, trimmed, no blanks."""
    return F.array_distinct(F.filter(F.transform(a, collapse), lambda x: x != ""))


def emails(c: Column) -> Column:
    """[C05]"""
    return distinct_texts(F.regexp_extract_all(c, F.lit(r"(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"), 0))


def phones(c: Column) -> Column:
    """[C05]"""
    return distinct_texts(F.regexp_extract_all(c, F.lit(r"\d{3}-\d{3,4}-\d{4}(?:-\d)?|\d{8,11}"), 0))


def links(c: Column, most: int = 20) -> Column:
    """[C06] Text and url of Markdown links to http or https."""
    found = F.transform(F.regexp_extract_all(c, F.lit(r"\[[^\]]+\]\([^)\s]+\)"), 0), lambda m: F.struct(F.regexp_extract(m, r"^\[([^\]]+)\]", 1).alias("text"), F.regexp_extract(m, r"\(([^)]+)\)$", 1).alias("url")))
    return F.slice(F.filter(found, lambda x: x["url"].rlike(r"^https?://")), 1, most)


def split_label(c: Column) -> Column:
    """[C07] 《series》 speaker @ affiliation: title."""
    c = strip_markdown(c)
    at = F.when(F.instr(c, "：") > 0, F.instr(c, "：")).otherwise(F.instr(c, ":"))
    left, right = F.trim(F.substr(c, F.lit(1), at - 1)), F.trim(F.substr(c, at + 1))
    series = F.when(left.startswith("《") & (F.instr(left, "》") > 0), F.regexp_extract(left, "^(.*》)", 1))
    speaker = F.nullif(F.trim(F.when(series.isNotNull(), F.regexp_extract(left, "^.*》(.*)$", 1)).otherwise(left)), F.lit(""))
    cut = F.instr(speaker, " @ ")
    return F.when(at > 0, F.struct(
        F.when(right == "", c).otherwise(right).alias("title"), series.alias("series"), F.when(cut > 0, F.trim(F.substr(speaker, F.lit(1), cut - 1))).otherwise(speaker).alias("speaker"),
        F.when(cut > 0, F.nullif(F.trim(F.substr(speaker, cut + 3)), F.lit(""))).alias("affiliation"),
    )).otherwise(F.struct(c.alias("title"), F.lit(None).cast("string").alias("series"), F.lit(None).cast("string").alias("speaker"), F.lit(None).cast("string").alias("affiliation")))


def bilingual(c: Column) -> Column:
    """[C08] By lines if there are any, else a part that ends in a Chinese character and a Latin part after a space."""
    pattern = r"^(.*?[\x{3400}-\x{9fff}])\s+([A-Za-z].*)$"
    lines = F.split(c, "\n")
    by_line = F.struct(F.trim(F.get(lines, F.lit(0))).alias("zh"), F.trim(F.array_join(F.slice(lines, F.lit(2), F.size(lines)), " ")).alias("en"))
    by_form = F.struct(F.trim(F.regexp_extract(c, pattern, 1)).alias("zh"), F.trim(F.regexp_extract(c, pattern, 2)).alias("en"))
    return F.when(F.size(lines) > 1, by_line).when(c.rlike(pattern), by_form).otherwise(F.struct(F.trim(c).alias("zh"), F.lit("").alias("en")))


def plain_code(c: Column) -> Column:
    """[C09]"""
    return F.upper(F.regexp_replace(c, r"[\s_-]+", ""))


#: General words of labels of gaps.
GENERAL_RE = "课程群|课程|模块|方向|类别"


def plain_label(c: Column) -> Column:
    """[C10] Lower case, without white space, separators and brackets, and without general words."""
    return F.regexp_replace(F.lower(F.regexp_replace(c, r"[\s·•（）()\-—_/]+", "")), GENERAL_RE, "")


def extends_code(code: Column, base: Column) -> Column:
    """[C11] The base itself, or followed by something that begins with a letter."""
    rest = F.substr(code, F.length(base) + 1)
    return (code == base) | (code.startswith(base) & rest.rlike("^[A-Za-z]"))


def occurrences(c: Column, term: Column) -> Column:
    """[C12] Without overlap."""
    return F.when(F.length(term) > 0, (F.length(c) - F.length(F.replace(c, term, F.lit("")))) / F.length(term)).otherwise(0).cast("long")


def component_type(c: Column) -> Column:
    """[C14]"""
    v = F.lower(text(c))
    return F.when(v.rlike("实验|lab"), "lab").when(v.rlike("习题|辅导|tutorial"), "tutorial").when(v.rlike("讲授|理论|lecture"), "lecture").when(v != "", "other").otherwise("unknown")


def redact(c: Column) -> Column:
    """[C15] Values of secrets in a message, which is cut at 2000 characters."""
    c = F.regexp_replace(c, r"(?i)\b(authorization|cookie|password|token)\s*[:=]\s*[^\s,;]+", "$1=[REDACTED]")
    return F.coalesce(F.nullif(F.substring(c, 1, 2000), F.lit("")), F.lit("(no message)"))


def capacity_class(c: Column) -> Column:
    """[C16] group for rooms of three and more by (a-b) or (a+), full-width too, else solo; unknown without."""
    t = F.lower(F.translate(c, "（）－～–—＋０１２３４５６７８９", "()----+0123456789"))
    t = F.regexp_replace(t, "[~]", "-")
    low = F.coalesce(F.nullif(F.regexp_extract(t, r"\((\d+)\s*-\s*\d+\s*(?:人|位|people|persons?)?\)", 1), F.lit("")), F.nullif(F.regexp_extract(t, r"\((\d+)\s*(?:人|位|people|persons?)?\s*(?:以上|\+|or more|and above)\)", 1), F.lit(""))).cast("int")
    return F.when(low >= 3, "group").when(low.isNotNull(), "solo").otherwise("unknown")


#: Grades in words and letters that pass, fail, or leave a course unfinished.
PASSING = ["A+", "A", "A-", "B+", "B", "B-", "C+", "C", "C-", "D+", "D", "D-", "P", "PASS", "PASSED", "S", "SATISFACTORY", "通过", "合格", "及格", "优秀", "良好", "中等"]
FAILING = ["F", "FAIL", "FAILED", "NP", "N", "UNSATISFACTORY", "不及格", "不合格", "未通过", "不通过"]
UNFINISHED = ["W", "WITHDRAW", "WITHDRAWN", "I", "IP", "INC", "INCOMPLETE", "AU", "AUDIT", "DROP", "DROPPED", "PENDING", "缺考", "缓考", "退课", "撤课", "未完成"]


def grade_class(letter: Column, score: Column) -> Column:
    """[C17] The score decides if there is one (60 passes), else the letter."""
    v = F.upper(collapse(F.coalesce(letter, F.lit(""))))
    by_letter = F.when(v.isin(PASSING), "passed").when(v.isin(FAILING), "failed").when(v.isin(UNFINISHED), "non-completed").otherwise("unknown")
    return F.when(score >= 60, "passed").when(score < 60, "failed").otherwise(by_letter)


def sample(c: Column, n: int = 160) -> Column:
    """[C18] The first characters, white space collapsed."""
    return F.substring(collapse(c), 1, n)


# Arrays and maps


def weeks_of(c: Column, parity: Column | None = None) -> Column:
    """[Y01] 1-8,10 as sorted distinct weeks; an empty part counts as week 0; 单 keeps odd weeks, 双 even ones."""
    ends = lambda p, k: F.trim(F.split_part(p, F.lit("-"), F.lit(k)))
    whole = lambda s: F.when(s == "", F.lit(0)).when(s.rlike(r"^\d+$"), s.try_cast("int"))

    def part(p: Column) -> Column:
        a = whole(ends(p, 1))
        b = F.when(F.instr(p, "-") > 0, whole(ends(p, 2)))
        return F.when(a.isNull(), F.array().cast("array<int>")).otherwise(F.sequence(F.least(a, F.coalesce(b, a)), F.greatest(a, F.coalesce(b, a))))

    out = F.array_sort(F.array_distinct(F.flatten(F.transform(F.split(c, ","), part))))
    if parity is None:
        return out
    return F.filter(out, lambda w: F.when(parity == "单", w % 2 == 1).when(parity == "双", w % 2 == 0).otherwise(True))


def bitmap_weeks(c: Column) -> Column:
    """[Y02] Places of 1, without the first."""
    return F.filter(F.sequence(F.lit(0), F.length(c)), lambda i: (i > 0) & (F.substr(c, i + 1, F.lit(1)) == "1"))


#: Fixed value: the form of a timetable line (weeks, parity, day, first and last period, room).
SLOT_RE = r"^([\d,-]+)(单|双)?周,星期([一二三四五六日])第(\d+)(?:-(\d+))?节\s+(.+)$"


def slot_of(line: Column) -> Column:
    """[Y04]"""
    g = lambda k: F.regexp_extract(line, SLOT_RE, k)
    return F.when(line.rlike(SLOT_RE), F.struct(
        weeks_of(g(1), g(2)).alias("weeks"), F.array_position(F.split(F.lit("一二三四五六日"), ""), g(3)).cast("int").alias("day"),
        g(4).cast("int").alias("ps"), F.coalesce(F.nullif(g(5), F.lit("")), g(4)).cast("int").alias("pe"), F.trim(g(6)).alias("room"),
    ))


def number_map(m: Column) -> Column:
    """[P09, Y08] Entries whose value is a number."""
    return F.map_filter(F.transform_values(m, lambda _, v: number(v)), lambda _, v: v.isNotNull())


def option_labels(c: Column) -> Column:
    """[G05, P22] Labels of options in a JSON string; none if it can't be read."""
    got = F.from_json(c, "array<struct<label:string,name:string>>")
    return F.coalesce(distinct_texts(F.transform(got, lambda o: F.coalesce(o["label"], o["name"], F.lit("")))), F.array().cast("array<string>"))


def canonical(*fields: tuple[str, Column]) -> Column:
    """[G01] JSON with sorted keys; missing members go."""
    return F.to_json(F.struct(*[c.alias(name) for name, c in sorted(fields)]))


def digest(c: Column) -> Column:
    """[G02]"""
    return F.sha2(c, 256)


def identity_key(explicit: Column, parts: list[Column], whole: Column) -> Column:
    """[G04] The explicit id, else the parts that there are, else the digest."""
    joined = join_text("/", *parts)
    return F.coalesce(F.nullif(F.trim(explicit), F.lit("")), F.nullif(joined, F.lit("")), digest(whole))


def changed_fields(fields: dict[str, tuple[Column, Column]]) -> Column:
    """[G06]"""
    return F.array_compact(F.array(*[F.when(~a.eqNullSafe(b), F.concat(F.lit(f"{k}: "), F.coalesce(a.cast("string"), F.lit("-")), F.lit(" -> "), F.coalesce(b.cast("string"), F.lit("-")))) for k, (a, b) in fields.items()]))


#: Names of days in block specs.
DAYS = ["MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN"]
DAYS_ZH = ["周一", "周二", "周三", "周四", "周五", "周六", "周日"]


def block_of(c: Column) -> Column:
    """[G07] MON:1-4, 周三:7-8 or 5:9 as day and periods; null if out of bounds (1 to 13)."""
    pattern = r"^([^:]+):(\d+)(?:-(\d+))?$"
    g = lambda k: F.regexp_extract(F.trim(c), pattern, k)
    name = F.upper(F.trim(g(1)))
    place = lambda names: F.nullif(F.array_position(F.array(*[F.lit(d) for d in names]), name), F.lit(0)).cast("int")
    day = F.coalesce(place(DAYS), place(DAYS_ZH), F.when(name.rlike("^[1-7]$"), name.try_cast("int")))
    ps, pe = g(2).try_cast("int"), F.coalesce(g(3).try_cast("int"), g(2).try_cast("int"))
    return F.when(day.isNotNull() & (ps >= 1) & (pe >= ps) & (pe <= 13), F.struct(day.alias("day"), ps.alias("ps"), pe.alias("pe")))


def ics_escape(c: Column) -> Column:
    """[G08]"""
    for a, b in (("\\", "\\\\"), (";", "\\;"), (",", "\\,"), ("\n", "\\n")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c
