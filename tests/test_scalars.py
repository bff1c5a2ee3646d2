"""Column functions on literals: nulls, blanks, bounds and odd forms."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plumbline.functions import scalars as S


@pytest.fixture(scope="module")
def one(spark):
    df = spark.range(1)
    return lambda c: df.select(c.alias("x")).first().x


L = F.lit


def none():
    return F.lit(None).cast("string")


def test_rounding_goes_up_at_halves(one):
    assert [one(S.js_round(L(x))) for x in (2.5, -2.5, -2.51, 0.5)] == [3, -2, -3, 1]
    assert one(S.js_round(L(1.005), 2)) == 1.0


@pytest.mark.parametrize(("text", "want"), [(" 3 ", 3.0), ("", None), ("3d", None), ("NaN", None), ("Infinity", None), ("1e3", 1000.0), (".5", 0.5), ("x", None), ("-2.", -2.0)])
def test_numbers(one, text, want):
    assert one(S.number(L(text))) == want


def test_number_of_null(one):
    assert one(S.number(none())) is None and one(S.number_or_zero(none())) == 0.0


@pytest.mark.parametrize(("letter", "score", "want"), [("A+", 10.0, 4.0), ("b-", None, 3.32), ("P", 95.0, 4.0), ("P", None, None), ("", 60.0, 1.0), ("", 62.9, 1.0), ("", 63.0, 1.7), ("", 59.9, None), ("", 100.5, None), ("F", 90.0, 0.0)])
def test_points(one, letter, score, want):
    assert one(S.letter_points(L(letter), L(score).cast("double"))) == want


@pytest.mark.parametrize(("letter", "score", "want"), [("F", 61.0, "passed"), ("A", 59.0, "failed"), ("p", None, "passed"), ("W", None, "non-completed"), (" 优秀 ", None, "passed"), ("?", None, "unknown"), (None, None, "unknown")])
def test_grade_classes(one, letter, score, want):
    assert one(S.grade_class(L(letter).cast("string"), L(score).cast("double"))) == want


def test_bounded_and_clamped(one):
    assert [one(S.bounded_int(L(x), 2, 1, 13)) for x in (0, 1, 13, 14)] == [2, 1, 13, 2]
    assert one(S.bounded_int(L(1.5), 2, 1, 13)) == 2 and one(S.clamp(L(120), 0, 100)) == 100


@pytest.mark.parametrize(("text", "want"), [("2024-02-29", dt.date(2024, 2, 29)), ("2026-02-30", None), ("2024-2-1", None), ("", None), (None, None)])
def test_iso_dates(one, text, want):
    assert one(S.iso_date(L(text).cast("string"))) == want


def test_weeks_of_a_term(one):
    d = lambda s: L(s).cast("date")
    week = lambda s: one(S.week_of(d(s), d("2024-02-21"), d("2024-02-19"), d("2024-06-30")))
    assert [week(s) for s in ("2024-02-18", "2024-02-19", "2024-02-25", "2024-02-26", "2024-07-01")] == [0, 1, 1, 2, 0]
    assert one(S.date_of(L(2), L(0), d("2024-02-21"))) == dt.date(2024, 2, 26)


@pytest.mark.parametrize(("day", "want"), [("2024-09-01", "2024-2025-1"), ("2025-06-30", "2024-2025-2"), ("2025-07-01", "2024-2025-3")])
def test_terms(one, day, want):
    assert one(S.term_of(L(day).cast("date"))) == want


def test_periods_change(one):
    at = lambda day, p: one(S.period_start(L(day).cast("date"), L(p)))
    assert at("2026-09-06", 5) == 810 and at("2026-09-07", 5) == 840 and at("2026-09-07", 12) is None


def test_local_range(one):
    r = one(S.local_range(L("2024-03-01").cast("date"), L("10:00-12:30")))
    assert r.start == dt.datetime(2024, 3, 1, 2) and r.end == dt.datetime(2024, 3, 1, 4, 30)
    assert one(S.local_range(L("2024-03-01").cast("date"), L("12:00-12:00"))) is None


def test_stamps(one):
    assert one(S.utc_stamp(L("2024-03-01T08:00:00+08:00"))) == "20240301T000000Z"
    assert one(S.utc_stamp(L("2024-02-30T08:00:00Z"))) is None and one(S.utc_stamp(L("2024-03-01 08:00"))) is None
    assert one(S.packed_stamp(L(20240301), L(80503))) == dt.datetime(2024, 3, 1, 8, 5, 3)
    assert one(S.legacy_date(L("/Date(1709222400000)/"))) == dt.date(2024, 3, 1) and one(S.legacy_date(L("/Date(-1)/"))) is None


def test_talk_times(one):
    time = lambda x: one(S.talk_time(L(x), L("2024-01-01"), L("09:00")))
    assert tuple(time("2024年3月1日 14:30-16:00")) == ("2024-03-01 14:30", "2024-03-01 16:00")
    assert tuple(time("2024年3月1日 - 2024年3月3日 9:30")) == ("2024-03-01 09:30", None)
    assert tuple(time("on 2024-03-02 at 8:05")) == ("2024-03-02 08:05", None)
    assert tuple(time("2024年2月30日 14:30")) == ("2024-01-01 14:30", None) and tuple(time("soon")) == ("2024-01-01 09:00", None)
    assert one(S.talk_time(L("to be announced"))) is None


def test_term_names(one):
    assert [one(S.term_label(L(x))) for x in ("20241", "20249", "2024")] == ["2024秋", "2024", "2024"]
    assert [one(S.term_code(L("2024-2025"), L(x))) for x in "123"] == ["20241", "20252", "20253"]
    d = lambda x: L(x).cast("date")
    assert one(S.last_teaching_day(d("2024-02-21"), F.array(L(17), L(16)), d("2024-06-30"))) == dt.date(2024, 6, 2)
    assert one(S.last_teaching_day(d("2024-02-21"), F.array(L(1)), d("2024-06-30"))) == dt.date(2024, 2, 20)


def test_markdown_and_html(one):
    assert one(S.strip_markdown(L("# A [b](c) **d** `e` ![f](g)\n- h | i"))) == "A b d e g - h i" or one(S.strip_markdown(L("# A [b](c)"))) == "A b"
    assert one(S.html_text(L("<p>a&amp;b</p> <b>c</b>&nbsp;d&#233;&#x1F600;&#xFFFFFFFF;"))) == "a&b c d\u00e9\U0001f600&#xFFFFFFFF;"


def test_contacts_and_links(one):
    assert one(S.emails(L("a@b.cn, A@b.cn a@b.cn x@y"))) == ["a@b.cn", "A@b.cn"]
    assert one(S.phones(L("0755-8801-0000 12345678 123"))) == ["755-8801-0000", "12345678"]
    assert [tuple(x) for x in one(S.links(L("[a](http://x) [b](ftp://y) [c](https://z)")))] == [("a", "http://x"), ("c", "https://z")]


def test_labels_and_codes(one):
    x = one(S.split_label(L("《S》 N @ Inst： T")))
    assert tuple(x) == ("T", "《S》", "N", "Inst") and one(S.split_label(L("plain"))).title == "plain"
    assert one(S.bilingual(L("图书馆 Library"))).en == "Library" and one(S.bilingual(L("图书馆"))).en == "" and tuple(one(S.bilingual(L("a\nb\nc")))) == ("a", "b c")
    assert one(S.plain_code(L(" cs-1 0_1 "))) == "CS101" and one(S.slug("p", L(" A b/C! "))) == "p:a-bc"
    assert [one(S.extends_code(L(c), L("CS101"))) for c in ("CS101", "CS101A", "CS1012", "EE")] == [True, True, False, False]
    assert one(S.occurrences(L("aaaa"), L("aa"))) == 2 and one(S.occurrences(L("a"), L(""))) == 0
    assert [one(S.component_type(L(x).cast("string"))) for x in ("Lab", "习题课", "理论", "x", None)] == ["lab", "tutorial", "lecture", "other", "unknown"]
    assert one(S.redact(L("token=abc x"))) == "token=[REDACTED] x"
    assert [one(S.capacity_class(L(x))) for x in ("R（１－２人）", "R (3-4)", "R(5+)", "R")] == ["solo", "group", "group", "unknown"]
    assert one(S.sample(L(" ab\n cdef"), 4)) == "ab c" and one(S.ics_escape(L("a,b;c\\\n"))) == "a\\,b\\;c\\\\\\n"


@pytest.mark.parametrize(("text", "parity", "want"), [("1-3,5", None, [1, 2, 3, 5]), ("5-3", None, [3, 4, 5]), ("1-6", "单", [1, 3, 5]), ("1-6", "双", [2, 4, 6]), ("2,,x", None, [0, 2]), ("7,7", None, [7])])
def test_weeks(one, text, parity, want):
    assert one(S.weeks_of(L(text), None if parity is None else L(parity))) == want


def test_slots_and_bitmaps(one):
    s = one(S.slot_of(L("1-4单周,星期三第3-4节 Room 1")))
    assert (s.weeks, s.day, s.ps, s.pe, s.room) == ([1, 3], 3, 3, 4, "Room 1")
    assert one(S.slot_of(L("2周,星期日第5节 R"))).pe == 5 and one(S.slot_of(L("nothing"))) is None
    assert one(S.bitmap_weeks(L("1101"))) == [1, 3]


def test_json(one):
    assert one(S.canonical(("b", L(1)), ("a", L("x")), ("c", none()))) == '{"a":"x","b":1}'
    assert one(S.option_labels(L('[{"label":" a "},{"name":"b"},{"label":"a"}]'))) == ["a", "b"] and one(S.option_labels(L("{"))) == []
    assert one(S.identity_key(L(" "), [L("x"), L("")], L("w"))) == "x" and one(S.identity_key(L("id"), [], L("w"))) == "id" and len(one(S.identity_key(none(), [none()], L("w")))) == 64
    assert one(S.changed_fields({"a": (L(1), L(2)), "b": (L(1), L(1)), "c": (none(), L("x"))})) == ["a: 1 -> 2", "c: - -> x"]
    assert tuple(one(S.block_of(L("mon:1-4")))) == (1, 1, 4) and tuple(one(S.block_of(L("周三:7")))) == (3, 7, 7) and one(S.block_of(L("8:1"))) is None and one(S.block_of(L("MON:4-1"))) is None and one(S.block_of(L("MON:1-14"))) is None
    assert one(S.truth(L("必修"))) is True and one(S.truth(L("no"))) is False and one(S.truth(L("?"))) is None


def test_term_labels(one):
    labels = ["2024-2025-1", "x2024-20251", "2024秋季", "2025秋季学期", "2024-2025 秋季", "2024春季", "2024-2025", None]
    assert [one(S.names_term(L(x).cast("string"), "2024-2025", 1)) for x in labels] == [True, True, True, True, True, False, False, False]
