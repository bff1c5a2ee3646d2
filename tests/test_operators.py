"""Operators on small tables, with the properties that must hold on any."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import agenda, asof, audit, booking, degree, diff, feeds, intervals, keys, lookup, normalize, rank, solver, tree

SLOTS = "section long, code long, day int, ps int, pe int, weeks array<int>, room int, campus string"


def random_slots(spark, n, seed, codes=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        ps = rng.randrange(1, 9)
        rows.append((i, rng.randrange(codes), rng.randrange(1, 4), ps, ps + rng.randrange(3), sorted(rng.sample(range(1, 9), rng.randrange(0, 5))), rng.randrange(3), rng.choice(["A", "B", ""])))
    return rows, spark.createDataFrame(rows, SLOTS)


def clash(a, b):
    return a[2] == b[2] and a[3] <= b[4] and b[3] <= a[4] and bool(set(a[5]) & set(b[5]))


def test_conflicts_of_sections_with_several_slots_and_any_weeks(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(25), 0, rng.randrange(1, 3), ps := rng.randrange(1, 9), ps + rng.randrange(3), rng.choice([None, [], *[rng.sample([-1, 0, 1, 62, 63, 64, 125], rng.randrange(1, 4)) for _ in range(9)]]), 0, "") for _ in range(40)]
    df = spark.createDataFrame(rows, SLOTS)
    want = {(a[0], b[0]) for a, b in itertools.product(rows, rows) if a[0] < b[0] and a[5] and b[5] and clash(a, b)}
    for left, right in ((df, df), (df, df.where("true"))):
        got = [tuple(r) for r in intervals.conflict_pairs(left, right).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_slots_at_any_week(spark):
    slots = spark.createDataFrame([(1, 0, 1, 2, 3, [0, 5, 62], 9, ""), (2, 0, 1, 3, 3, [-1, 63, 5], 9, ""), (3, 0, 1, 3, 4, None, 9, ""), (4, 0, 2, 3, 3, [5], 9, ""), (5, 0, 1, 3, 3, [5], 8, "")], SLOTS)
    asked = spark.createDataFrame([(w, 9, 1, w, 3) for w in (-1, 0, 5, 62, 63, 68)], "id int, room int, day int, week int, period int")
    got = {(r.id, r.section) for r in intervals.slots_at(asked, slots, ("room", "day")).collect()}
    assert got == {(-1, 2), (0, 1), (5, 1), (5, 2), (62, 1), (63, 2)}


def test_conflicts_against_pairs(spark):
    rows, df = random_slots(spark, 60, 1)
    got = {tuple(r) for r in intervals.conflict_pairs(df, df).collect()}
    assert got == {(a[0], b[0]) for a, b in itertools.combinations(rows, 2) if clash(a, b)}


def test_free_and_busy_rooms_are_all_rooms(spark):
    _, df = random_slots(spark, 80, 2)
    rooms = df.select("room").distinct()
    free = {r.room for r in intervals.free_rooms(rooms, df, 3, 2, 2, 5).collect()}
    busy = {r.room for r in intervals.occupied(df, 3, 2, 2, 5).collect()}
    assert free | busy == {r.room for r in rooms.collect()} and not free & busy


def test_bucketed_overlap_has_each_pair_once(spark):
    rng = random.Random(3)
    make = lambda n: [(i, a, a + rng.randrange(30)) for i in range(n) for a in [rng.randrange(-50, 200)]]
    a, b = make(60), make(60)
    schema = "id long, lo long, hi long"
    got = [(r.id, r.id_b) for r in intervals.bucketed_overlap(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), "lo", "hi", 7).collect()]
    assert sorted(got) == sorted((x[0], y[0]) for x in a for y in b if x[1] <= y[2] and y[1] <= x[2])


def test_half_open_slots(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    booked = spark.createDataFrame([("r", t(8), t(10))], "room string, begin timestamp, end timestamp")
    asked = spark.createDataFrame([(1, "r", t(10), t(11)), (2, "r", t(9), t(10)), (3, "q", t(9), t(10)), (4, "r", t(5), t(6)), (5, "r", t(12), t(12))], "id int, room string, begin timestamp, end timestamp")
    got = {r.id: r.status for r in intervals.slot_status(asked, booked, [(360, 1320)]).collect()}
    assert got == {1: "available", 2: "occupied", 3: "available", 4: "unavailable", 5: "unavailable"}


def test_slots_end_when_rooms_close(spark):
    t = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    asked = spark.createDataFrame([(1, "r", t(21), t(22), True), (2, "r", t(21), t(22, 1), True), (3, "r", t(11), t(13), True), (4, "r", t(9), t(10), False), (5, "r", t(9), None, True), (6, "r", t(9), t(10), None)], "id int, room string, begin timestamp, end timestamp, whole boolean")
    none = spark.createDataFrame([], "room string, begin timestamp, end timestamp")
    got = {r.id: r.status for r in intervals.slot_status(asked, none, [(360, 720), (750, 1320)], "whole").collect()}
    assert got == {1: "available", 2: "unavailable", 3: "unavailable", 4: "unavailable", 5: "unavailable", 6: "unavailable"}


@pytest.mark.parametrize("width", [600, 7200])
def test_long_bookings_count_once(spark, width):
    rng = random.Random(11)
    t = lambda x: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=x)
    make = lambda n: [(i, f"r{rng.randrange(2)}", a, a + rng.randrange(0, 900)) for i in range(n) for a in [rng.randrange(3000)]]
    asked, booked = make(40), make(60)
    q = spark.createDataFrame([(i, r, t(a), t(b)) for i, r, a, b in asked], "id int, room string, begin timestamp, end timestamp")
    b = spark.createDataFrame([(r, t(a), t(c)) for _, r, a, c in booked], "room string, begin timestamp, end timestamp")
    got = {r.id: r.overlaps for r in intervals.slot_status(q, b, width=width).collect()}
    assert got == {i: sum(r == s and x < e and y > a and x < y for _, s, x, y in booked) for i, r, a, e in asked}


def test_blocks_and_division(spark):
    rows, df = random_slots(spark, 60, 4)
    blocks = spark.createDataFrame([(1, 2, 4)], "day int, ps int, pe int")
    assert {r.section for r in intervals.unblocked(df, blocks).collect()} == {r[0] for r in rows if not (r[2] == 1 and r[3] <= 4 and r[4] >= 2)}
    got = {r.code: r.all_conflict for r in intervals.all_conflict(df, 0).collect()}
    anchor = [r for r in rows if r[1] == 0]
    assert got == {c: all(any(clash(r, a) for a in anchor) for r in rows if r[1] == c) for c in {r[1] for r in rows} - {0}}


def brute_timetables(rows, codes, limit):
    by = {c: [r for r in rows if r[1] == c and r[5]] for c in codes}
    order = sorted(codes, key=lambda c: (len(by[c]), codes.index(c)))
    found = [p for p in itertools.product(*[by[c] for c in order]) if not any(clash(a, b) for a, b in itertools.combinations(p, 2))]
    return [tuple(r[0] for r in p) for p in found[:limit]]


@pytest.mark.parametrize(("limit", "width"), [(5000, 100_000), (7, 100_000), (40, 10)])
def test_combinations_are_those_of_a_search(spark, limit, width):
    rows, df = random_slots(spark, 40, 5)
    got = [tuple(r.sections) for r in solver.combinations(df, [0, 1, 2], limit, width).orderBy("path").collect()]
    assert got == brute_timetables(rows, [0, 1, 2], limit)


def test_top_k_is_a_prefix_and_missing_code_gives_none(spark):
    _, df = random_slots(spark, 30, 6)
    best = [r.sections for r in solver.timetables(df, [0, 1], 6).orderBy("rank").collect()]
    assert [r.sections for r in solver.timetables(df, [0, 1], 5).orderBy("rank").collect()] == best[:5]
    assert solver.timetables(df, [0, 99], 5).count() == 0
    with pytest.raises(ValueError):
        solver.combinations(df, list(range(13)))


def test_score_of_a_known_day(spark):
    rows = [(1, 1, 1, 1, 2, [1, 2], 0, "A"), (2, 2, 1, 5, 6, [1], 0, "B")]
    s = solver.score(spark.createDataFrame([(1, [1, 2])], "solution int, sections array<bigint>"), spark.createDataFrame(rows, SLOTS)).first()
    assert (s.early, s.gap_segments, s.gap_periods, s.weekdays, s.switches) == (1.0, 0.5, 1.0, 1.0, 0.5)
    assert s.total == -(2 + 2.5 + 1 + 4 + 3)


BAG = "source string, key string, canon string, full string"


def test_bag_diff(spark):
    before = [("s", "a", "a1", "a1x"), ("s", "a", "a1", "a1x"), ("s", "b", "b1", "b1"), ("s", "c", "c1", "c1"), ("s", "c", "c2", "c2")]
    after = [("s", "a", "a1", "a1y"), ("s", "b", "b2", "b2"), ("s", "d", "d1", "d1"), ("s", "c", "c2", "c2"), ("s", "c", "c3", "c3")]
    got = {tuple(r) for r in diff.bag_diff(spark.createDataFrame(before, BAG), spark.createDataFrame(after, BAG)).collect()}
    assert got == {("s", "a", "removed", "a1x", None), ("s", "b", "changed", "b1", "b2"), ("s", "d", "added", None, "d1"), ("s", "c", "changed", "c1", "c3")}


def test_diff_with_itself_is_nothing_and_partial_sources_are_left_out(spark):
    rows = spark.createDataFrame([("s", "a", "1", "1"), ("s", "a", "1", "2"), ("p", "z", "1", "1")], BAG)
    assert diff.bag_diff(rows, rows).count() == 0
    status = lambda x: spark.createDataFrame([("s", "ok"), ("p", x)], "source string, status string")
    a, b = diff.comparable(rows, rows.limit(0), status("ok"), status("partial"))
    assert a.where("source = 'p'").count() == 0 and b.count() == 0
    assert [diff.advance(*x) for x in ((False, 0), (True, 0), (True, 2))] == ["created", "kept", "advanced"]


def test_walk_stops_at_cycles(spark):
    nodes = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 4), (1, 3)], "id int, parent int")
    got = {(r.id, r.depth) for r in tree.walk(nodes, spark.createDataFrame([(1,)], "id int")).collect()}
    assert got == {(1, 0), (2, 1), (3, 2)}


def test_walk_visits_a_node_of_two_parents_once(spark):
    nodes = spark.createDataFrame([(1, None), (2, 1), (3, 1), (4, 2), (4, 3), (5, 4), (6, 5), (3, 6)], "id int, parent int")
    rows = tree.walk(nodes, spark.createDataFrame([(1,)], "id int"))
    assert sorted((r.id, r.depth, r.path) for r in rows.collect()) == [(1, 0, [1]), (2, 1, [1, 2]), (3, 1, [1, 3]), (4, 2, [1, 2, 4]), (5, 3, [1, 2, 4, 5]), (6, 4, [1, 2, 4, 5, 6])]
    first = tree.first_items(rows, 4).orderBy("order").collect()
    assert [r.id for r in first] == [1, 2, 4, 5] and all(r.truncated for r in first)
    assert not tree.first_items(rows, 7).first().truncated
    with pytest.raises(ValueError):
        tree.first_items(rows, 0)


def test_walk_follows_positions(spark):
    nodes = spark.createDataFrame([("r", None, 0), ("b", "r", 0), ("a", "r", 1), ("c", "b", 0)], "id string, parent string, pos int")
    rows = tree.walk(nodes, spark.createDataFrame([("r",)], "id string"), "pos")
    assert [r.id for r in rows.orderBy("order").collect()] == ["r", "b", "c", "a"]


def test_keep_one_and_merge(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 5, "z"), (None, 1, "n")], "k int, pos int, v string")
    assert {(r.k, r.v) for r in keys.keep_one(df, ["k"], [F.col("pos")]).collect()} == {(1, "a"), (2, "z"), (None, "n")}
    a = spark.createDataFrame([("x", ["p", "q"], 2), ("y", [], 3)], "id string, tags array<string>, pos int")
    b = spark.createDataFrame([("x", ["q", "r"], 1)], "id string, tags array<string>, pos int")
    assert {r.id: r.tags for r in keys.merge_union([a, b], "id", "tags", "pos").collect()} == {"x": ["q", "r", "p"], "y": []}


def test_code_else_name_ignores_ambiguous_names(spark):
    left = spark.createDataFrame([(1, " c 1", "x"), (2, "", "So Le"), (3, None, "twice"), (4, "C9", "sole"), (5, "C8", "bare"), (6, "C8", "listed")], "n int, code string, name string")
    right = spark.createDataFrame([("C1", "sole", 1), ("C2", "twice", 2), ("C3", "twice", 3), ("", "bare", 4), (None, "listed", 5)], "code string, name string, id int")
    listed = spark.createDataFrame([("Listed",)], "name string")
    got = {(r.n, r.matched_key, r.matched_by) for r in keys.code_else_name(left, right, "code", "name", "id", listed).collect()}
    assert got == {(1, 1, "code"), (2, 1, "name"), (5, 4, "name")}


def test_versions_names_and_statuses(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(keys.version_parts(F.lit("v1.20-rc1"))) == [1, 20, 0] and one(keys.version_parts(F.lit("10.2.3"))) == [10, 2, 3]
    assert one(keys.version_parts(F.lit("1.9.0")) < keys.version_parts(F.lit("1.10")))
    names = spark.createDataFrame([("中山",), ("北京",), ("阿里",)], "n string")
    assert [r.n for r in names.orderBy(keys.by_locale("n")).collect()] == ["阿里", "北京", "中山"]
    assert one(keys.in_status(F.lit("4"), "pending", {"pending": ["0", "4"]})) and one(keys.in_status(F.lit("x"), "all", {}))
    with pytest.raises(ValueError):
        keys.in_status(F.lit("4"), "other", {})


def test_pages(spark):
    df = spark.range(25)
    page = keys.paged(df, [F.col("id")], 3, 10).collect()
    assert [r.id for r in page] == list(range(20, 25)) and page[0].total == 25 and not page[0].has_more
    assert keys.paged(df, [F.col("id")], 1, 10).first().has_more
    for bad in (0, 201):
        with pytest.raises(ValueError):
            keys.paged(df, [F.col("id")], 1, bad)
    with pytest.raises(ValueError):
        keys.sort_by(df, "other", {"id": ["id"]})


def test_next_after(spark):
    left = spark.createDataFrame([(1, 5), (1, 10), (2, 1)], "k int, t int")
    right = spark.createDataFrame([(1, 5, "a"), (1, 7, "b")], "k int, t int, v string")
    got = {(r.k, r.t): r.next_v for r in asof.next_after(left, right, ["k"], "t", ["v"]).collect()}
    assert got == {(1, 5): "b", (1, 10): None, (2, 1): None}
    assert {(r.k, r.t): r.next_v for r in asof.next_after(left, right, ["k"], "t", ["v"], strict=False).collect()}[1, 5] == "a"
    tied = right.unionByName(spark.createDataFrame([(1, 7, "aa"), (1, 7, "z")], right.schema)).repartition(3)
    assert {r.next_v for r in asof.next_after(left.where("t = 5 and k = 1"), tied, ["k"], "t", ["v"]).collect()} == {"aa"}


def test_next_or_overdue(spark):
    now = F.lit("2024-01-02").cast("timestamp")
    df = spark.createDataFrame([(1, None), (2, dt.datetime(2024, 1, 1)), (3, dt.datetime(2024, 1, 3))], "id int, due timestamp")
    ids = [asof.next_or_overdue(df.where(c), "due", now, "id").first().id for c in ("true", "id < 3", "id = 1")]
    assert ids == [3, 2, 1]


GRADES = "grade_id long, student long, code string, name string, department string, nature string, letter string, score double, points double, credits double, semester string"


def grade_rows(spark, *rows):
    base = {"student": 1, "code": "", "name": "", "department": "", "nature": "", "letter": "", "score": None, "points": None, "credits": 2.0, "semester": "2024-1"}
    return spark.createDataFrame([tuple(({"grade_id": i} | base | r)[c.split()[0]] for c in GRADES.split(", ")) for i, r in enumerate(rows, 1)], GRADES)


def rule_rows(spark, *rules):
    names = [c.split()[0] for c in audit.RULES.split(", ")]
    return spark.createDataFrame([tuple(({"id": f"r{i}"} | r).get(c) for c in names) for i, r in enumerate(rules)], audit.RULES)


def test_audit_leaves_ambiguous_courses_out(spark):
    grades = grade_rows(spark, {"code": "C1", "score": 80.0, "credits": 3.0}, {"code": "C1", "score": 50.0}, {"code": "c2 ", "score": 90.0}, {"code": "C3", "score": 59.0})
    rules = rule_rows(spark, {"id": "a", "min_credits": 3.0, "min_courses": 1, "codes": ["C1", "C2"]}, {"id": "b", "min_credits": 1.0, "codes": ["C2"], "natures": []}, {"id": "c", "min_courses": 1, "codes": ["C3"]})
    got = {r.id: (r.matched_credits, r.satisfied, r.matched, r.ambiguous, r.excluded) for r in audit.audit(grades, rules).collect()}
    assert got == {"a": (3.0, True, [1], [3], [2]), "b": (0.0, False, [], [3], []), "c": (0.0, False, [], [], [4])}


def test_a_rule_holds_all_of_its_clauses(spark):
    grades = grade_rows(spark, {"code": "MA1", "letter": "a+", "department": "D", "nature": "N", "name": "Linear Algebra", "score": 90.0}, {"code": "MA2", "letter": "C", "department": "D", "nature": "N", "name": "Linear Maps", "score": 90.0})
    one = lambda **c: {r.grade_id for r in audit.evaluated(grades, rule_rows(spark, c)).where(F.size("ids") > 0).collect()}
    assert one(letters=["A+"]) == {1} and one(prefixes=["ma"]) == {1, 2} and one(names=["ALGEBRA", "none"]) == {1} and one(departments=["E"]) == set()
    assert one(prefixes=["MA"], letters=["c"], min_score=90.0) == {2} and one(prefixes=["MA"], min_score=90.5) == set() and one(natures=["N"], codes=["ma2"]) == {2} and one() == {1, 2}


def test_grades_without_a_score_count_by_letter(spark):
    grades = grade_rows(spark, {"code": "A", "letter": "P"}, {"code": "B", "letter": "??"}, {"code": "C", "letter": "W"}, {"code": "D", "letter": "A", "points": 4.0}, {"code": "D", "letter": "B", "points": 3.0}, {"code": "D", "letter": "", "score": 61.0, "points": 1.0}, {"name": "no code", "letter": "P"}, {"name": "no code", "letter": "P", "semester": "2024-2"})
    got = {r.grade_id: r.role for r in audit.evaluated(grades, rule_rows(spark, {"prefixes": ["Z"]})).collect()}
    assert got == {1: "counted", 2: "unresolved", 3: "excluded", 4: "retake", 5: "retake", 6: "counted", 7: "counted", 8: "counted"}
    r = audit.audit_summary(grades, rule_rows(spark, {"prefixes": ["A"]})).first()
    assert (r.counted, r.unresolved, r.excluded, r.retakes, r.duplicate_courses, r.unmatched) == (4, 1, 1, 2, 1, 3)


def test_required_courses_and_states(spark):
    plan = [(1, "C1", "One", "g", "x", None, True), (2, "c 1", None, "h", "x", 3.0, True), (3, "", "Two", None, None, 1.0, True), (4, "C4", "Same", None, None, 1.0, True), (5, "C5", "same", None, None, 1.0, True), (6, " ", None, None, None, 1.0, True), (7, "C7", "no", None, None, 1.0, False)]
    courses, unclear = degree.required_courses(spark.createDataFrame(plan, "pos int, code string, name string, grouping string, category string, credits double, required boolean"))
    assert {r.key: (r.credits, r.groups) for r in courses.collect()} == {"code:C1": (3.0, ["g", "h"]), "name:two": (1.0, []), "code:C4": (1.0, []), "code:C5": (1.0, [])}
    assert [r.pos for r in unclear.collect()] == [6]
    grades = spark.createDataFrame([(1, "C1", "x", "failed", "1", 50.0), (1, "C1", "x", "passed", "2", 70.0), (2, "", "two", "unknown", "1", None), (3, "", "Same", "passed", "1", 90.0), (4, "C4", "z", "failed", "2", 10.0), (4, "C4", "z", "non-completed", "1", None)], "student int, code string, name string, completion string, semester string, score double")
    enrolled = spark.createDataFrame([(2, "", "One"), (4, "c5", "q")], "student int, code string, name string")
    states = degree.course_states(grades.select("student").distinct(), courses, grades, enrolled)
    got = {(r.student, r.key): (r.state, r.matched_by) for r in states.collect()}
    assert got[1, "code:C1"] == ("passed", None) and got[2, "name:two"] == ("unclear", None) and got[2, "code:C1"] == ("in_progress", "name")
    assert got[3, "code:C4"] == got[3, "code:C5"] == ("ambiguous", None) and got[4, "code:C4"] == ("failed", None) and got[4, "code:C5"] == ("in_progress", "code") and got[1, "name:two"] == ("missing", None)


def test_solver_keeps_blocked_times_free(spark):
    rows, df = random_slots(spark, 40, 5)
    blocks = spark.createDataFrame([(1, 1, 4), (2, 6, 9)], "day int, ps int, pe int")
    free = [r for r in rows if not ((r[2] == 1 and r[3] <= 4) or (r[2] == 2 and r[4] >= 6))]
    got = [tuple(r.sections) for r in solver.combinations(df, [0, 1, 2, 0], blocks=blocks).orderBy("path").collect()]
    assert got == brute_timetables(free, [0, 1, 2], 5000)
    report = {r.code: (r.candidates, r.unscheduled, r.missing) for r in solver.code_report(df, [0, 9, 0], blocks).collect()}
    assert report == {0: (sum(r[1] == 0 and bool(r[5]) for r in free), sum(r[1] == 0 and not r[5] for r in rows), False), 9: (0, 0, True)}
    credits = spark.createDataFrame([(r[0], 0.5 * (r[0] % 3)) for r in rows], "section long, credits double")
    for r in solver.timetables(df, [0, 1], 5, credits=credits).collect():
        assert r.credits == sum(0.5 * (s % 3) for s in r.sections)


def test_baselines_move_by_source(spark):
    row = lambda s, v: (s, "k", v, v)
    before, after = spark.createDataFrame([row("a", "1"), row("p", "1")], BAG), spark.createDataFrame([row("a", "2"), row("p", "2")], BAG)
    status = lambda **x: spark.createDataFrame(list(x.items()), "source string, status string")
    left = lambda old, new: sorted((r.source, r.full) for r in diff.next_baseline(before, after, old, new).collect())
    assert left(status(a="ok", p="ok"), status(a="ok", p="partial")) == [("a", "2"), ("p", "1")]
    assert left(status(a="error", p="ok"), status(a="ok", p="error")) == [("a", "1"), ("p", "1")]


def test_page_scans_end(spark):
    body = lambda n, first=0: "[" + ",".join(f'{{"id":{first + i}}}' for i in range(n)) + "]"
    pages = [("short", 1, body(3), None), ("short", 2, body(2), None), ("short", 3, body(3), None), ("total", 1, body(3), 5), ("total", 2, body(3), 5), ("total", 3, body(3), 5), ("bad", 1, body(3), None), ("bad", 2, "{", None), ("bad", 3, body(1), None), ("long", 1, body(3), None), ("long", 2, body(3), None), ("long", 3, body(3), None), ("long", 4, body(3), None), ("none", 1, "[]", None)]
    df = spark.createDataFrame(pages, "feed string, page int, body string, total long")
    got = {r.feed: (r.pages, r["items"], r.status) for r in feeds.feed_status(feeds.read_pages(df, "struct<id:int>", 3, 3)).collect()}
    assert got == {"short": (2, 5, "complete"), "total": (2, 6, "complete"), "bad": (2, 3, "failed"), "long": (3, 9, "over"), "none": (1, 0, "complete")}
    some = feeds.feed_status(feeds.read_pages(df, "struct<id:int>", 3, 9, limit=4).where("feed = 'long'")).first()
    assert (some.pages, some["items"], some.status) == (2, 4, "complete")


def test_lookups(spark):
    names = spark.createDataFrame([("1", "Hall 1"), ("11", "Hall 11"), ("x", "Gate")], "code string, label string")
    asked = spark.createDataFrame([("hall 1",), (" 11 ",), ("all",), ("gat",), ("no",)], "query string")
    assert {r.query: (r.code, r.status) for r in lookup.resolve(asked, names).collect()} == {"hall 1": ("1", "found"), " 11 ": ("11", "found"), "all": (None, "ambiguous"), "gat": ("x", "found"), "no": (None, "missing")}
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(lookup.bases_of(F.lit("CS101A1B"))) == ["C", "CS101", "CS101A1"] and one(lookup.bases_of(F.lit("CS101"))) == ["C"]
    cand = spark.createDataFrame([(1, "CS101A", "n", ["Li Ming"], ["t"], 1, 9.0, "u"), (2, "cs-101", "n", [], [], 5, None, "u"), (3, "CS1012", "other", ["Li"], [], 0, None, "u")], "id int, code string, name string, teachers array<string>, terms array<string>, reviews int, rating double, url string")
    looks = spark.createDataFrame([(1, "CS101", "", ["Li"], "t"), (2, "CS101", "", [], "z"), (3, "", "OTHER", [], ""), (4, "X1", "none", [], "")], "q int, code string, name string, teachers array<string>, term string")
    got = {r.q: (r.picked, r.matches, r.confidence, r.status) for r in lookup.match_courses(looks, cand).collect()}
    assert got == {1: (1, 2, "medium", "matched"), 2: (2, 2, "medium", "matched"), 3: (3, 1, "low", "matched"), 4: (None, 0, "none", "not_found")}


def test_lookups_that_ask_the_same(spark):
    cand = spark.createDataFrame([(1, "CS1A", "n", ["x"], ["t"], 1, 9.0, "u"), (1, "CS1", "n", ["x"], ["t"], 1, 9.0, "u"), (2, "CS1", "m", None, None, None, float("nan"), "v"), (3, "CS1", "m", None, None, None, 5.0, "w")], "id int, code string, name string, teachers array<string>, terms array<string>, reviews int, rating double, url string")
    looks = spark.createDataFrame([*[(q, "CS1", "n", [], None) for q in range(20)], *[(q, "CS1", "", ["x"], "t") for q in range(20, 40)], (50, "CS1", "", [], None), (50, "", "n", [], None), (None, "CS1", "", [], None)], "q int, code string, name string, teachers array<string>, term string")
    got = [(r.q, r.picked, r.matches, r.confidence, r.status) for r in lookup.match_courses(looks, cand).collect()]
    assert sorted(x for x in got if x[0] is not None and x[0] < 40) == [(q, 1, 3, "medium" if q < 20 else "high", "matched") for q in range(40)]
    assert [x for x in got if x[0] is None] == [(None, None, 0, "none", "not_found")] and {x[2] for x in got if x[0] == 50} == {3}
    none = spark.createDataFrame([(7, "CS1", "", [], None)], looks.schema)
    assert [(r.picked, r.matches) for r in lookup.match_courses(none, cand.where("id > 1")).collect()] == [(2, 2)]  # NaN is the largest rating


def test_booking_rules(spark):
    now = F.lit("2024-01-10 12:00:00").cast("timestamp")
    t = lambda d, h, m=0: dt.datetime(2024, 1, d, h, m)
    schema = "id int, title string, participants int, begin timestamp, end timestamp, found boolean, available boolean, capacity int, days_ahead int, opens int, closes int, approval boolean, slot string"
    rows = [(1, "x", 2, t(11, 9), t(11, 10), True, True, 2, 3, 480, 600, True, "available"), (2, " ", 0, t(9, 9), t(9, 8), True, False, 2, 0, 480, 1320, False, "occupied"), (3, "x", 3, t(15, 8), t(15, 17), True, True, 2, 3, 480, 960, False, "available"), (4, "x", 1, t(11, 9), None, False, None, None, None, None, None, None, None)]
    got = {r.id: (r.blockers, r.allowed) for r in booking.meeting_findings(spark.createDataFrame(rows, schema), now).collect()}
    assert got == {1: ([], True), 2: (["TITLE_REQUIRED", "PARTICIPANTS_INVALID", "START_IN_PAST", "TIME_ORDER_INVALID", "ROOM_UNAVAILABLE", "SLOT_OCCUPIED"], False), 3: (["DURATION_EXCEEDS_LIMIT", "PARTICIPANTS_EXCEED_CAPACITY", "ADVANCE_WINDOW_EXCEEDED", "OUTSIDE_BOOKABLE_WINDOW"], False), 4: (["ROOM_NOT_FOUND", "TIME_INVALID"], False)}
    members = lambda *x: spark.range(1).select(booking.member_list(F.array(*[F.lit(v) for v in x]).cast("array<bigint>"), F.lit(5).cast("long")).alias("m")).first().m
    assert tuple(members()) == ([5], None) and tuple(members(5, 5)) == ([5], "not_unique") and tuple(members(5, 0)) == ([5], "not_positive")


def test_now_and_next(spark):
    t = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    occ = spark.createDataFrame([(1, "a", t(8), t(9)), (1, "b", t(10), t(11))], "k int, uid string, begin timestamp, end timestamp")
    ask = spark.createDataFrame([(1, t(7)), (1, t(8)), (1, t(9)), (1, t(11)), (2, t(8))], "k int, at timestamp")
    got = {(r.k, r["at"].hour): (r.on_now, r.next) for r in agenda.now_and_next(occ, ask, "k").collect()}
    assert got == {(1, 7): (None, "a"), (1, 8): ("a", None), (1, 9): (None, "b"), (1, 11): (None, None), (2, 8): (None, None)}


def test_now_and_next_against_brute_force(spark):
    rng, t0 = random.Random(5), dt.datetime(2024, 1, 1)
    at = lambda: t0 + dt.timedelta(hours=rng.randrange(30))
    occ = [(rng.randrange(3), f"u{rng.randrange(9)}", b := at(), b + dt.timedelta(hours=rng.randrange(4))) for _ in range(60)]
    asked = sorted({(rng.randrange(4), at()) for _ in range(60)})
    df = agenda.now_and_next(spark.createDataFrame([*occ, (1, "z", None, t0)], "k int, uid string, begin timestamp, end timestamp"), spark.createDataFrame(asked, "k int, at timestamp"), "k")
    want = []
    for k, a in asked:
        own = [(b, e, u) for k_, u, b, e in occ if k_ == k]
        last, after = max((o for o in own if o[0] <= a), default=None), min((o for o in own if o[0] > a), default=None)
        on = last[2] if last and a < last[1] else None
        want.append((k, a, on, None if on or not after else after[2]))
    assert sorted(map(tuple, df.collect()), key=lambda r: r[:2]) == want
    assert "unboundedfollowing" not in df._jdf.queryExecution().toString().lower()  # such a frame is computed anew for each row


def test_weighted_mean(spark):
    df = spark.createDataFrame([(4.0, 2), (3.0, 1), (None, 5), (1.0, 0)], "p double, c int")
    r = df.agg(*audit.weighted_mean(F.col("p"), F.col("c"))).first()
    assert (r.gpa, r.credits, r.course_count) == (3.667, 3, 2)
    r = df.limit(0).agg(*audit.weighted_mean(F.col("p"), F.col("c"))).first()
    assert r.gpa == 0


def test_relevance(spark):
    df = spark.createDataFrame([("red apple pie", "x"), ("apple red", ""), ("apple", "red"), ("pear", None)], "a string, b string")
    score = rank.relevance("Red  Apple", [(F.coalesce("a", F.lit("")), 2), (F.coalesce("b", F.lit("")), 1)])
    got = [r.s for r in df.select(score.alias("s")).collect()]
    assert got == [2000 + 2 * 1000 + 2 * 150 + 2 * 146, 2 * 144 + 2 * 150, 2 * 150 + 150, 0]
    assert df.select(rank.relevance("", [(F.col("a"), 1)]).alias("s")).first().s == 0


def test_small_scores(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(rank.alias_distance(F.array(F.lit("Main Gate"), F.lit("gate")), "gate")) == -100 and one(rank.alias_distance(F.array(F.lit("x")), "gate")) is None
    assert [one(rank.verdict(F.lit(t), F.lit(False), F.lit(True))) for t in (-1, 17, 18, 34)] == ["avoid", "consider", "recommend", "strong"]
    assert one(rank.evidence_weight(F.lit("high"), F.lit(0))) == 0 and one(rank.evidence_weight(F.lit("low"), F.lit(40))) == 0.45
    assert [one(rank.capacity_score(F.lit(10), F.lit(e))) for e in (10, 8, 7, 3)] == [-18, -6, 4, 4]
    assert one(rank.review_score(F.lit(8.0), F.lit(75.0), F.lit(1.0))) == 5.0


def test_planning_view_refuses_nested_scores(spark):
    df = spark.range(1).select("id", F.lit(1).alias("Score"), F.struct(F.lit(2).alias("points")).alias("x"))
    with pytest.raises(ValueError):
        normalize.planning_view(df)
    assert normalize.planning_view(df.drop("x")).columns == ["id"]


def test_attempt_states(spark):
    one = lambda *x: spark.range(1).select(audit.attempt_state(*[F.lit(v) for v in x]).alias("s")).first().s
    cases = {(0, 0, 0, 0, None): "not_attempted", (2, 0, 2, 0, "completed"): "completed", (2, 1, 1, 0, "completed"): "mixed", (2, 0, 0, 2, "submitted"): "submitted", (2, 2, 0, 0, "open"): "in_progress", (2, 1, 0, 1, "open"): "mixed", (2, 0, 1, 0, "other"): "completed", (1, 0, 0, 0, "other"): "other"}
    assert {x: one(*x) for x in cases} == cases


def test_lookup_confidence_and_reconciliation(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    sure = lambda *x: one(rank.lookup_confidence(*[F.lit(v) for v in x]))
    assert [sure(False, False, False, 1, True, 1), sure(True, False, False, 0, False, 1), sure(True, False, False, 0, False, 3), sure(True, False, False, 0, False, 4), sure(False, True, False, 1, False, 9)] == ["none", "high", "medium", "low", "medium"]
    seen = lambda *x: one(rank.reconciled(*[F.lit(v) for v in x]))
    assert [seen(1, "desired", 2, 0), seen(0, "desired", 1, 1), seen(0, "inverse", 0, 2), seen(0, "inverse", 1, 2)] == ["still_uncertain", "applied", "not_applied", "still_uncertain"]


def test_walk_of_a_long_chain(spark):
    nodes = spark.range(1, 24).select("id", (F.col("id") - 1).alias("parent"))
    assert sorted(r.depth for r in tree.walk(nodes, spark.range(1)).collect()) == list(range(24))
