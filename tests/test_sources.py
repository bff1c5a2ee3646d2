"""Readers, writers and streams on small files."""

import json

import pytest
from pyspark.sql import functions as F

from plumbline.sources import documents, html, markdown, sinks
from plumbline.streaming import watch


def test_json_documents(spark, tmp_path):
    (tmp_path / "plan.json").write_text(json.dumps({"schemaVersion": 1, "kind": "plan", "codes": ["a"]}))
    schema = "schemaVersion int, kind string, codes array<string>"
    assert documents.read_json(spark, str(tmp_path), schema, "plan").first().codes == ["a"]
    with pytest.raises(Exception, match="not a snapshot"):
        documents.read_json(spark, str(tmp_path), schema, "snapshot").collect()
    (tmp_path / "bad.json").write_text("{")
    with pytest.raises(Exception):
        documents.read_json(spark, str(tmp_path), schema).collect()


def test_changed_snapshots_are_refused(spark):
    df = spark.createDataFrame([("{}", "no")], "body string, digest string")
    with pytest.raises(Exception, match="changed"):
        documents.verified(df, F.col("body"), F.col("digest")).collect()


def test_cursor_pages():
    pages = {"a": ([1, 2], "b"), "b": ([3], None), "x": ([1], "x")}
    assert list(documents.cursor_pages("a", pages.get)) == [1, 2, 3]
    with pytest.raises(sinks.QueryError, match="repeats"):
        list(documents.cursor_pages("x", pages.get))


def test_unwrap(spark):
    bodies = ['[{"id":1}]', '{"content":[{"id":2}]}', '{"other":1}', "broken"]
    got = [r.x for r in spark.createDataFrame([(b,) for b in bodies], "b string").select(documents.unwrap(F.col("b"), "struct<id:int>").alias("x")).collect()]
    assert [[e.id for e in x] if x else x for x in got] == [[1], [2], None, None]


def test_sections(spark):
    md = "intro\n## A\n### B\ntext\n#### C\n## D\n### E\nend"
    got = [tuple(r) for r in markdown.sections(spark.createDataFrame([(1, md)], "k int, md string"), ["k"], "md").select("n", "level", "title", "path", "until").orderBy("n").collect()]
    assert got == [(2, 2, "A", "A", 5), (3, 3, "B", "A > B", 5), (5, 4, "C", "A > B > C", 5), (6, 2, "D", "D", 8), (7, 3, "E", "D > E", 8)]


def test_tables_logs_and_cards(spark):
    md = "| a | b |\n|---|:-:|\n| 1 | 2 |\n| 3 |\nno"
    assert [tuple(r) for r in markdown.table(spark.createDataFrame([(md,)], "m string"), "m", ["a", "b"]).collect()] == [("1", "2")]
    log = spark.createDataFrame([("2024-01-01 10:00:00.1 wifi: joined net",), ("junk",)], "line string")
    assert [(r.source, r.kind) for r in markdown.log_lines(log, "line", {"join": "joined"}).collect()] == [("wifi", "join")]
    page = '<div class="card" data-id="1"><b class="title">A &amp; B</b><i class="time">2024-01-01 10:00:00</i></div><div class="card" data-id="1"><b class="title">again</b></div>'
    rows = html.cards(spark.createDataFrame([(page,), (None,)], "h string"), "h").collect()
    assert [(r.id, r.title) for r in rows] == [("1", "A & B")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "t1"), (2, "t2")], "id int, term string")
    lines = [r.line for r in sinks.json_lines(df, "x").orderBy("place", "line").collect()]
    assert json.loads(lines[-1]) == {"summary": "x", "items": 2} and json.loads(lines[0]) == {"id": 1, "term": "t1"}
    sinks.write_new(df, f"{tmp_path}/a")
    with pytest.raises(Exception):
        sinks.write_new(df, f"{tmp_path}/a")
    sinks.write_new(df, f"{tmp_path}/a", overwrite=True)
    sinks.write_by_term(df, f"{tmp_path}/b")
    sinks.write_by_term(df.where("id = 1").withColumn("id", F.lit(9)), f"{tmp_path}/b")
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/b").collect()) == [2, 9]
    assert sinks.QueryError("x", "USAGE").status == 2
    sinks.save_json(df, f"{tmp_path}/c")
    with pytest.raises(sinks.QueryError, match="exists"):
        sinks.save_json(df, f"{tmp_path}/c")
    sinks.save_json(df.limit(1), f"{tmp_path}/c", overwrite=True)
    assert spark.read.json(f"{tmp_path}/c").count() == 1


def test_staging_folder_of_a_cluster_must_be_named(spark, monkeypatch):
    from plumbline.functions import staging

    class Other:
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("S", (), {"master": "yarn"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_dir(Other)


def test_watch_appends_changes(spark, tmp_path):
    schema = "source string, key string, canon string, full string"
    rows = lambda *x: spark.createDataFrame([("s", k, c, c) for k, c in x], schema)
    rows(("a", "1"), ("b", "1")).write.mode("append").parquet(f"{tmp_path}/in")
    sink = watch.diff_sink(f"{tmp_path}/base", f"{tmp_path}/out")
    watch.once(watch.events(spark, f"{tmp_path}/in", schema), sink, f"{tmp_path}/cp").awaitTermination(60)
    rows(("a", "2"), ("b", "1")).write.mode("append").parquet(f"{tmp_path}/in")
    watch.once(watch.events(spark, f"{tmp_path}/in", schema), sink, f"{tmp_path}/cp").awaitTermination(60)
    got = {(r.batch, r.key, r.change_type) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {(0, "a", "added"), (0, "b", "added"), (1, "a", "changed")}


def test_a_watch_keeps_the_baseline_of_sources_read_in_part(spark, tmp_path):
    schema = "source string, key string, canon string, full string"
    rows = lambda *x: spark.createDataFrame([(s, k, c, c) for s, k, c in x], schema)
    sink = watch.diff_sink(f"{tmp_path}/base", f"{tmp_path}/out", lambda batch: spark.createDataFrame([("s", "ok"), ("p", "partial")], "source string, status string"))
    sink(rows(("s", "a", "1"), ("p", "b", "1"), ("p", "c", "1")), 0)
    sink(rows(("s", "a", "2"), ("p", "b", "2")), 1)
    assert [(r.source, r.key) for r in spark.read.parquet(f"{tmp_path}/out/batch=1").collect()] == [("s", "a")]
    assert sorted((r.source, r.key, r.full) for r in spark.read.parquet(f"{tmp_path}/base/2").collect()) == [("p", "b", "1"), ("p", "c", "1"), ("s", "a", "2")]


def test_hourly_as_a_stream_is_the_table(spark, tmp_path):
    import datetime as dt

    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, h, 5 * h), "x") for h in (1, 1, 2, 9)], "ts timestamp, event_type string")
    df.write.parquet(f"{tmp_path}/ev")
    q = watch.hourly(watch.events(spark, f"{tmp_path}/ev", "ts timestamp, event_type string")).writeStream.outputMode("complete").format("memory").queryName("hourly_test").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(map(str, spark.table("hourly_test").collect())) == sorted(map(str, watch.hourly(df).collect()))
