"""The pipeline's stages on a small corpus with planted cases."""

import random

import pytest

pytest.importorskip("plumbline.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from pyspark.sql import functions as F  # noqa: E402


def prose(rng, n):
    return "\n".join(" ".join(f"word{rng.randrange(5000)}" for _ in range(12)) + "." for _ in range(n))


def test_stages(spark, tmp_path):
    rng = random.Random(9)
    texts = [prose(rng, 10) for _ in range(60)]
    texts += [texts[0], texts[1].replace("word1", "word2", 1), "short", None, "a b c " * 200, texts[2]]
    rows = [(i, t, "en", rng.choice(["a", "b", None]), len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.unionByName(docs.where("doc_id = 5")).withColumn("size", F.lit(1))
    names = docs.columns
    kept = corpus_pipeline.quality(spark, docs, str(tmp_path))
    assert kept.columns == names and {r.doc_id for r in kept.collect()} == set(range(62)) | {65}
    one = corpus_pipeline.near_duplicates(spark, kept, str(tmp_path))
    assert one.columns == names and sorted(r.doc_id for r in one.collect()) == list(range(60))
    mixed = corpus_pipeline.mix(spark, one, str(tmp_path))
    assert mixed.columns == names and 60 <= mixed.count() <= 120
    packed = corpus_pipeline.pack(spark, mixed, str(tmp_path))
    assert packed.agg(F.sum("length")).first()[0] == packed.where("start = 0").agg(F.sum("doc_tokens")).first()[0]
    for stage in (corpus_pipeline.quality, corpus_pipeline.near_duplicates, corpus_pipeline.mix, corpus_pipeline.pack):
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_near_duplicates_by_row(spark, tmp_path):
    rng = random.Random(4)
    a, b, c, d = (prose(rng, 10) for _ in range(4))
    # Null-id copies beside each other and beside an id; one id with two texts, of which one is a copy or neither is.
    rows = [(None, a), (None, a), (None, a + " end"), (None, b), (None, b), (3, b), (3, b), (7, b), (7, c), (8, c), (9, d), (9, a[::-1]), (None, None), (4, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()]
    of_a = [x for x in got if x[1] in (a, a + " end")]
    assert len(of_a) == 1 and of_a[0][0] is None
    assert sorted((x for x in got if x not in of_a), key=repr) == sorted([(3, b), (7, c), (9, d), (9, a[::-1]), (None, None), (4, "")], key=repr)


def test_run_is_registered(spark, tmp_path):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    docs = spark.createDataFrame([(i, prose(random.Random(i), 9), "en", "a", 1) for i in range(20)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 20
