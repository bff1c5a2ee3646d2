"""Media, packing and the word hashes under them."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("plumbline.llm")

from plumbline.llm import media, packing, vec  # noqa: E402
from plumbline.llm.tokens import default_vocabulary  # noqa: E402


def test_word_hashes_match_words():
    rng = random.Random(0)
    texts = ["", None, " a", "a ", "A b\tB\x0b\x0ca", "é É", *("".join(rng.choice(" \n\tabAé") for _ in range(rng.randrange(40))) for _ in range(300)), "x" * 3_000_000 + " y", "ab " * 900_000]
    hashes, offsets = vec.word_hashes(pa.array(texts))
    seen, back = {}, {}
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        own = hashes[offsets[i] : offsets[i + 1]].tolist()
        assert len(own) == len(words)
        for w, h in zip(words, own, strict=True):
            assert seen.setdefault(w, h) == h and back.setdefault(h, w) == w


def test_best_fill_is_the_best():
    rng = random.Random(4)
    for _ in range(200):
        cap = rng.randrange(5, 60)
        counts = {rng.randrange(1, cap): rng.randrange(1, 4) for _ in range(rng.randrange(1, 6))}
        longest = max(counts)
        fill = packing.best_fill(counts, longest, cap)
        assert all(fill[k] <= counts[k] for k in fill) and fill[longest] >= 1
        sums = {longest}
        items = [k for k, n in counts.items() for _ in range(n - (k == longest))]
        for x in items:
            sums |= {s + x for s in sums if s + x <= cap}
        assert sum(k * n for k, n in fill.items()) == max(sums)


@pytest.mark.parametrize("lengths", [[1], [2048], [5000, 1, 1], [1500] * 50, [], *[[random.Random(s).randrange(1, 6000) for _ in range(700)] for s in range(3)]])
def test_pack_covers_each_id_once(lengths):
    rows = packing.pack(np.array(lengths, np.int64), 2048)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc, start, length, sequence, offset in rows.tolist():
        by_doc[doc].append((start, length))
        by_sequence[sequence].append((offset, length))
    for own, total in ((by_doc, dict(enumerate(lengths))), (by_sequence, None)):
        for key, parts in own.items():
            at = 0
            for begin, length in sorted(parts):
                assert begin == at and length > 0
                at += length
            assert at == total[key] if total else at == 2048 or at < 2048 and at & (at - 1) == 0
    assert sum(n for parts in by_doc.values() for _, n in parts) == sum(lengths)


def test_packing_ids(spark):
    from tokenizers import Tokenizer

    rng = random.Random(6)
    texts = [None, "", "Hello", "É é ΑΣ. x\u2003y\x1cz <|endoftext|> don't", *(" ".join(rng.choice(["Foo", "bar", "b,z", "7a"]) for _ in range(rng.randrange(900))) for _ in range(60)), "long tale " * 6000]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, start string").repartition(3)
    tokenizer = Tokenizer.from_file(default_vocabulary())
    want = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    parts = defaultdict(dict)
    for r in packing.with_digest(packing.pack_documents(docs)).collect():
        ids = np.array(want[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(ids.tobytes()) and r.doc_tokens == len(want[r.doc_id])
        parts[r.doc_id][r.start] = r.length
    assert {d: sum(p.values()) for d, p in parts.items()} == {i: len(w) for i, w in enumerate(want)}
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_decode_formats():
    rng = np.random.default_rng(1)
    image = rng.integers(0, 256, (5, 7, 3), dtype=np.uint8)
    assert (media.decode(media.encode_bmp(image)) == image).all()
    assert (media.decode(b"P6 # c\n7\n5 255\n" + image.tobytes()) == image).all()
    assert (media.decode(b"P3\n7 5\n255\n" + b" ".join(b"%d" % x for x in image.ravel())) == image).all()
    assert (media.decode(b"P5\n7 5 255\n" + image[..., 0].tobytes()) == image[..., :1]).all()
    assert media.decode(b"P1\n3 1\n1 0 1").ravel().tolist() == [0, 255, 0]
    assert media.decode(b"P4\n3 1\n\xa0").ravel().tolist() == [0, 255, 0]
    wide = rng.integers(0, 65536, (5, 7, 3)).astype(">u2")
    assert (media.decode(b"P6 7 5 65535\n" + wide.tobytes()) == np.round(wide.astype(float) * 255 / 65535)).all()
    assert media.decode(b"P2 2 1 3\n0 3").ravel().tolist() == [0, 255]
    for bits in (1, 4, 8):
        places = rng.integers(0, 2, (3, 5), dtype=np.uint8)
        stride = (5 * bits + 31) // 32 * 4
        rows = np.zeros((3, stride * 8 // bits), np.uint8)
        rows[:, :5] = places[::-1]
        packed = np.packbits(np.unpackbits(rows[..., None], axis=2)[..., 8 - bits :].reshape(3, -1), axis=1)
        palette = bytes([1, 2, 3, 0, 30, 20, 10, 0])
        head = struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 0, 0, 0, 54 + 8, 40, 5, 3, 1, bits, 0, 0, 0, 0, 2, 0)
        assert (media.decode(head + palette + packed.tobytes()) == np.array([[3, 2, 1], [10, 20, 30]], np.uint8)[places]).all()


HUGE = struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 0, 0, 0, 54, 40, 2**31 - 1, -(2**31), 1, 32, 0, 0, 0, 0, 0, 0)
BAD = [
    b"", b"P6\n9", b"P6\n7 5\n255\nxx", b"BMxxxx", b"GIF89a", b"P5\n1 1\n70000\nxx", b"P2 1 1 255\n300", b"P2 1 1 255\n-1", b"P3 1 1 255\n1 2 x", b"P5 99999999999999999999 1 255\nx", b"P5 999999999 999999999 255\nx",
    b"P5 -1 6 255\nabcdef", b"P5 0 6 255\n", b"P5 1 1 0\nx", b"P5 2 1 7\n\x01\x08", b"P1 2 1\n1", b"P4 9 1\n\xa0", b"P7\nWIDTH 1\n", b"P2 1 1 255\n" + b"9" * 400, HUGE, HUGE[:18] + b"\xff\xff\xff\xff" + HUGE[22:], b"BM" + bytes(60),
]


@pytest.mark.parametrize("bad", BAD)
def test_bad_images_are_value_errors(bad):
    with pytest.raises((ValueError, struct.error)):
        media.decode(bad)
    assert media._one(pa.scalar(bad, pa.binary())) == (None,) * 5


def test_area_resize_is_the_mean_of_areas():
    rng = np.random.default_rng(2)
    gray = rng.integers(0, 256, (6, 10)).astype(float)
    got = media.area_resize(gray, 4, 3)
    fine = np.kron(gray, np.ones((4, 3)))  # 24 x 30: whole parts of both
    want = fine.reshape(4, 6, 3, 10).mean(axis=(1, 3))
    assert np.allclose(got, want)
    assert np.allclose(media.area_resize(np.full((1, 1), 9.0), 8, 9), 9)


def test_media_columns(spark):
    texts = [None, "", "abc", "é" * 96, "x" * 193, "same", "same", "long text " * 9000]
    import pyspark.sql.functions as F

    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("media", media.text_as_ppm(F.col("text"))).withColumn("tile", F.lit(1))
    rows = {r.doc_id: r for r in media.media_columns(docs).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b" " * (-len(raw) % 192 or (192 if not raw else 0))
        assert bytes(rows[i].samples) == payload and rows[i].width == 64 and rows[i].height * 192 == len(payload)
        assert np.load(__import__("io").BytesIO(bytes(rows[i].tile))).shape == (32, 32) and len(rows[i].dhash) == 16
    assert rows[5].dhash == rows[6].dhash and Counter(len(r) for r in rows.values())
    bad = spark.createDataFrame([(None,), (b"nothing",)], "media binary")
    assert all(r.samples is None and r.dhash is None for r in media.media_columns(bad).collect())
    assert media.media_columns(docs.limit(0)).count() == 0


def test_media_query(spark, tmp_path):
    spark.createDataFrame([(1, "héllo"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    row = {r.doc_id: r for r in media.op10_media_columns(spark, str(tmp_path)).collect()}[1]
    payload = "héllo".encode() + b" " * 186
    stored = b"P6\n64 1\n255\n" + payload
    assert (row.n_bytes, row.payload_bytes, row.payload_sha256, row.tail_crc32) == (6, 192, hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
    assert (row.media_bytes, row.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
