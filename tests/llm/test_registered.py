"""Each registered query over the smallest tables: against its SQL, or against its contract by brute force."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

pytest.importorskip("plumbline.llm")

from plumbline.llm import entry, media  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


def rows_of(spark, name):
    return entry.QUERIES[name](spark, SF).collect()


@pytest.mark.parametrize("name", sorted(entry.ORACLE))
def test_query_equals_sql(spark, con, name):
    df = entry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cur = con.execute(entry.ORACLE[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == columns
    plain = lambda v: round(v, 9) if isinstance(v, float) else v
    key = lambda r: [(x is None, str(x)) for x in r]
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=key)
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cur.fetchall()), key=key)
    assert got == want and got


def test_token_counts(spark, texts):
    from tokenizers import Tokenizer

    from plumbline.llm.tokens import default_vocabulary

    rows = rows_of(spark, "op1_token_counts")
    tokenizer = Tokenizer.from_file(default_vocabulary())
    lengths = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts.values()]
    assert rows and max(lengths) in {v for r in rows for v in r}


def test_mix_contract(spark, con, texts):
    rows = rows_of(spark, "op4_mix_sources")
    sources = dict(con.execute("SELECT doc_id, source FROM documents").fetchall())
    size = {i: len(WORD.findall(t or "")) for i, t in texts.items()}
    total = Counter()
    for i, n in size.items():
        total[sources[i]] += n
    taken = Counter()
    for r in rows:
        assert r["size"] == size[r.doc_id] and r.source_size == total[sources[r.doc_id]] and 0 <= r.taken <= 2 * r["size"]
        taken[sources[r.doc_id]] += r.taken
    targets = {sources[r.doc_id]: r.target for r in rows}
    longest = Counter()
    for i, n in size.items():
        longest[sources[i]] = max(longest[sources[i]], n)
    assert len(rows) == len(texts) and all(abs(taken[s] - targets[s]) <= longest[s] / 2 + 1e-6 for s in targets)
    assert math.isclose(sum(targets.values()), min(1.5 * sum(total.values()), 2 * sum(total.values())), rel_tol=1e-9)


def test_packing_contract(spark, texts):
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in rows_of(spark, "op5_pack_documents"):
        parts[r.doc_id].append((r.start, r.length, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(parts) == set(texts)
    for own in parts.values():
        own.sort()
        assert [s for s, _, _ in own] == [0, *np.cumsum([n for _, n, _ in own])[:-1].tolist()] and sum(n for _, n, _ in own) == own[0][2]
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1].tolist()] and sum(n for _, n in own) <= 2048


def test_scores_contract(spark, texts):
    rows = {r.doc_id: r for r in rows_of(spark, "op9_lm_score")}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {i: WORD.findall((t or "").translate(lower)) + ["\0"] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    count = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    for i, ws in tokens.items():
        r = rows[i]
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(count[w] > 0 for w in ws), n) and math.isclose(r.base_score, base, rel_tol=1e-9)
    assert sum(rows[i].score for i in held if held[i]) > sum(rows[i].base_score for i in held if held[i])


def brute_feature(payload):
    """The tile and hash of a payload stored as rows of 64 pixels, by the share of each source pixel in each target one."""
    gray = np.frombuffer(payload, np.uint8).reshape(-1, 64, 3).astype(np.float32).mean(axis=2).astype(np.float64)

    def shares(n, m):
        edge = lambda k: np.arange(k + 1) / k
        a, b = edge(n), edge(m)
        return np.array([[max(0.0, min(b[j + 1], a[i + 1]) - max(b[j], a[i])) for i in range(n)] for j in range(m)])

    def resize(h, w):
        return shares(gray.shape[0], h) @ gray @ shares(64, w).T * h * w

    return resize(32, 32), resize(8, 9)


def test_media_contract_and_features(spark, texts):
    rows = {r.doc_id: r for r in rows_of(spark, "op10_media_columns")}
    assert set(rows) == set(texts)
    for i, t in texts.items():
        raw = (t or "").encode()
        payload = raw + b" " * (-len(raw) % 192 or (192 if not raw else 0))
        r = rows[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
    for i in sorted(texts, key=lambda i: len(texts[i] or ""))[:: max(1, len(texts) // 25)]:
        raw = (texts[i] or "").encode()
        payload = raw + b" " * (-len(raw) % 192 or (192 if not raw else 0))
        want, small = brute_feature(payload)
        tile, dhash = media.features(np.frombuffer(payload, np.uint8).reshape(-1, 64, 3))
        got = np.load(__import__("io").BytesIO(tile))
        assert np.abs(got - want).max() <= 0.51
        bits = np.unpackbits(np.frombuffer(bytes.fromhex(dhash), np.uint8)).reshape(8, 8).astype(bool)
        apart = np.diff(small, axis=1)
        assert (bits == (apart > 0))[np.abs(apart) > 1e-3].all()
        assert rows[i].feature == f"{dhash}:{hashlib.sha256(tile).hexdigest()}"
