"""Small cases and brute-force versions of the operators on documents, pages and conversations."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("plumbline.llm")

from pyspark.sql import functions as F  # noqa: E402

from plumbline.llm import chat, jaccard, licenses, mixing, ngram_lm, quality, token_counts, url_filter  # noqa: E402
from plumbline.llm.components import components  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, sources=None):
    rows = [(i, t, "en", (sources or ["a"] * len(texts))[i], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def vocabulary_text(rng, n, size=60):
    return " ".join(rng.choice(["Alpha", "b", "ç", "dé", "x1", "the", "of"]) + str(rng.randrange(size)) for _ in range(n))


# URL filters


def brute_url(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.translate(LOWER)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_url_filter_against_brute_force(spark):
    rng = random.Random(5)
    labels = ["com", "net", "a", "b", "ab"]
    rules = {(".".join(rng.choice(labels) for _ in range(rng.randrange(1, 4))), "/" + "".join(rng.choice("ab/") for _ in range(rng.randrange(0, 4)))): rng.choice(["allow", "block"]) for _ in range(40)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = ["http://" + ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 5))) + rng.choice(["", "/", "?q", "#f"]) + "".join(rng.choice("ab/") for _ in range(rng.randrange(0, 6))) for _ in range(400)]
    urls += [None, "", "no scheme", "x://", "HTTP://A.COM/ab?x=/b", "http://a.com://b/", "http://com/" + "ab" * 3000, urls[0], urls[0]]
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = url_filter.url_filter(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute_url(urls[r.page_id], rules), urls[r.page_id]


def test_url_filter_equal_rules_and_empty_tables(spark):
    rules = spark.createDataFrame([("A.com", "/x", "allow"), ("a.com", "/x", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([("http://a.com/xy",)], "url string")
    assert url_filter.url_filter(pages, rules).first().verdict == "block"
    assert url_filter.url_filter(pages.limit(0), rules).count() == 0
    assert url_filter.url_filter(pages, rules.limit(0)).first().verdict == "allow"


def test_url_paths_of_any_character(spark):
    rules = [("com", "/en/", "block"), ("a.com", "/en/\uffff", "allow"), ("", "/x", "block")]
    urls = ["http://a.com/en/\U0010ffffx", "http://a.com/en/\U0010ffff\U0010ffff", "http://a.com/en/\uffff\U0010ffff", "http://a.com/en0", "http://com/en/", "http:///x", "http://com./x", "http://com./en/", "http://a..com/en/y", "http://xcom/en/"]
    pages = spark.createDataFrame([(i, u, "t", "p", 1) for i, u in enumerate(urls)], "page_id long, url string, top string, part string, `a.b` int")
    got = url_filter.url_filter(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert got.columns == ["page_id", "url", "top", "part", "a.b", "host", "path", "rule", "verdict"]
    rows = got.collect()
    assert len(rows) == len(urls) and all(r.top == "t" and r["a.b"] == 1 for r in rows)
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == brute_url(urls[r.page_id], rules), urls[r.page_id]


def test_url_filter_deals_many_keys(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "SWEEP_KEYS", 7)
    rng = random.Random(6)
    rules = [(h, "/" + "a" * i, v) for h, i, v in (("com", 0, "block"), ("x.com", 1, "allow"), ("y.x.com", 3, "block"), ("net", 2, "block"))]
    urls = [f"http://{rng.choice(['', 'x.', 'y.x.', 'z.y.x.', f'h{i}.'])}{rng.choice(['com', 'net', 'org'])}/{'a' * rng.randrange(5)}" for i in range(300)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for r in url_filter.url_filter(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect():
        assert (r.host, r.path, r.rule, r.verdict) == brute_url(urls[r.page_id], rules), urls[r.page_id]


# Columns of any name


def test_users_columns_stay(spark):
    names = ["mark", "dir", "own_path", "left_chars", "counts", "lines", "chars", "top", "a.b", "Key"]
    text = "One two three four five six seven eight nine ten. " * 8
    docs = spark.createDataFrame([(1, "d/f.txt", text, "s", "http://a.com/x", *range(len(names)))], "doc_id long, path string, text string, source string, url string, " + ", ".join(f"`{n}` int" for n in names))
    for df in (quality.quality_rules(docs), licenses.license_scan(docs), url_filter.url_filter(docs.drop("path"), spark.createDataFrame([], "host string, path string, verdict string")), mixing.mixed_documents(docs, share=1.0)):
        assert [df.first()[n] for n in names] == list(range(len(names)))


# Mixing


def brute_targets(sizes, share=1.5, cap=2.0, cycle=(3, 1, 2)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: cycle[i % 3] for i, s in enumerate(names)}
    budget, capped = share * sum(sizes.values()), set()
    while True:
        left = budget - sum(cap * sizes[s] for s in capped)
        total = sum(weight[s] for s in names if s not in capped)
        out = {s: cap * sizes[s] if s in capped else left * weight[s] / total for s in names}
        over = {s for s in names if s not in capped and out[s] > cap * sizes[s]}
        if not over:
            return out
        capped |= over


def test_mixing_targets_and_taken(spark):
    rng = random.Random(2)
    texts = [vocabulary_text(rng, rng.choice([0, 1, 5, 30, 80])) if rng.random() > 0.02 else None for _ in range(600)]
    sources = [rng.choice(["a", "a", "a", "b", "c", "é", None]) for _ in texts]
    docs = documents(spark, texts, sources)
    got = mixing.mix_sources(docs).collect()
    size = {i: len(WORD.findall(t or "")) for i, t in enumerate(texts)}
    by = Counter()
    for i, s in enumerate(sources):
        by[s] += size[i]
    target, taken = brute_targets(by), Counter()
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    for r in got:
        assert r.size == size[r.doc_id] and r.source_size == by[r.source] and math.isclose(r.target, target[r.source])
        assert r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in by:
        assert abs(taken[s] - target[s]) <= max(size[i] for i in size if sources[i] == s) / 2 + 1e-6
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in got}
    mixed = Counter(r.doc_id for r in mixing.mixed_documents(docs).collect())
    assert all(mixed[r.doc_id] == r.copies for r in got)


def test_mixing_order_is_by_exponential_keys(spark):
    docs = documents(spark, [f"w{i} " * (i % 7 + 1) for i in range(300)])
    rows = mixing._keyed(docs, "source", "text", "doc_id").select("doc_id", "__key", "__size").collect()
    got = {r.doc_id: r.copies for r in mixing.mix_sources(docs, share=1.3).collect()}
    rest, cut = 0.3 * sum(r["__size"] for r in rows), 0
    for r in sorted(rows, key=lambda r: r["__key"]):
        assert got[r.doc_id] == 1 + (cut + r["__size"] / 2 <= rest)
        cut += r["__size"]


def test_mixing_repeated_rows_and_empty_table(spark):
    docs = documents(spark, ["same words here"] * 3 + [None, ""]).withColumn("doc_id", F.lit(1).cast("long")).withColumn("size", F.lit("x"))
    assert mixing.mix_sources(docs).count() == 5
    assert mixing.mix_sources(docs.limit(0)).count() == 0


# Chat


def test_chat_round_trip(spark):
    rng = random.Random(1)
    bits = ["###", "### User: ", "</turn>", "</part>", "\\", "\\h", "\\l/", "<", "</", "#", ":", ": ", "\n", "é", "𝄞", "word ", ""]
    rows, said = [], defaultdict(list)
    for c in range(40):
        for t in range(rng.randrange(1, 9)):
            row = (c, t, rng.choice(["user", "assistant", "sys:tem#", "a: b", ""]), "".join(rng.choice(bits) for _ in range(rng.randrange(8))))
            rows.append(row)
            said[c].append(row[2:])
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    out = chat.format_chats(df)
    got = out.select("conv_id", "formatted", chat.read_chats(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert len(got) == 40
    for r in got:
        assert [tuple(t) for t in r.turns] == said[r.conv_id]
        assert r.loss == "".join(t for role, t in said[r.conv_id] if role == "assistant")


def test_chat_merges_and_nulls(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", None), (None, None, None, "z"), (1, 1, "user", "b")]
    got = {r.conv_id: r.formatted for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[1] == "### user: a</part>b</part>b</turn>\n### assistant: </turn>\n"
    assert got[None] == "### : z</turn>\n"
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# Quality


def brute_base(text):
    ws = WORD.findall(text or "")
    grams = Counter(zip(ws, ws[1:], ws[2:]))
    hit = {j for i in range(len(ws) - 2) if grams[tuple(ws[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_quality_counts(spark):
    rng = random.Random(3)
    texts = [None, "", " \t\n", "one", "a b c a b c a b c", "a a a a", "x\ny\nx\n\n \nx ", "a\x1fb\u00a0c d\x0be"]
    texts += ["\n".join(vocabulary_text(rng, rng.randrange(1, 12), 3) + rng.choice([".", "", " |"]) for _ in range(rng.randrange(1, 9))) for _ in range(150)]
    texts.append(" ".join(f"w{i % 9000}" for i in range(30000)))
    docs = documents(spark, texts).withColumn("kept", F.lit("clash"))
    for r in quality.quality_rules(docs).collect():
        want = brute_base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_quality_verdicts(spark):
    rng = random.Random(12)
    prose = "\n".join(" ".join(f"w{rng.randrange(9000)}" for _ in range(14)) + "." for i in range(12))
    menu = "\n".join(["Home", "About us", "Contact", "Login"] * 12) + "\n" + " | ".join(f"Item {i}" for i in range(40))
    junk = " ".join(f"word{i}&&&" for i in range(80))
    loud = " ".join(f"LOUD{chr(65 + i % 26)}{chr(65 + i // 26)}!!" for i in range(80))
    rows = quality.quality_rules(documents(spark, [prose, menu, junk, loud, prose + "\nAll rights reserved.\nShare this"])).orderBy("doc_id").collect()
    assert [r.kept for r in rows] == [True, False, False, False, True]
    assert rows[4].clean_text == prose and rows[4].n_removed == 2
    assert quality.quality_rules(documents(spark, ["x"]).limit(0)).count() == 0


LINES = [
    ("Alle Rechte vorbehalten.", True), ("© 2024 Beispiel GmbH. Alle Rechte vorbehalten.", True), ("Tous droits réservés.", True), ("TOUS DROITS RÉSERVÉS.", True), ("Lire la suite.", True), ("Política de privacidad.", True),
    ("Haga clic aquí.", True), ("Über uns", True), ("ÜBER UNS", True), ("Zurück", True), ("Précédent", True), ("Carrito", True), ("All rights reserved.", True), ("Sign in.", True), ("Home | About | Contact", True), ("### && ##", True),
    ("Their market share on the island grew quickly.", False), ("He admired the design in silence and left.", False), ("The blog in question was closed that year.", False), ("Der Weg zurück war lang und sehr steil.", False),
    ("The mill is powered by a river that runs past the village all year.", False), ("Over 60 of the windows were broken by hail in 1911.", False), ("a prose line cut in the middle of a long sentence", False), ("Nous avons lu la suite du livre hier soir.", False),
]


def test_quality_lines_of_four_languages(spark):
    df = spark.createDataFrame(LINES, "line string, want boolean")
    got = {r.line: r.fails for r in df.select("line", quality.line_fails(F.col("line")).alias("fails")).collect()}
    assert got == dict(LINES)


# Jaccard


def brute_components(texts, n, percent):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset())
    label = list(range(len(texts)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def near_copies(rng, n_docs):
    texts = []
    for _ in range(n_docs):
        if texts and rng.random() < 0.6:
            w = rng.choice(texts).split()
            for _ in range(rng.randrange(0, 4)):
                if w:
                    k = rng.randrange(len(w))
                    w[k : k + rng.randrange(0, 2)] = [f"new{rng.randrange(10**6)}"] * rng.randrange(0, 2)
            texts.append(" ".join(w))
        else:
            texts.append(vocabulary_text(rng, rng.choice([1, 2, 3, 8, 40, 120]), 400))
    return texts


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_jaccard_against_brute_force(spark, n, percent):
    rng = random.Random(n)
    texts = [None, "", " ", "one", "One", "two words", "two  WORDS"] + near_copies(rng, 160)
    base = vocabulary_text(rng, 300, 10**6).split()
    for i in range(60):  # one group of near copies, linked by chains
        base = list(base)
        base[rng.randrange(300)] = f"chain{i}"
        texts.append(" ".join(base))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(documents(spark, texts), n, percent).collect()}
    assert [got[i] for i in range(len(texts))] == brute_components(texts, n, percent)


def test_jaccard_null_ids_and_empty_table(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (None, "q r s t u v"), (9, None), (4, "a b c d e f")]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [(0, 2, 0), (0, 2, 4), (4, 2, 4), (4, 2, 4), (9, 0, 9)]
    assert jaccard.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).unionByName(spark.createDataFrame([(500, 501)], "a long, b long"))
    got = components(edges.orderBy(F.xxhash64("a"))).collect()
    assert {r.label for r in got if r.node <= 200} == {0} and {r.label for r in got if r.node >= 500} == {500} and len(got) == 203


# Language model


def brute_scores(texts, train, counts_discount):
    toks = [WORD.findall((t or "").translate(LOWER)) + ["\0"] for t in texts]
    c = Counter(w for i in train for w in toks[i])
    pairs = Counter(p for i in train for p in zip(["\1", *toks[i]], toks[i]))
    total, follow, before = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
    for (u, v), k in pairs.items():
        total[u] += k
        follow[u][min(k, 3) - 1] += 1
        before[v] += 1
    d2, d1 = (counts_discount([sum(x == k for x in vals) for k in (1, 2, 3, 4)]) for vals in (list(pairs.values()), list(before.values())))
    rest = sum(d1[min(x, 3) - 1] for x in before.values()) / len(pairs)
    less = lambda k, d: k - d[min(k, 3) - 1] if k else 0.0

    def p(u, v):
        one = less(before[v], d1) / len(pairs) + rest / (len(c) + 1)
        return less(pairs[u, v], d2) / total[u] + sum(a * b for a, b in zip(d2, follow[u])) / total[u] * one if total[u] else one

    n = sum(c.values())
    for t in toks:
        yield len(t), sum(c[w] > 0 for w in t), sum(math.log10((c[w] + 0.1) / (n + 0.1 * (len(c) + 1))) for w in t), sum(math.log10(p(u, v)) for u, v in zip(["\1", *t], t))
    assert math.isclose(sum(p("the1", v) for v in [*c, "never seen"]), 1, rel_tol=1e-9)


def test_lm_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    texts = [None, "", "the1 never", *(vocabulary_text(rng, rng.randrange(1, 60), 20) for _ in range(200)), "long " * 5000]
    docs = documents(spark, texts).repartition(3)
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))}
    model = ngram_lm.train(docs.where(~ngram_lm.held_out(F.col("doc_id"))))
    got = {r.doc_id: r for r in ngram_lm.score(docs, model).collect()}
    for i, (n, known, base, score) in enumerate(brute_scores(texts, [i for i in held if not held[i]], ngram_lm.discounts)):
        r = got[i]
        assert (r.n_tokens, r.n_known) == (n, known) and math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9)
    out = [r for i, r in got.items() if held[i] and i > 2]
    assert sum(r.score for r in out) > 0.2 * sum(r.base_score for r in out) * 10 or sum(r.score for r in out) > sum(r.base_score for r in out)


def brute_scores_of_triples(texts, train, counts_discount):
    toks = [["\1", *WORD.findall((t or "").translate(LOWER)), "\0"] for t in texts]
    raw2 = Counter(p for i in train for p in zip(toks[i], toks[i][1:]))
    three = Counter(p for i in train for p in zip(toks[i], toks[i][1:], toks[i][2:]))
    two, one = Counter(t[1:] for t in three), Counter(p[1] for p in raw2)
    two.update({p: k for p, k in raw2.items() if p[0] == "\1"})
    off = [counts_discount([sum(x == k for x in c.values()) for k in (1, 2, 3, 4)]) for c in (one, two, three)]
    less = lambda k, d: k - d[min(k, 3) - 1] if k else 0.0
    rest = sum(off[0][min(k, 3) - 1] for k in one.values()) / len(raw2)
    follow = defaultdict(list)
    for c in (two, three):
        for gram, k in c.items():
            follow[gram[:-1]].append(k)

    def p(context, w):
        if not context:
            return less(one[w], off[0]) / len(raw2) + rest / (len(one) + 1)
        after, d = follow.get(context), off[len(context)]
        if not after:
            return p(context[1:], w)
        return less((two, three)[len(context) - 1][(*context, w)], d) / sum(after) + sum(d[min(k, 3) - 1] for k in after) / sum(after) * p(context[1:], w)

    assert math.isclose(sum(p(("the1", "the2"), v) for v in [*one, "never seen"]), 1, rel_tol=1e-9)
    return [sum(math.log10(p(tuple(t[max(0, i - 2) : i]), t[i])) for i in range(1, len(t))) for t in toks]


def test_lm_of_order_3_against_brute_force(spark):
    rng = random.Random(8)
    texts = [None, "", "the1 never", *(vocabulary_text(rng, rng.randrange(1, 60), 4) for _ in range(200)), "long " * 5000]
    docs = documents(spark, texts).repartition(3)
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))}
    model = ngram_lm.train(docs.where(~ngram_lm.held_out(F.col("doc_id"))), order=3)
    got = {r.doc_id: r.score for r in ngram_lm.score(docs, model).collect()}
    for i, want in enumerate(brute_scores_of_triples(texts, [i for i in held if not held[i]], ngram_lm.discounts)):
        assert math.isclose(got[i], want, rel_tol=1e-9)
    none = ngram_lm.train(docs.limit(0), order=3)
    assert all(r.score == 0.0 for r in ngram_lm.score(docs, none).collect())


@pytest.mark.parametrize("order", [2, 3])
def test_lm_deals_frequent_words_over_shards(spark, monkeypatch, order):
    rng = random.Random(10)
    texts = [" ".join(rng.choice(["the", "the", f"w{rng.randrange(300)}"]) for _ in range(rng.randrange(60))) for _ in range(150)]
    docs = documents(spark, texts).repartition(5)
    one = ngram_lm.train(docs, order=order)
    many = ngram_lm.train(docs, order=order, shard_bytes=200)
    assert many.bits > one.bits and many.spread.max() > 2 and len(many.frequent) > 1 and (many.frequent_stats >= 0).all()
    score = lambda model: {r.doc_id: r.score for r in ngram_lm.score(docs, model).collect()}
    a, b = score(one), score(many)
    assert all(math.isclose(a[i], b[i], rel_tol=1e-9) for i in a) and len(a) == len(texts)


@pytest.mark.parametrize("order", [2, 3])
def test_lookups_go_through_a_bounded_number_of_files(spark, order):
    import os

    from plumbline.llm import runs

    rng = random.Random(8)
    texts = [" ".join(f"w{int(rng.paretovariate(0.6)) % 3000}" for _ in range(rng.randrange(60))) for _ in range(120)] + [None, "the " * 700]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    one, many = ngram_lm.train(docs, order=order), ngram_lm.train(docs, order=order, shard_bytes=100)
    assert (one.bits, one.shift) == (4, 0) and many.bits >= 8 and many.shift == many.bits - max(4, many.bits // 2)
    assert len(os.listdir(runs._local(many.root))) <= len(os.listdir(runs._local(one.root)))
    score = lambda model: {r.doc_id: (r.n_known, r.base_score, r.score) for r in ngram_lm.score(docs, model).collect()}
    assert score(one) == score(many)


def test_lm_of_other_stores_and_large_counts(tmp_path):
    from plumbline.llm import runs

    values = np.array([0, 3, 254, 255, 256, 2**40, 0])
    runs.put_counts(str(tmp_path), "x", values)
    assert (runs.counts_at(str(tmp_path), "x", np.arange(7)[::-1]) == values[::-1]).all()
    low, high = np.array([0, 0, 3, 3, 5]), np.array([3, 3, 3, 5, 5])
    assert ngram_lm.find(np.array([1, 4, 9, 2, 2]), low, high, np.array([9, 2, 2, 2, 2])).tolist() == [2, -1, -1, 3, -1]
    rng = np.random.default_rng(0)
    parts = [np.unique(rng.integers(0, 500, 300).astype(np.uint64), return_counts=True) for _ in range(9)]
    packed = [runs.pack_run(k, c) for k, c in parts]
    whole, pieces = runs.merge_runs(packed), runs.merge_runs(packed, piece=100)
    assert (whole[0] == pieces[0]).all() and (whole[1] == pieces[1]).all() and whole[1].sum() == 2700
    at = [tmp_path / str(i) for i in range(3)]
    for i, p in enumerate(at):
        runs.put(str(p), "a.npy", np.arange(i + 1))
    assert [len(runs.get(str(p), "a.npy")) for p in (*at, *at)] == [1, 2, 3, 1, 2, 3]


def test_lm_without_training_rows(spark):
    docs = documents(spark, ["a b", None])
    model = ngram_lm.train(docs.limit(0))
    rows = ngram_lm.score(docs, model).orderBy("doc_id").collect()
    assert [r.n_tokens for r in rows] == [3, 1] and all(r.score == 0.0 and r.n_known == 0 for r in rows)
    assert ngram_lm.score(docs.limit(0), model).count() == 0


def test_chat_of_many_turns(spark):
    rng = random.Random(14)
    turns = [(1, i, rng.choice(["user", "assistant", "a:b"]), rng.choice(["", "x", "</turn>\n### user: ", "\\h", "é😀"]) * rng.randrange(3)) for i in range(700)]
    chats = chat.format_chats(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    r = chats.select("*", chat.read_chats(F.col("formatted")).alias("turns")).first()
    assert [tuple(t) for t in r.turns] == [(t[2], t[3]) for t in turns]
    said = [chat_unescape(r.formatted[s.start : s.start + s.chars]) for s in r.loss_spans]
    assert said == [t[3] for t in turns if t[2] == "assistant"]


def chat_unescape(text):
    return text.replace("\\l/", "</").replace("\\h", "#").replace("\\b", "\\")


# Token counts


def test_token_counts(spark):
    from tokenizers import Tokenizer

    from plumbline.llm.tokens import default_vocabulary

    texts = [None, "", "Hello world", "Ünïcode  ıİ ΑΣ σς\u2003x\x1fy", "a" * 3000, "hello world"] + [f"w{i} x" * (i % 5) for i in range(30)]
    sizes = [len(Tokenizer.from_file(default_vocabulary()).encode(t or "", add_special_tokens=False).ids) for t in texts]
    sums = token_counts.suffix_sums(token_counts.length_histogram(documents(spark, texts)))
    for r in sums.collect():
        assert r.n_docs == sizes.count(r.n_tokens) and r.docs_from == sum(s >= r.n_tokens for s in sizes)
        assert r.tokens_from == sum(s for s in sizes if s >= r.n_tokens) and r.truncated_tokens == sum(min(s, r.n_tokens) for s in sizes)
        assert math.isclose(r.share_upto, sum(s <= r.n_tokens for s in sizes) / len(sizes))
    limits = spark.createDataFrame([(k,) for k in (0, 1, 3, 7, 10**6)], "context_limit long")
    for r in token_counts.at_limits(sums, limits).collect():
        assert r.truncated_tokens == sum(min(s, r.context_limit) for s in sizes) and r.docs_over == sum(s > r.context_limit for s in sizes)
    assert token_counts.quantile(sums, 0.5).first()[0] == sorted(sizes)[(len(sizes) + 1) // 2 - 1]
    assert token_counts.suffix_sums(token_counts.length_histogram(documents(spark, ["x"]).limit(0))).count() == 0


# Licences


def test_licenses(spark):
    rows = [
        ("a/LICENSE", "Licensed under the Apache License, Version 2.0."), ("a/x.txt", "plain text"), ("a/b/y.txt", "Some words.\nReleased under the MIT License.\nMore."),
        ("a/b/c/z.txt", None), ("a/b/LICENSE", "no licence at all"), ("q/w.txt", ""), ("top.txt", "text"), (None, "Licensed under CC BY-NC 4.0."), ("q/w.txt", ""),
        ("m/COPYING", "This work is licensed under the GNU General Public License, version 3."), ("m/n/o/p.txt", "words " * 5000),
    ]
    df = spark.createDataFrame([(i, *r, "mine") for i, r in enumerate(rows)], "n int, path string, text string, license string")
    got = {r.n: (r.own_license, r.license, r.license_from) for r in licenses.license_scan(df).collect()}
    assert got == {
        0: ("Apache-2.0", "Apache-2.0", None), 1: (None, "Apache-2.0", "a"), 2: ("MIT", "MIT", None), 3: (None, "Apache-2.0", "a"), 4: (None, "Apache-2.0", "a"),
        5: (None, None, None), 6: (None, None, None), 7: ("CC-BY-NC-4.0", "CC-BY-NC-4.0", None), 8: (None, None, None), 9: ("GPL-3.0", "GPL-3.0", None), 10: (None, "GPL-3.0", "m"),
    }
    assert licenses.license_scan(df.limit(0)).count() == 0


HEADERS = [
    ("// SPDX-License-Identifier: MIT\nint main() {}", "MIT"), ("# SPDX-License-Identifier: (Apache-2.0 OR MIT)", "Apache-2.0"), ("/* SPDX-License-Identifier: GPL-3.0-or-later */", "GPL-3.0"), ("SPDX-License-Identifier: Zlib", "Zlib"),
    ("This file is licensed under the MIT License.", "MIT"), ("The code is released under the MIT License unless noted otherwise.", "MIT"),
    ("Licensed under the Apache License, Version 2.0 by Example Corp in 2021 for all of its modules", "Apache-2.0"),
    (" * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.", "GPL-3.0"),
    ("it under the terms of the GNU Lesser General Public License as published by\nthe Free Software Foundation; either version 2.1 of the License", "LGPL-2.1"),
    ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\nincorporates version 3 of the GNU General Public License", "LGPL-3.0"),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n combine with version 3 of the GNU Affero General Public License", "GPL-3.0"),
    ("Copyright (c) 2020, X. All rights reserved.\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that ...\n2. Redistributions in binary form must\n3. Neither the name of X nor", "BSD-3-Clause"),
    ("Copyright (c) 2020, X. All rights reserved.\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that ...\n2. Redistributions in binary form must", "BSD-2-Clause"),
    ("This is under GPLv2.", "GPL-2.0"), ("Shared under CC BY-NC-SA 4.0 by the authors", "CC-BY-NC-SA-4.0"), ("under a Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy", "MPL-2.0"), ("Copyright 2021 by Example Corp, all rights reserved worldwide by its owners and heirs", "Proprietary"),
    ("MIT students need a license to park.", None), ("under some license of the town", None),
]


def test_licenses_of_usual_headers(spark):
    df = spark.createDataFrame([(i, f"d{i}/x.c", text) for i, (text, _) in enumerate(HEADERS)], "n int, path string, text string")
    got = {r.n: r.own_license for r in licenses.license_scan(df).collect()}
    assert [got[i] for i in range(len(HEADERS))] == [name for _, name in HEADERS]


def test_digest_of_the_fixed_conversation(spark, tmp_path):
    turns = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    path = str(tmp_path)
    turns.write.parquet(f"{path}/conversations.parquet")
    row = {r.conv_id: r for r in chat.op7_format_chats(spark, path).collect()}[-7]
    said = r"\### Assistant: </turn> ok"
    assert row.n_turns == 2 and row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
