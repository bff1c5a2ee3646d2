"""Quality rules, lines first: each line is judged by punctuation, navigation and boilerplate rules, failing lines are
removed, and a document that fails the base rules or loses too much of its text is rejected.

Defined results: a null or blank text has no words, counts 0 throughout and is rejected; lines are what stands between
line feeds, and empty lines are neither judged nor counted as lost; repeated rows are judged alike; an empty table gives
an empty table; columns named like the results are replaced by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import SPACE_RE, SPACES, let, named, others, table, words

SYMBOLS_RE = r"[#*$%&|<>]"
#: Phrases of boilerplate in English, German, French and Spanish.
BOILERPLATE = [
    "all rights reserved", "cookie policy", "accept cookies", "accept all cookies", "uses cookies", "use cookies", "privacy policy", "terms of use", "terms of service", "enable javascript",
    "javascript is disabled", "javascript is required", "sign in", "sign up", "login", "log in", "subscribe to", "newsletter", "click here", "read more", "share this", "share on", "follow us",
    "lorem ipsum", "back to top", "skip to content", "skip to main content", "powered by",
    "alle rechte vorbehalten", "alle cookies akzeptieren", "cookies akzeptieren", "verwendet cookies", "datenschutzerklärung", "nutzungsbedingungen", "impressum", "mehr lesen", "weiterlesen", "hier klicken",
    "jetzt anmelden", "folgen sie uns", "nach oben", "zum inhalt springen",
    "tous droits réservés", "accepter les cookies", "utilise des cookies", "politique de confidentialité", "mentions légales", "conditions d'utilisation", "lire la suite", "cliquez ici", "se connecter",
    "suivez-nous", "haut de page", "aller au contenu",
    "todos los derechos reservados", "aceptar cookies", "utiliza cookies", "política de privacidad", "política de cookies", "aviso legal", "términos y condiciones", "leer más", "haga clic aquí", "iniciar sesión",
    "síguenos", "volver arriba", "saltar al contenido",
]
#: Of a line's characters: the share that a phrase of boilerplate must have, and the words up to which it is looked for.
BOILERPLATE_SHARE, BOILERPLATE_WORDS = 0.25, 25
#: A line of more characters has no phrase of that share.
BOILERPLATE_CHARS = int(max(map(len, BOILERPLATE)) / BOILERPLATE_SHARE)
#: What menus are made of, in the same languages.
MENU = [
    "home", "about", "about us", "contact", "contact us", "menu", "search", "login", "log in", "sign in", "sign up", "register", "help", "faq", "sitemap", "next", "previous", "prev", "back", "more", "share",
    "print", "top", "blog", "news", "shop", "cart", "rss",
    "startseite", "über uns", "kontakt", "suche", "anmelden", "registrieren", "hilfe", "weiter", "zurück", "mehr", "teilen", "drucken", "warenkorb",
    "accueil", "à propos", "recherche", "connexion", "inscription", "aide", "suivant", "précédent", "retour", "plus", "partager", "imprimer", "panier", "boutique",
    "inicio", "acerca de", "contacto", "buscar", "acceder", "registrarse", "ayuda", "siguiente", "anterior", "volver", "más", "compartir", "imprimir", "carrito", "tienda",
]
MENU_WORDS = max(len(m.split()) for m in MENU)


def _any_case(phrase: str) -> str:
    """The phrase as a pattern that takes other letters than ASCII in either case, as (?i) does for those."""
    return "".join(c if c.isascii() else f"[{c}{c.upper()}]" for c in phrase)


def _alternatives(phrases: list[str]) -> str:
    """Any of the phrases, by first letter: few are tried where a word begins. Of two that begin alike the earlier goes first."""
    heads: dict[str, list[str]] = {}
    for phrase in phrases:
        heads.setdefault(phrase[0], []).append(phrase[1:])
    return "|".join(f"{_any_case(c)}(?:{'|'.join(map(_any_case, rest))})" for c, rest in heads.items())


BOILERPLATE_RE = r"(?i)(?:^|[^\p{L}])(" + _alternatives(BOILERPLATE) + r")(?:[^\p{L}]|$)"
MENU_RE = "(?i)^(" + "|".join(map(_any_case, MENU)) + ")$"
END_RE = "[.!?\u2026:;\"'\u201d\u2019\u00bb)\\]\u3002\uff01\uff1f][ \\t-\\r]*$"
#: Of the characters, and of a line's: symbols above which a line is markup or menu.
LINE_SYMBOLS = 0.10
#: Separators of menu items, and the words an item has at most on average, with its separator.
SEPARATORS_RE, ITEM_WORDS = "[|\u00bb\u203a\u2022]", 5
#: Words from which a line without closing punctuation counts as prose that was cut, and is kept.
PROSE_WORDS = 8
MIN_WORDS, MAX_REPEAT = 50, 50
#: The least share of the text's characters that must be left.
MIN_LEFT = 0.7


def line_fails(line: Column) -> Column:
    """Whether a line that has a word is navigation, boilerplate, markup or a fragment without punctuation. What is cheap
    and what most lines pass is asked first."""

    def judge(own: Column) -> Column:
        n, trimmed = own["n"], own["trimmed"]
        separators = F.regexp_count(line, F.lit(SEPARATORS_RE))
        menu_line = let(separators, lambda k: (k >= 2) & (ITEM_WORDS * k >= n))
        phrase = F.length(F.regexp_extract(line, BOILERPLATE_RE, 1))
        # More than half of the characters are capitals only if two of them stand side by side or about one other.
        shouted = line.rlike(r"(?s)\p{Lu}.?\p{Lu}") & (F.length(F.regexp_replace(line, r"\p{Lu}++", "")) < 0.5 * F.length(line))
        return (
            ((n < PROSE_WORDS) & ~line.rlike(END_RE))
            | (line.rlike(SYMBOLS_RE) & (F.regexp_count(line, F.lit(SYMBOLS_RE)) > LINE_SYMBOLS * F.length(line)))
            | (line.rlike(SEPARATORS_RE) & menu_line)
            | ((n <= MENU_WORDS) & trimmed.rlike(MENU_RE))
            | ((n >= 4) & shouted)
            | ((n <= BOILERPLATE_WORDS) & (F.length(trimmed) <= BOILERPLATE_CHARS) & let(phrase, lambda k: (k > 0) & (k >= BOILERPLATE_SHARE * F.length(trimmed))))
        )

    trimmed = F.btrim(line, F.lit(SPACES))
    return let(F.struct(F.size(F.split(trimmed, SPACE_RE)).alias("n"), trimmed.alias("trimmed")), judge)


def repeat_words(ws: Column) -> Column:
    """Words that lie in a run of three which the text has twice or more."""
    runs = F.transform(F.slice(ws, F.lit(1), F.size(ws) - 2), lambda w, i: F.xxhash64(w, F.get(ws, i + 1), F.get(ws, i + 2)))

    def covered(run: Column) -> Column:
        at = F.array_sort(F.transform(run, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            hit = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
            return let(F.array_sort(F.transform(hit, lambda x: x["i"])), lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))), F.lit(0), lambda a, b: a + b))

        return F.when(F.size(F.array_distinct(run)) == F.size(run), F.lit(0)).otherwise(let(at, twice))

    return F.when(F.size(ws) < 4, F.lit(0)).otherwise(let(runs, covered)).cast("long")


RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines", "n_removed", "left_share", "kept", "clean_text")


def quality_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the counts, base_failed, clean_text (the lines that stay) and kept."""
    body = F.coalesce(named(text), F.lit(""))

    def counts(ws: Column) -> Column:
        return F.struct(F.size(ws).cast("long").alias("n_words"), F.length(F.array_join(ws, "")).cast("long").alias("word_chars"), repeat_words(ws).alias("n_repeat_words"))

    def lines(ls: Column) -> Column:
        own = F.filter(ls, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        left = F.filter(ls, lambda x: ~(x.rlike(r"[^\x20\x09-\x0D]") & line_fails(x)))
        chars = lambda a: F.length(F.regexp_replace(F.array_join(a, ""), SPACE_RE, ""))
        return let(own, lambda o: let(left, lambda f: F.struct(F.size(o).cast("long").alias("n_lines"), (F.size(o) - F.size(F.array_distinct(o))).cast("long").alias("n_dup_lines"), (F.size(ls) - F.size(f)).cast("long").alias("n_removed"), F.array_join(f, "\n").alias("clean_text"), chars(f).alias("chars"))))

    def results(x: Column) -> Column:
        n, ls = x["counts"], x["lines"]
        base = (n["n_words"] < MIN_WORDS) | (100 * n["n_repeat_words"] > MAX_REPEAT * n["n_words"])
        share = ls["chars"] / F.greatest(n["word_chars"], F.lit(1))
        found = {"n_symbols": F.regexp_count(body, F.lit(SYMBOLS_RE)).cast("long"), "base_failed": base, "left_share": share, "kept": ~base & (share >= MIN_LEFT)}
        found |= {c: n[c] for c in ("n_words", "word_chars", "n_repeat_words")} | {c: ls[c] for c in ("n_lines", "n_dup_lines", "n_removed", "clean_text")}
        return F.struct(*[found[c].alias(c) for c in RESULTS])

    # As one generated row: a filter on the results isn't pushed below a generator, which would judge each text twice.
    own = F.struct(let(words(body), counts).alias("counts"), let(F.split(body, "\n"), lines).alias("lines"))
    return docs.select(*others(docs, *[c for c in RESULTS if c.lower() != text.lower()]), F.inline(F.array(let(own, results))))


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_Q = lambda s: s.replace("'", "''")
OP8_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT r, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS run FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, run) AS k FROM g),
p AS (SELECT r, count(DISTINCT x) AS n_repeat FROM (SELECT r, unnest([i, i + 1, i + 2]) AS x FROM h WHERE k > 1) GROUP BY r),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
f AS (SELECT r, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n, regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS x FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
j AS (SELECT r, line, len(regexp_extract_all(line, '{SYMBOLS_RE}')) > {LINE_SYMBOLS} * length(line)
  OR (len(regexp_extract_all(line, '{SEPARATORS_RE}')) >= 2 AND {ITEM_WORDS} * len(regexp_extract_all(line, '{SEPARATORS_RE}')) >= n)
  OR (n <= {BOILERPLATE_WORDS} AND regexp_matches(line, '{_Q(BOILERPLATE_RE)}') AND length(regexp_extract(line, '{_Q(BOILERPLATE_RE)}', 1)) >= CAST({BOILERPLATE_SHARE} AS DOUBLE) * length(x)) OR regexp_matches(x, '{MENU_RE}')
  OR (n >= 4 AND length(regexp_replace(line, '\p{{Lu}}+', '', 'g')) < 0.5 * length(line)) OR (n < {PROSE_WORDS} AND NOT regexp_matches(line, '{_Q(END_RE)}')) AS fails FROM f),
s AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup, sum(CASE WHEN fails THEN 0 ELSE length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) END) AS left_chars FROM j GROUP BY r),
c AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '{SYMBOLS_RE}')) AS BIGINT) AS n_symbols,
  CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words, coalesce(left_chars, 0) AS left_chars FROM d JOIN w USING (r) LEFT JOIN p USING (r) LEFT JOIN s USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND CAST(left_chars AS DOUBLE) / greatest(word_chars, 1) >= CAST({MIN_LEFT} AS DOUBLE) AS kept FROM b
"""
