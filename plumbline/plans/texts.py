"""Queries on documents, pages and other texts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.functions import scalars as S
from plumbline.operators import keys as K
from plumbline.operators import rank as X
from plumbline.plans.catalog import Tables, query
from plumbline.sources import html, markdown


def _md(c: str) -> str:
    """S.strip_markdown as SQL."""
    for pattern, to in S.MARKDOWN_STEPS:
        c = f"regexp_replace({c}, '{pattern}', '{to.replace('$1', chr(92) + '1')}', 'g')"
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


def _find(f: str, t: str) -> str:
    return f"(instr({f}, '{t}') - 1)"


def _relevance(query: str, fields: list[tuple[str, float]]) -> str:
    """X.relevance as SQL."""
    terms = query.split()
    comb = "concat_ws(' ', " + ", ".join(f"nullif({f}, '')" for f, _ in fields) + ")"
    out = f"CASE WHEN contains({comb}, '{query}') THEN 2000 - least({_find(comb, query)}, 999) ELSE 0 END"
    for f, w in fields:
        out += f" + CASE WHEN contains({f}, '{query}') THEN {w} * (1000 - least({_find(f, query)}, 999)) ELSE 0 END"
        for t in terms:
            out += f" + CASE WHEN contains({f}, '{t}') THEN {w} * (150 - least({_find(f, t)}, 149)) ELSE 0 END"
    every = " AND ".join(f"contains({comb}, '{t}')" for t in terms)
    return f"CAST(CASE WHEN {comb} <> '' AND (contains({comb}, '{query}') OR ({every})) THEN {out} ELSE 0 END AS DOUBLE)"


@query("F01 O08 T09", "SELECT doc_id, (SELECT count(*) FROM documents WHERE contains(lower(concat_ws(' ', text, source)), 'licensed')) AS total FROM documents WHERE contains(lower(concat_ws(' ', text, source)), 'licensed') ORDER BY doc_id LIMIT 20")
def keyword_search_total(t: Tables):
    """The first twenty documents with a keyword, and how many there are."""
    hits = t.documents.where(F.lower(F.concat_ws(" ", "text", "source")).contains("licensed")).select("doc_id")
    return K.paged(hits, [F.col("doc_id")], 1, 20).select("doc_id", "total")


@query("F02 F14 F19 F12", "SELECT p_partkey AS id FROM part WHERE (contains(lower(p_name), 'red') OR contains(lower(p_brand), '#1') OR contains(lower(p_type), 'tin')) AND p_size IN (1, 5, 7, 20, 30, 49)")
def multi_field_filter(t: Tables):
    hit = F.lit(False)
    for c, q in (("p_name", "red"), ("p_brand", "#1"), ("p_type", "tin")):
        hit = hit | F.lower(c).contains(q)
    return t.part.where(hit & F.col("p_size").isin(1, 5, 7, 20, 30, 49)).select(F.col("p_partkey").alias("id"))


@query("F03", "SELECT o_orderkey AS id FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-31' AND DATE '1995-12-01'")
def date_range_filter(t: Tables):
    """Both ends included; ends that aren't real dates would give none."""
    lo, hi = S.iso_date(F.lit("1995-01-31")), S.iso_date(F.lit("1995-12-01"))
    return t.orders.where(F.to_date("o_orderdate").between(lo, hi) & (lo <= hi)).select(F.col("o_orderkey").alias("id"))


@query("X01 C01 O01", f"WITH d AS (SELECT doc_id, lower({_md('text')}) AS body, lower(source) AS src FROM documents), s AS (SELECT doc_id, {_relevance('that the', [('body', 3), ('src', 1)])} AS score FROM d) SELECT * FROM s WHERE score > 0")
def text_relevance(t: Tables):
    """Relevance of every document to a phrase of two terms."""
    d = t.documents.select("doc_id", X.search_text(F.col("text")).alias("body"), F.lower("source").alias("src"))
    return X.scored(d, X.relevance("that the", [(F.col("body"), 3), (F.col("src"), 1)])).where("score > 0").select("doc_id", "score")


@query("X02 X03 C12", "SELECT doc_id, CAST((length(lower(text)) - length(replace(lower(text), 'the', ''))) // 3 * 4 + (length(lower(text)) - length(replace(lower(text), 'of', ''))) // 2 * 4 + (length(source) - length(replace(source, 'of', ''))) // 2 * 12 AS BIGINT) AS score FROM documents")
def tf_relevance(t: Tables):
    own = t.documents.select("doc_id", "text", "source")
    return own.select("doc_id", (X.term_score(["the", "of"], [(F.col("text"), 4)]) + X.term_score(["of"], [(F.col("source"), 12)])).alias("score"))


@query("X04", "SELECT p_partkey AS id, least(CASE WHEN contains(lower(p_name), 'red') THEN length(p_name) - 3 END, CASE WHEN contains(lower(p_type), 'red') THEN length(p_type) - 3 END, CASE WHEN lower(p_name) = 'red' THEN -100 END) AS distance FROM part")
def alias_distance(t: Tables):
    return t.part.select(F.col("p_partkey").alias("id"), X.alias_distance(F.array("p_name", "p_type"), "red").cast("long").alias("distance"))


@query("R12 X01", f"""WITH u AS (SELECT 'document' AS kind, CAST(doc_id AS VARCHAR) AS id, lower({_md('text')}) AS body FROM documents UNION ALL
SELECT 'turn', conv_id || '/' || turn, lower({_md('text')}) FROM conversations UNION ALL SELECT 'part', CAST(p_partkey AS VARCHAR), lower({_md("p_name || ' ' || p_type")}) FROM part),
s AS (SELECT kind, id, {_relevance('the', [('body', 2)])} AS score FROM u) SELECT * FROM s WHERE score > 0""")
def unified_search(t: Tables):
    """One scoring pass over documents, turns and parts."""
    d = t.documents.select(F.lit("document").alias("kind"), F.col("doc_id").cast("string").alias("id"), "text")
    c = t.conversations.select(F.lit("turn").alias("kind"), F.concat(F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")).alias("id"), "text")
    p = t.part.select(F.lit("part").alias("kind"), F.col("p_partkey").cast("string").alias("id"), F.concat_ws(" ", "p_name", "p_type").alias("text"))
    u = d.unionByName(c).unionByName(p).select("kind", "id", X.search_text(F.col("text")).alias("body"))
    return X.scored(u, X.relevance("the", [(F.col("body"), 2)])).where("score > 0").select("kind", "id", "score")


@query("C01", f"SELECT doc_id, md5({_md('text')}) AS mark, length({_md('text')}) AS chars FROM documents")
def markdown_strip(t: Tables):
    c = S.strip_markdown(F.col("text"))
    return t.documents.select("doc_id", F.md5(F.encode(c, "UTF-8")).alias("mark"), F.length(c).cast("long").alias("chars"))


_HTML = "regexp_replace(html, '<[^>]+>', '', 'g')"
for _n, _to in S.ENTITIES.items():
    _HTML = f"regexp_replace({_HTML}, '(?i){_n}', '{_to.replace(chr(39), chr(39) * 2)}', 'g')"
_HTML = f"trim(regexp_replace({_HTML}, '\\s+', ' ', 'g'))"


@query("C02", f"SELECT page_id, md5({_HTML}) AS mark, length({_HTML}) AS chars FROM pages")
def html_text(t: Tables):
    c = S.html_text(F.col("html"))
    return t.pages.select("page_id", F.md5(F.encode(c, "UTF-8")).alias("mark"), F.length(c).cast("long").alias("chars"))


@query("S16 C06", "SELECT page_id, CAST(unnest(range(1, len(a) + 1)) AS INT) AS n, unnest(a) AS href FROM (SELECT page_id, regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1) AS a FROM pages)")
def html_links(t: Tables):
    """Links of pages in order."""
    return html.links(t.pages, "page_id", "html")


@query("S33", "SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title, regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) AS lang, CAST(len(regexp_extract_all(html, '(?i)<p[ >]')) AS INT) AS paragraphs FROM pages")
def html_profile(t: Tables):
    return html.profile(t.pages, "page_id", "html")


@query("C05", r"""SELECT doc_id, coalesce(array_to_string(list_sort(list_distinct(regexp_extract_all(text, '(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}'))), ','), '') AS emails,
coalesce(array_to_string(list_sort(list_distinct(regexp_extract_all(text, '\d{3}-\d{3,4}-\d{4}(?:-\d)?|\d{8,11}'))), ','), '') AS phones FROM documents""")
def contact_extract(t: Tables):
    return t.documents.select("doc_id", F.array_join(F.array_sort(S.emails(F.col("text"))), ",").alias("emails"), F.array_join(F.array_sort(S.phones(F.col("text"))), ",").alias("phones"))


_LINES = "l AS (SELECT doc_id, unnest(range(1, len(a) + 1)) AS n, unnest(a) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents))"


@query("W05 S19", f"WITH {_LINES}, h AS (SELECT doc_id, n, last_value(CASE WHEN length(line) < 60 THEN md5(line) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heading FROM l) SELECT doc_id, CAST(n AS INT) AS n, heading FROM h")
def carry_forward_heading(t: Tables):
    """Short lines as headings, carried to the lines below."""
    own = markdown.lines(t.documents.select("doc_id", "text"), "text")
    return markdown.carry(own, ["doc_id"], F.when(F.length("line") < 60, F.md5(F.encode("line", "UTF-8")))).select("doc_id", "n", F.col("carried").alias("heading"))


@query("S22", f"WITH {_LINES}, b AS (SELECT doc_id, n, line, CAST(sum(CASE WHEN length(line) >= 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS block FROM l) SELECT doc_id, block, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars FROM b GROUP BY ALL")
def bullet_blocks(t: Tables):
    """Lines grouped by the long line that opens each block."""
    own = markdown.lines(t.documents.select("doc_id", "text"), "text")
    blocks = markdown.blocks(own, ["doc_id"], F.length("line") >= 100)
    return blocks.groupBy("doc_id", "block").agg(F.count("*").alias("lines"), F.sum(F.length("line").cast("long")).alias("chars"))


_SECTION = "'# Part ' || doc_id || chr(10) || '## ' || source || chr(10) || 'body' || chr(10) || '### ' || lang || chr(10) || 'more' || chr(10) || '## end' || chr(10) || 'x'"


@query("S21", "SELECT n_nationkey AS id, n_name AS name, CAST(n_regionkey AS VARCHAR) AS region FROM nation")
def pipe_table(t: Tables):
    """Rows of a Markdown table built from the nations; rows of another width go."""
    row = F.concat(F.lit("| "), F.col("n_nationkey").cast("string"), F.lit(" | "), "n_name", F.lit(" | "), F.col("n_regionkey").cast("string"), F.lit(" |"))
    text = t.nation.agg(F.concat(F.lit("| id | name | region |\n|---|---|---|\n| short | row |\n"), F.array_join(F.array_sort(F.collect_list(row)), "\n")).alias("md"))
    return markdown.table(text, "md", ["id", "name", "region"]).select(F.col("id").cast("int").alias("id"), "name", "region")


@query("S23", "SELECT CASE WHEN contains(event_type, 'click') THEN 'input' WHEN contains(event_type, 'error') THEN 'failure' ELSE 'other' END AS kind, count(*) AS k FROM events GROUP BY 1")
def log_lines(t: Tables):
    """Events written as log lines and parsed again."""
    line = F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("app[1]:"), F.col("event_type"), F.concat(F.lit("user="), F.col("user_id").cast("string")))
    parsed = markdown.log_lines(t.events.select(line.alias("line")), "line", {"input": "click", "failure": "error"})
    return parsed.groupBy("kind").agg(F.count("*").alias("k"))


@query("S15 P14", "SELECT s_suppkey AS id, s_name AS name, CAST(s_suppkey % 90 AS DOUBLE) AS lat, CAST(s_suppkey % 180 AS DOUBLE) AS lng FROM supplier")
def geojson_scan(t: Tables):
    """Suppliers as GeoJSON features, read back."""
    feature = F.to_json(F.struct(F.struct(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")).alias("properties"), F.struct(F.array((F.col("s_suppkey") % 180).cast("double"), (F.col("s_suppkey") % 90).cast("double")).alias("coordinates")).alias("geometry")))
    return html.geojson(t.supplier.select(F.concat(F.lit('{"features":['), feature, F.lit("]}")).alias("body")), "body").select("id", "name", "lat", "lng")


@query("G05 Y08 P09", "SELECT event_id AS id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(t: Tables):
    props = F.from_json("props", "map<string,string>")
    return t.events.select(F.col("event_id").alias("id"), F.try_element_at(S.number_map(props), F.lit("k")).cast("long").alias("k"))


@query("G01 G02 K01", """SELECT o_orderkey AS id, sha256('{"cust":' || o_custkey || ',"key":' || o_orderkey || ',"status":"' || o_orderstatus || '"}') AS digest FROM orders""")
def canonical_digest(t: Tables):
    c = S.canonical(("key", F.col("o_orderkey")), ("status", F.col("o_orderstatus")), ("cust", F.col("o_custkey")), ("none", F.lit(None).cast("string")))
    return t.orders.select(F.col("o_orderkey").alias("id"), S.digest(F.encode(c, "UTF-8")).alias("digest"))


@query("C04 C09 C10 C14 C15", r"""SELECT p_partkey AS id, 'part:' || regexp_replace(regexp_replace(lower(trim(p_name)), '\s+', '-', 'g'), '[^\pL\pN-]', '', 'g') AS slug, upper(regexp_replace(p_brand, '[\s_-]+', '', 'g')) AS code,
CASE WHEN p_size % 3 = 0 THEN 'lab' WHEN p_size % 3 = 1 THEN 'lecture' ELSE 'other' END AS kind, 'token=[REDACTED] for ' || p_name AS message FROM part""")
def text_codes(t: Tables):
    """Slugs, plain codes, component types and redacted messages."""
    kind = F.when(F.col("p_size") % 3 == 0, F.lit("Physics Lab")).when(F.col("p_size") % 3 == 1, F.lit("理论课")).otherwise(F.lit("seminar"))
    return t.part.select(F.col("p_partkey").alias("id"), S.slug("part", F.col("p_name")).alias("slug"), S.plain_code(F.col("p_brand")).alias("code"), S.component_type(kind).alias("kind"), S.redact(F.concat(F.lit("token=abc"), F.col("p_size").cast("string"), F.lit(" for "), F.col("p_name"))).alias("message"))


@query("Y01 Y02 M03 M04", """SELECT o_orderkey AS id, array_to_string(list_sort(list_distinct(list_concat(generate_series(1 + o_orderkey % 4, 8 + o_orderkey % 4), [10 + o_orderkey % 3]))), ',') AS weeks,
array_to_string(list_filter(generate_series(1, 6), lambda x: (o_orderkey // (1 << (x - 1))) % 2 = 1), ',') AS bits, o_orderkey % 4 IN (1, 3) AS low, CASE WHEN o_orderkey % 20 BETWEEN 1 AND 13 THEN o_orderkey % 20 ELSE 2 END AS bounded FROM orders""")
def week_lists(t: Tables):
    """Week lists and bitmaps as text, expanded."""
    k = F.col("o_orderkey")
    text = F.concat((8 + k % 4).cast("string"), F.lit("-"), (1 + k % 4).cast("string"), F.lit(","), (10 + k % 3).cast("string"))
    bits = F.concat(F.lit("1"), F.reverse(F.lpad(F.bin(k % 64), 6, "0")))
    return t.orders.select(k.alias("id"), F.array_join(S.weeks_of(text), ",").alias("weeks"), F.array_join(S.bitmap_weeks(bits), ",").alias("bits"), S.flag(k, 1).alias("low"), S.bounded_int(k % 20, 2, 1, 13).alias("bounded"))
