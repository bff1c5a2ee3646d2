r"""Chat formatting: conversations as one templated string each, with the spans that a loss counts.

Template: a turn is ``### Role: `` + text + ``</turn>\n``; adjacent turns of one role share a heading, with ``</part>``
between their texts. Turns are collected and sorted as structs, merged where the role stays the same, and joined into one
string, by array functions.  In texts and roles a backslash becomes ``\b``, ``#`` becomes ``\h``, ``</`` becomes ``\l/`` and, in
roles, ``:`` becomes ``\c``, so no text can hold a control string, and each escape reads back as one thing.

Defined results: rows are ordered by turn (nulls first), role and text; null texts and roles are empty; repeated rows are
turns of their own; rows with a null conversation id form one conversation; a table without rows gives none; other
columns, however named, are ignored. A conversation is one string, so one of more than 2 GB fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import let, literal_rows, named, table

HEAD, COLON, PART, END = "### ", ": ", "</part>", "</turn>\n"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    return F.replace(F.replace(text, F.lit("#"), F.lit("\\h")), F.lit("</"), F.lit("\\l/"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("\\l/"), F.lit("</")), F.lit("\\h"), F.lit("#"))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\c"), F.lit(":")))


def running(sizes: Column) -> Column:
    """The sum of all elements before each one, in stretches of sqrt(n), as an aggregate that appends copies its list."""

    def before(values: Column, start: Column) -> Column:
        none = F.array().cast("array<bigint>")
        step = lambda a, x: F.struct((a["total"] + x).alias("total"), F.concat(a["list"], F.array(a["total"])).alias("list"))
        return F.aggregate(values, F.struct(start.alias("total"), none.alias("list")), step)["list"]

    def in_stretches(width: Column) -> Column:
        stretches = F.transform(F.sequence(F.lit(0), F.ceil(F.size(sizes) / width).cast("int") - 1), lambda k: F.slice(sizes, k * width + 1, width))
        sums = lambda s: before(F.transform(s, lambda v: F.aggregate(v, F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0).cast("long"))
        return let(stretches, lambda s: let(sums(s), lambda begin: F.flatten(F.transform(s, lambda v, k: before(v, F.get(begin, k))))))

    return F.when(F.size(sizes) == 0, F.array().cast("array<bigint>")).otherwise(let(F.ceil(F.sqrt(F.size(sizes))).cast("int"), in_stretches))


def merged(turns: Column) -> Column:
    """role and texts of each stretch of adjacent turns of one role."""
    n = F.size(turns)
    begins = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))
    stretch = lambda at, b, k: F.slice(turns, b + 1, F.coalesce(F.get(at, k + 1), n) - b)
    return let(begins, lambda at: F.transform(at, lambda b, k: F.struct(F.get(turns, b)["role"].alias("role"), F.transform(stretch(at, b, k), lambda t: t["text"]).alias("texts"))))


def pieces(blocks: Column, learn: str) -> Column:
    """What is written for each turn: head, body and tail, and whether a loss counts the body."""

    def of(block: Column) -> Column:
        head = F.concat(F.lit(HEAD), escape_role(block["role"]), F.lit(COLON))
        last = F.size(block["texts"]) - 1
        return F.transform(block["texts"], lambda t, i: F.struct(F.when(i == 0, head).otherwise(PART).alias("head"), escape(t).alias("body"), F.when(i == last, END).otherwise("").alias("tail"), (block["role"] == learn).alias("learn")))

    return F.flatten(F.transform(blocks, of))


def format_chats(turns: DataFrame, learn: str = "assistant", conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, formatted, loss_spans (array of start and chars, in code points from 0) by conversation."""
    own = F.struct(named(turn).alias("turn"), F.coalesce(named(role), F.lit("")).alias("role"), F.coalesce(named(text), F.lit("")).alias("text"))
    chats = turns.select(named(conv_id).alias("conv_id"), own.alias("own")).groupBy("conv_id").agg(F.sort_array(F.collect_list("own")).alias("turns"))

    def spans(ps: Column, before: Column) -> Column:
        every = F.transform(ps, lambda p, i: F.struct((F.get(before, i) + F.length(p["head"])).alias("start"), F.length(p["body"]).cast("long").alias("chars"), p["learn"].alias("learn")))
        return F.transform(F.filter(every, lambda s: s["learn"]), lambda s: F.struct(s["start"].alias("start"), s["chars"].alias("chars")))

    def chat(ps: Column) -> Column:
        sizes = F.transform(ps, lambda p: (F.length(p["head"]) + F.length(p["body"]) + F.length(p["tail"])).cast("long"))
        formatted = F.array_join(F.transform(ps, lambda p: F.concat(p["head"], p["body"], p["tail"])), "")
        return F.struct(formatted.alias("formatted"), let(sizes, lambda n: let(running(n), lambda before: spans(ps, before))).alias("loss_spans"))

    return chats.select("conv_id", F.inline(F.array(let(merged(F.col("turns")), lambda blocks: let(pieces(blocks, learn), chat)))))


def read_chats(formatted: Column) -> Column:
    """The turns (role and text) that a formatted string holds."""
    blocks = F.filter(F.split(formatted, END), lambda b: b != "")

    def turns(block: Column) -> Column:
        colon = F.instr(block, COLON)
        role = unescape_role(F.substr(block, F.lit(len(HEAD) + 1), colon - len(HEAD) - 1))
        return F.transform(F.split(F.substr(block, colon + len(COLON)), PART), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["chars"].cast("int")))), "")


#: The fixed conversation of the production query.
EXTRA = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


def op7_format_chats(spark, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    chats = format_chats(turns.unionByName(literal_rows(spark, EXTRA, ["conv_id", "turn", "role", "text"])))
    read = chats.withColumn("turns", read_chats(F.col("formatted"))).withColumn("loss", read_loss(F.col("formatted"), F.col("loss_spans")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


_ESCAPED = r"replace(replace(replace(coalesce({0}, ''), '\', '\b'), '#', '\h'), '</', '\l/')"
OP7_SQL = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL
  VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
o AS (SELECT *, row_number() OVER w AS n, coalesce(lag(role) OVER w = role, false) AS more, coalesce(lead(role) OVER w = role, false) AS open
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY n)) AS loss_sha256,
  CAST(sum(CASE WHEN more THEN 7 ELSE 6 + length(replace({_ESCAPED.format('role')}, ':', '\c')) END
    + length({_ESCAPED.format('text')}) + CASE WHEN open THEN 0 ELSE 8 END) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id
"""
