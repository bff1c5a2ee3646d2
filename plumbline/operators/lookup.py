"""Lookups of names, codes and records: exact first, then what is near, with how sure it is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.scalars import plain_code
from plumbline.functions.staging import checked_broadcast, materialise
from plumbline.operators.rank import lookup_confidence


def resolve(asked: DataFrame, names: DataFrame) -> DataFrame:
    """asked (query) with code, matches and status: the name (code, label) whose code or label is the query, else
    those that hold it, by any case; one is found, more are ambiguous, none is missing. names are one catalog: broadcast."""
    q, label = F.lower(F.trim("query")), F.lower("label")
    exact = (F.lower("code") == q) | (label == q)
    met = asked.select("query").distinct().join(F.broadcast(names.select("code", "label").distinct()), exact | label.contains(q))
    best = met.groupBy("query", F.when(exact, 0).otherwise(1).alias("rank")).agg(F.count("*").alias("matches"), F.min("code").alias("code"))
    best = best.groupBy("query").agg(F.min_by(F.struct("matches", "code"), "rank").alias("x"))
    n = F.coalesce("x.matches", F.lit(0))
    return asked.join(best, "query", "left").select(*asked.columns, F.when(n == 1, F.col("x.code")).alias("code"), n.alias("matches"), F.when(n == 0, "missing").when(n == 1, "found").otherwise("ambiguous").alias("status"))


def cascade(asked: DataFrame, records: DataFrame, complete: bool = True) -> DataFrame:
    """[F16, F20] asked (query) with record, by and status. A record (id, path, title) is found by its id, else by its path,
    else by its title if no other has it; else it is ambiguous, or missing (incomplete if sources are missing). Three joins
    by equal keys."""
    q = asked.select(F.trim("query").alias("q")).distinct()
    steps = []
    for rank, by in enumerate(("id", "path", "title")):
        met = q.join(records.select(F.col(by).alias("q"), F.col("id").alias("record")), "q")
        steps.append(met.groupBy("q").agg(F.min("record").alias("record"), F.count("*").alias("k")).select("q", "record", "k", F.lit(rank).alias("rank"), F.lit(by).alias("by")))
    every = steps[0].unionByName(steps[1]).unionByName(steps[2])
    best = every.groupBy("q").agg(F.min_by(F.struct("record", "k", "by"), "rank").alias("x"))
    out = asked.join(best, F.trim(asked["query"]) == best["q"], "left")
    unclear = (F.col("x.by") == "title") & (F.col("x.k") > 1)
    status = F.when(F.col("x").isNull(), "missing" if complete else "incomplete").when(unclear, "ambiguous").otherwise("found")
    return out.select(*[asked[c] for c in asked.columns], F.when(status == "found", F.col("x.record")).alias("record"), F.col("x.by").alias("by"), status.alias("status"))


def plain_title(c: str) -> Column:
    """As names are compared: lower case, without white space, separators and brackets."""
    return F.lower(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"[\s·•（）()\-—_/]+", ""))


def bases_of(code: Column) -> Column:
    """All codes that a code extends by something that begins with a letter and goes on with letters and digits."""
    ends = F.sequence(F.lit(1), F.greatest(F.length(code) - 1, F.lit(1)))
    return F.transform(F.filter(ends, lambda i: F.substr(code, i + 1).rlike("^[A-Z][A-Z0-9]*$")), lambda i: F.substr(code, F.lit(1), i))


def match_courses(lookups: DataFrame, candidates: DataFrame) -> DataFrame:
    """[J26, J27, X12, X13] lookups (q, code, name, teachers, term) with the best candidate (id, code, name, teachers, terms,
    reviews, rating, url): picked, matches, confidence, status.

    A candidate matches by code, by base code (its code goes on from the lookup's with a letter) or by name; three joins by
    equal keys. Best by: code, base code, name, teachers in common, term, reviews, rating, id, url; one with a teacher in
    common goes before all others. Lookups that ask the same are answered once, and only the count and the best of an
    answer are kept, so that what is made follows the different questions and not the lookups.
    """
    ask = F.struct(plain_code(F.coalesce("code", F.lit(""))).alias("code"), plain_title("name").alias("name"), "teachers", "term")
    asked = lookups.where("q is not null").groupBy("q").agg(F.sort_array(F.collect_set(ask)).alias("asks"))
    # Numbered as written, so that a question keeps its number.
    questions = materialise(asked.select("asks").distinct().withColumn("question", F.monotonically_increasing_id()), "questions")
    own = checked_broadcast(questions.select("question", F.inline("asks")))
    cand = candidates.select("id", plain_code(F.coalesce("code", F.lit(""))).alias("c_code"), plain_title("name").alias("c_name"), F.col("teachers").alias("c_teachers"), "terms", "reviews", "rating", "url")
    extended = cand.withColumn("base", F.explode(bases_of(F.col("c_code"))))
    by = lambda a, side, b: side.join(own.where(f"{a} <> ''"), F.col(a) == F.col(b))
    met = by("code", cand, "c_code").unionByName(by("code", extended, "base").drop("base")).unionByName(by("name", cand, "c_name"))
    exact = (F.col("code") != "") & (F.col("code") == F.col("c_code"))
    rest = F.substr("c_code", F.length("code") + 1)
    base = (F.col("code") != "") & ~exact & F.col("c_code").startswith(F.col("code")) & rest.rlike("^[A-Z][A-Z0-9]*$")
    near = lambda t: F.exists(F.coalesce("c_teachers", F.array().cast("array<string>")), lambda c: (t == c) | t.contains(c) | c.contains(t))
    shared = F.size(F.filter(F.coalesce("teachers", F.array().cast("array<string>")), near))
    met = met.select("question", "id", "url", "reviews", "rating", exact.alias("exact"), base.alias("base"), ((F.col("name") != "") & (F.col("name") == F.col("c_name"))).alias("named"), shared.alias("shared"), F.coalesce(F.array_contains("terms", F.col("term")), F.lit(False)).alias("in_term"))
    rating = F.coalesce(F.col("rating").cast("double"), F.lit(-1.0))
    # The least is the best: what goes down is turned round (NaN is the largest rating).
    place = F.struct((F.col("shared") <= 0).alias("x"), *[(~F.col(c)).alias(f"not_{c}") for c in ("exact", "base", "named")], (-F.col("shared")).alias("less"), (~F.col("in_term")).alias("not_in_term"), (-F.coalesce("reviews", F.lit(0))).alias("reviews"), (~F.isnan(rating)).alias("rated"), (-F.nanvl(rating, F.lit(0.0))).alias("rating"), "id", "url", "shared")
    each = met.groupBy("question", "id", "url").agg(F.min(place).alias("x"))
    best = each.groupBy("question").agg(F.count("*").alias("matches"), F.min("x").alias("x"))
    sure = lookup_confidence(~F.col("x.not_exact"), ~F.col("x.not_base"), ~F.col("x.not_named"), F.col("x.shared"), ~F.col("x.not_in_term"), F.col("matches"))
    best = best.select("question", F.col("x.id").alias("picked"), "matches", sure.alias("confidence")).join(questions, "question").join(asked, "asks").select("q", "picked", "matches", "confidence")
    status = F.when(F.col("picked").isNull(), "not_found").when((F.col("confidence") == "low") & (F.col("matches") > 1), "ambiguous").otherwise("matched")
    return lookups.select("q").join(best, "q", "left").select("q", "picked", F.coalesce("matches", F.lit(0)).alias("matches"), F.coalesce("confidence", F.lit("none")).alias("confidence"), status.alias("status"))


def by_selectors(rows: DataFrame, selectors: DataFrame, on: Column, key: str, order: str) -> tuple[DataFrame, DataFrame]:
    """[J15, W10] rows that a selector (pos, selector) fits, once by key, at the first selector that does; and the selectors
    that fit nothing. Selectors are what one person asks for: broadcast."""
    met = rows.join(F.broadcast(selectors), on)
    first = met.groupBy(key).agg(F.min(F.struct("pos", order)).alias("at")).select(key, F.col("at.pos").alias("pos"))
    hit = met.select("pos").distinct()
    return first, selectors.join(F.broadcast(hit), "pos", "left_anti")


def live_state(tasks: DataFrame, available: DataFrame, enrolled: DataFrame, cart: DataFrame, fields: list[str]) -> DataFrame:
    """[J35] tasks (task, fields) with the fields of the live row, if it has them: the available one's, else the enrolled
    one's, else the cart's; and where that came from."""
    out = tasks
    places = {"available": available, "enrolled": enrolled, "cart": cart}
    for name, side in places.items():
        one = side.groupBy("task").agg(*[F.min(f).alias(f) for f in fields])
        out = out.join(one.select("task", F.struct(*fields).alias(f"__{name}")), "task", "left")
    origin = F.coalesce(*[F.when(F.col(f"__{name}").isNotNull(), name) for name in places])
    live = F.coalesce(*[F.col(f"__{name}") for name in places])
    return out.select("task", *[F.coalesce(F.nullif(live[f], F.lit("")), F.col(f)).alias(f) for f in fields], origin.alias("live"))


def preferred_source(routes: DataFrame, kind: str = "bus") -> DataFrame:
    """[J41, P15] routes (line, route, sources of url and type) with url: of the first source of the kind, else of the first;
    line_code and direction by the last source whose url tells them."""
    own = F.filter("sources", lambda s: s["type"] == kind)
    url = F.coalesce(F.get(own, F.lit(0))["url"], F.get("sources", F.lit(0))["url"])
    # Parts of urls, codes and directions.
    down = lambda s: s["url"].contains("one_") | s["url"].contains("short_down")
    up = lambda s: s["url"].contains("two_") | s["url"].contains("short_up")
    told = F.transform(F.filter("sources", lambda s: down(s) | up(s)), lambda s: F.when(down(s), 0).otherwise(1))
    last = F.get(told, F.size(told) - 1)
    return routes.select("line", "route", url.alias("url"), F.when(last == 0, "XYBS1").when(last == 1, "XYBS2").otherwise("").alias("line_code"), F.coalesce(last, F.lit(0)).alias("direction"))
