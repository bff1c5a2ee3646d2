"""Deduplication, keep-best, set operations and conditional joins on keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    """[R02, R03, R04, W03, W04, W10] The first row of each key by an explicit order."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__n", n).where("__n = 1").drop("__n")


def merge_union(parts: list[DataFrame], key: str, merge: str, order: str) -> DataFrame:
    """[R01] All rows by key: the first one's columns, the array column merged in order, without repeats."""
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    first = [F.min_by(c, order).alias(c) for c in df.columns if c not in (key, merge, order)]
    merged = F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct(order, merge))), lambda x: x[merge])))
    return df.groupBy(key).agg(*first, merged.alias(merge))


def distinct_structs(items: str | Column, fields: list[str]) -> Column:
    """[R08] An array of structs in its order, of those equal in the fields the first."""
    items = F.col(items) if isinstance(items, str) else items
    key = lambda x: F.struct(*[x[f] for f in fields])
    once = F.array_distinct(F.transform(items, key))
    return F.transform(once, lambda k: F.get(F.filter(items, lambda x: key(x).eqNullSafe(k)), F.lit(0)))


def prepend(df: DataFrame, exact: DataFrame, key: str, order: str) -> DataFrame:
    """[R05] The exact candidates first, then the others, without repeats of the key."""
    both = exact.withColumn("__p", F.lit(0)).unionByName(df.withColumn("__p", F.lit(1)))
    return keep_one(both, [key], [F.col("__p"), F.col(order)]).drop("__p")


def code_else_name(left: DataFrame, right: DataFrame, code: str, name: str, key: str, ambiguous: DataFrame | None = None) -> DataFrame:
    """[J13, J14] The pairs of left and right (its key as matched_key) that match by code, or by name where either has no
    code; matched_by tells which. A name in ambiguous (column name), or shared by several right rows, matches nothing.

    Codes are compared in upper case and names in lower case, both without blanks. Two equi-joins instead of an OR in one.
    """
    plain = lambda c, case: case(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"\s+", ""))
    own = left.withColumns({"__code": plain(code, F.upper), "__name": plain(name, F.lower)})
    r = right.select(plain(code, F.upper).alias("__c"), plain(name, F.lower).alias("__m"), F.col(key).alias("matched_key"))
    doubtful = r.where("__m <> ''").groupBy("__m").agg(F.count("*").alias("k")).where("k > 1").select("__m")
    if ambiguous is not None:
        doubtful = doubtful.unionByName(ambiguous.select(plain("name", F.lower).alias("__m"))).distinct()
    by_code = own.where("__code <> ''").join(r.where("__c <> ''").drop("__m"), F.col("__code") == F.col("__c")).drop("__c").withColumn("matched_by", F.lit("code"))
    named = r.where("__m <> ''").join(doubtful, "__m", "left_anti")
    by_name = own.join(named, F.col("__name") == F.col("__m")).where("__code = '' or __c = ''").drop("__c", "__m").withColumn("matched_by", F.lit("name"))
    return by_code.unionByName(by_name).drop("__code", "__name")


def paged(df: DataFrame, order: list[Column], page: int, size: int) -> DataFrame:
    """[O08, O09, F01, S35, S36, T09] A page with the total and whether there is more."""
    if not 1 <= size <= 200:
        raise ValueError("page sizes are 1 to 200")
    total = df.agg(F.count("*").alias("total"))  # one row
    rows = df.orderBy(*order).offset((page - 1) * size).limit(size)
    return rows.join(F.broadcast(total), F.lit(True)).withColumn("has_more", F.col("total") > page * size)


def sole(df: DataFrame, keys: list[str]) -> DataFrame:
    """By key: how many rows there are, and found for one or ambiguous for more; absent keys have no row."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), F.when(F.count("*") == 1, "found").otherwise("ambiguous").alias("outcome"))


def where_equal(df: DataFrame, wanted: dict) -> DataFrame:
    """[S36, F12] Rows whose columns have the values asked for; those that are None don't matter."""
    for name, value in wanted.items():
        if value is not None:
            df = df.where(F.col(name) == value)
    return df


def in_status(code: Column, status: str, groups: dict[str, list[str]]) -> Column:
    """Whether a code belongs to a status that stands for several; all takes any."""
    if status == "all":
        return F.lit(True)
    if status not in groups:
        raise ValueError(f"no status {status}")
    return code.isin(groups[status])


def timing(at: Column, now: Column) -> Column:
    """[F08, O06] upcoming, started (also just now) or unknown."""
    return F.when(at.isNull(), "unknown").when(at > now, "upcoming").otherwise("started")


def preferred_first(df: DataFrame, key: str, preferred, order: list[Column]) -> DataFrame:
    """[O16] place: rows of the preferred key first, and either part in the given order."""
    return df.withColumn("place", F.row_number().over(Window.orderBy(F.when(F.col(key) == preferred, 0).otherwise(1), *order)).cast("long"))


def by_locale(c: str | Column, locale: str = "zh") -> Column:
    """[O11, O15] The order in which a reader of the language expects names."""
    return F.collate(c, locale)


def version_parts(c: Column) -> Column:
    """[O17] The numbers of a version (a leading v and what follows - or + don't count), three at least: arrays compare as
    versions do."""
    numbers = F.transform(F.split(F.regexp_replace(F.regexp_replace(F.trim(c), r"^[vV]", ""), r"[-+].*$", ""), r"\."), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))
    return F.concat(numbers, F.array_repeat(F.lit(0), F.greatest(3 - F.size(numbers), F.lit(0))))


def sort_by(df: DataFrame, spec: str, allowed: dict[str, list[Column]]) -> list[Column]:
    """[O07, O12, O15] FIELD or FIELD(desc) with a list of allowed fields."""
    name, _, direction = spec.partition("(")
    if name not in allowed or direction not in ("", "desc)", "asc)"):
        raise ValueError(f"can't sort by {spec}")
    columns = [F.col(c) if isinstance(c, str) else c for c in allowed[name]]
    return [c.desc_nulls_last() if direction == "desc)" else c.asc_nulls_last() for c in columns[:1]] + columns[1:]
