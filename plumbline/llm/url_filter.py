"""URL filters: allow and block rules as intervals of canonical keys, swept in sorted order.

A rule is two prefixes: of the host read backwards (``com.example.``: the host and all its subdomains) and of the path.
Either is the interval of the keys that begin with it, from its own bytes to the same followed by 0xFF, which is in no
UTF-8 text; so all ends differ, and intervals are nested or apart. A sweep over sorted ends keeps a stack of what is open:
the depth after each end is a running sum, and the top of the stack is the last interval opened at that depth. A second
pass over ends and keys together carries the top forward to the keys.

Hosts are swept first, over the intervals of the rules' hosts by top domain: the top tells the innermost rule host of each
distinct host, and the others open are those that enclose it. Then, for each rule host, the paths of the urls inside are
swept over the intervals of its rules' paths. Of the tops that a url meets, the longest rule wins.

Keys of one group are dealt over tasks, of which each gets the ends: a task has four times as many keys as ends at least, so
dealing adds a quarter of the keys at most. The ends of one group (the rule hosts of a top domain, the rules of one host)
are sorted by one task.

Defined results: a null url, or one without ``://``, has an empty host and path and gets the default verdict; repeated
rows stay; of equal rules block wins; of two fitting rules with equally long strings the one with the longer host wins;
an empty table gives an empty table; columns named like the results are replaced by them, and all others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import checked_broadcast, fresh, literal_rows, materialise, named, others

#: Keys that a task sweeps at least, and as a multiple of the ends.
SWEEP_KEYS, SWEEP_RATIO = 1000, 4
RESULTS = ("host", "path", "rule", "verdict")
#: Rows with urls up to which a side is broadcast (a few MB).
TEXT_ROWS = 20_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = _rest(url)
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_key(host: Column) -> Column:
    """``com.example.`` for example.com."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def top_domain(key: Column) -> Column:
    return F.substring_index(key, ".", 1)


def interval_ends(prefixes: DataFrame) -> DataFrame:
    """group, key, top: what is innermost from this key on, or null where nothing is open. prefixes: group, prefix, is."""
    begin = F.col("prefix").cast("binary")
    both = F.array(F.struct(begin.alias("key"), F.lit(1).alias("step")), F.struct(F.concat(begin, F.unhex(F.lit("FF"))).alias("key"), F.lit(-1).alias("step")))
    ends = prefixes.select("group", "is", F.inline(both))
    sweep = Window.partitionBy("group").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.withColumn("depth", F.sum("step").over(sweep))
    stack = Window.partitionBy("group", "depth").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    top = F.last(F.when(F.col("step") > 0, F.col("is")), ignorenulls=True).over(stack)
    return ends.select("group", "key", F.when(F.col("depth") > 0, top).alias("top"))


def innermost(keys: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The rows of keys (group, key, of) that lie in an interval of their group, with the innermost: of, top."""
    ends = materialise(interval_ends(prefixes), "ends")
    sizes = ends.groupBy("group").agg(F.count("*").alias("ends"))
    sizes = keys.groupBy("group").agg(F.count("*").alias("keys")).join(checked_broadcast(materialise(sizes, "sizes")), "group")
    parts = sizes.select("group", (F.floor(F.col("keys") / F.greatest(F.lit(SWEEP_KEYS), SWEEP_RATIO * F.col("ends"))) + 1).cast("int").alias("parts"))
    parts = materialise(parts, "parts")
    dealt = ends.join(checked_broadcast(parts), "group").select("group", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "key", F.struct("top").alias("open"), F.lit(None).cast(keys.schema["of"].dataType).alias("of"))
    points = keys.join(checked_broadcast(parts), "group").select("group", F.pmod(F.xxhash64("of"), F.col("parts")).cast("int").alias("part"), F.col("key").cast("binary").alias("key"), F.lit(None).cast(dealt.schema["open"].dataType).alias("open"), "of")
    sweep = Window.partitionBy("group", "part").orderBy("key", F.col("of").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    swept = dealt.unionByName(points).withColumn("open", F.last("open", ignorenulls=True).over(sweep))
    return swept.where(F.col("of").isNotNull() & F.col("open.top").isNotNull()).select("of", "open.top")


def longest_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, top (size, host_size, rule, verdict) of the distinct urls (host, path) that a rule fits."""
    own = rules.select(F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.coalesce("verdict", F.lit("block")).alias("verdict"))
    own = own.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block sorts after allow
    rule = F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"), F.concat("host", "path").alias("rule"), "verdict")
    own = materialise(own.select(host_key(F.col("host")).alias("inside"), "path", rule.alias("is")), "rules")
    rule_hosts = materialise(own.select("inside").distinct(), "rule-hosts")

    key = host_key(F.col("host"))
    hosts = urls.select("host").distinct().select(top_domain(key).alias("group"), key.alias("key"), F.struct("host").alias("of"))
    found = innermost(hosts, rule_hosts.select(top_domain(F.col("inside")).alias("group"), F.col("inside").alias("prefix"), F.col("inside").alias("is")))
    names = F.split(F.expr("substr(top, 1, length(top) - 1)"), r"\.")
    around = F.transform(F.sequence(F.lit(1), F.size(names)), lambda k: F.concat(F.array_join(F.slice(names, F.lit(1), k), "."), F.lit(".")))
    open_ = found.select("top").distinct().select("top", F.explode(around).alias("inside")).join(checked_broadcast(rule_hosts), "inside", "left_semi")
    stacks = materialise(found.select("of.host", "top").join(checked_broadcast(materialise(open_, "open")), "top").select("host", "inside"), "stacks")

    paths = materialise(urls.join(checked_broadcast(stacks, TEXT_ROWS), "host").select(F.col("inside").alias("group"), F.col("path").alias("key"), F.struct("host", "path").alias("of")), "paths")
    tops = innermost(paths, own.select(F.col("inside").alias("group"), F.col("path").alias("prefix"), "is"))
    return tops.groupBy("of.host", "of.path").agg(F.max("top").alias("top"))


def url_filter(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """pages with host, path, rule (null if none fits) and verdict."""
    kept = pages.select(*others(pages, *RESULTS), F.coalesce(host_of(named(url)), F.lit("")).alias("host"), F.coalesce(path_of(named(url)), F.lit("")).alias("path"))
    (top,) = fresh(pages, "top")
    urls = materialise(kept.select("host", "path").distinct(), "urls")
    found = materialise(longest_rules(urls, rules).withColumnRenamed("top", top), "tops")
    out = kept.join(checked_broadcast(found, TEXT_ROWS), ["host", "path"], "left")
    return out.select(*others(kept, "host", "path"), "host", "path", F.col(f"{top}.rule").alias("rule"), F.coalesce(F.col(f"{top}.verdict"), F.lit(default)).alias("verdict"))


#: Fixed values of the production query.
RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = literal_rows(spark, RULES, ["host", "path", "verdict"])
    return url_filter(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = r"""
WITH r(host, path, verdict) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'),
  ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
u AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, url, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path, row_number() OVER () AS n FROM u),
f AS (SELECT p.n, r.host || r.path AS rule, r.verdict, row_number() OVER (PARTITION BY p.n ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS k
  FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM p LEFT JOIN f ON p.n = f.n AND f.k = 1
"""
