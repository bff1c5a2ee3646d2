"""The driver's tables as meetings, grades and snapshots: each as a DataFrame and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import scalars as S
from plumbline.plans.catalog import Tables


def meetings(t: Tables) -> DataFrame:
    """section, code, day, ps, pe, weeks, room, campus."""
    k = F.col("o_orderkey")
    ps = (F.floor(k / 5) % 9 + 1).cast("int")
    return t.orders.select(
        k.alias("section"), F.col("o_custkey").alias("code"), (k % 5 + 1).cast("int").alias("day"), ps.alias("ps"), (ps + k % 2).cast("int").alias("pe"),
        F.sequence((1 + k % 3).cast("int"), F.lit(16), (1 + k % 2).cast("int")).alias("weeks"), (F.col("o_custkey") % 200).cast("int").alias("room"), F.col("o_orderstatus").alias("campus"),
    )


def meetings_sql(where: str = "true") -> str:
    return f"""meetings AS (SELECT * FROM (SELECT o_orderkey AS section, o_custkey AS code, CAST(o_orderkey % 5 + 1 AS INT) AS day, CAST((o_orderkey // 5) % 9 + 1 AS INT) AS ps,
  CAST((o_orderkey // 5) % 9 + 1 + o_orderkey % 2 AS INT) AS pe, generate_series(1 + o_orderkey % 3, 16, 1 + o_orderkey % 2) AS wks,
  CAST(o_custkey % 200 AS INT) AS room, o_orderstatus AS campus FROM orders) WHERE {where}),
slots AS (SELECT * EXCLUDE (wks), CAST(unnest(wks) AS INT) AS week FROM meetings)"""


MEETINGS = meetings_sql()


def grades(t: Tables) -> DataFrame:
    """grade_id, student, code, credits, score, semester, nature."""
    k = F.col("o_orderkey")
    return t.orders.select(
        k.alias("grade_id"), F.col("o_custkey").alias("student"), (k % 50).cast("int").alias("code"), (k % 5).cast("int").alias("credits"),
        (k * 7 % 101).cast("double").alias("score"), F.year("o_orderdate").alias("semester"), F.col("o_orderpriority").alias("nature"),
    )


GRADES = """grades AS (SELECT o_orderkey AS grade_id, o_custkey AS student, CAST(o_orderkey % 50 AS INT) AS code, CAST(o_orderkey % 5 AS INT) AS credits,
  CAST(o_orderkey * 7 % 101 AS DOUBLE) AS score, CAST(year(o_orderdate) AS INT) AS semester, o_orderpriority AS nature FROM orders)"""
#: Points in thousandths by score.
POINTS = """CASE WHEN score >= 90 THEN 4000 WHEN score >= 85 THEN 3700 WHEN score >= 80 THEN 3300 WHEN score >= 77 THEN 3000 WHEN score >= 73 THEN 2700
  WHEN score >= 70 THEN 2300 WHEN score >= 67 THEN 2000 WHEN score >= 63 THEN 1700 WHEN score >= 60 THEN 1000 END"""


_LETTERS = ["A+", "b", "P", " fail ", "W", "??", ""]


def transcript(t: Tables) -> DataFrame:
    """Grades as a service sends them: some without a code, some with a letter and no score.

    grade_id, student, code, name, department, nature, letter, score, credits, semester, points.
    """
    k = F.col("o_orderkey")
    letter = F.get(F.array(*[F.lit(x) for x in _LETTERS]), (k % len(_LETTERS)).cast("int"))
    score = F.when(k % 3 != 0, (k * 7 % 101).cast("double"))
    code = F.when(k % 13 == 0, F.lit(" ")).otherwise(F.concat(F.when(k % 2 == 0, "CS").otherwise("ma"), (k % 50).cast("string")))
    return t.orders.select(
        k.alias("grade_id"), F.col("o_custkey").alias("student"), code.alias("code"), F.concat(F.lit("Course "), (k % 25).cast("string")).alias("name"), F.col("o_orderstatus").alias("department"), F.col("o_orderpriority").alias("nature"),
        letter.alias("letter"), score.alias("score"), ((k % 5) * 0.5).cast("double").alias("credits"), F.concat(F.year("o_orderdate").cast("string"), F.lit("-"), (k % 2 + 1).cast("string")).alias("semester"), S.letter_points(letter, score).alias("points"),
    )


_LETTER_CASE = "CASE upper(letter) " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in S.LETTER_POINTS.items()) + " END"
_SCORE_CASE = "CASE " + " ".join(f"WHEN score >= {low} THEN {points}" for low, points in S.SCORE_POINTS) + " END"
TRANSCRIPT = f"""raw AS (SELECT o_orderkey AS grade_id, o_custkey AS student, CASE WHEN o_orderkey % 13 = 0 THEN ' ' ELSE (CASE WHEN o_orderkey % 2 = 0 THEN 'CS' ELSE 'ma' END) || (o_orderkey % 50) END AS code, 'Course ' || (o_orderkey % 25) AS name,
  o_orderstatus AS department, o_orderpriority AS nature, ['A+', 'b', 'P', ' fail ', 'W', '??', ''][o_orderkey % 7 + 1] AS letter, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey * 7 % 101 AS DOUBLE) END AS score,
  CAST(o_orderkey % 5 AS DOUBLE) / 2 AS credits, year(o_orderdate) || '-' || (o_orderkey % 2 + 1) AS semester FROM orders),
transcript AS (SELECT *, coalesce({_LETTER_CASE}, CASE WHEN score BETWEEN 60 AND 100 THEN {_SCORE_CASE} END) AS points, semester || '|' || code || '|' || name || '|' || letter || '|' || coalesce(CAST(score AS VARCHAR), '') AS identity,
  CASE WHEN score >= 60 THEN 'passed' WHEN score < 60 THEN 'failed' WHEN letter IN ('A+', 'b', 'P') THEN 'passed' WHEN letter = ' fail ' THEN 'failed' WHEN letter = 'W' THEN 'non-completed' ELSE 'unknown' END AS completion FROM raw)"""


def snapshots(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Two bags (source, key, canon, full) of orders: some gone, some new, some with another price."""
    k = F.col("o_orderkey")
    base = t.orders.select(k.alias("k"), F.col("o_orderstatus").alias("source"), F.concat(F.lit("c"), (F.col("o_custkey") % 400).cast("string")).alias("key"), F.floor("o_totalprice").cast("long").alias("price"), F.col("o_orderpriority").alias("note"))

    def side(df: DataFrame) -> DataFrame:
        canon = F.concat_ws("|", "key", F.col("price").cast("string"))
        return df.select("source", "key", canon.alias("canon"), F.concat_ws("|", canon, "note").alias("full"))

    return side(base.where("k % 10 <> 0")), side(base.where("k % 10 <> 1").withColumn("price", F.when(F.col("k") % 7 == 0, F.col("price") + 5).otherwise(F.col("price"))))


SNAPSHOTS = """base AS (SELECT o_orderkey AS k, o_orderstatus AS source, 'c' || (o_custkey % 400) AS key, CAST(floor(o_totalprice) AS BIGINT) AS price, o_orderpriority AS note FROM orders),
b0 AS (SELECT source, key, key || '|' || price AS canon, key || '|' || price || '|' || note AS doc FROM base WHERE k % 10 <> 0),
a0 AS (SELECT source, key, key || '|' || p AS canon, key || '|' || p || '|' || note AS doc FROM (SELECT *, CASE WHEN k % 7 = 0 THEN price + 5 ELSE price END AS p FROM base WHERE k % 10 <> 1)),
bn AS (SELECT *, row_number() OVER (PARTITION BY source, key, canon ORDER BY doc) AS rn FROM b0),
an AS (SELECT *, row_number() OVER (PARTITION BY source, key, canon ORDER BY doc) AS rn FROM a0),
bl AS (SELECT source, key, doc, row_number() OVER (PARTITION BY source, key ORDER BY doc) AS rn FROM bn ANTI JOIN an USING (source, key, canon, rn)),
al AS (SELECT source, key, doc, row_number() OVER (PARTITION BY source, key ORDER BY canon, doc) AS rn FROM an ANTI JOIN bn USING (source, key, canon, rn)),
j AS (SELECT source, key, rn, bl.doc AS before, al.doc AS after, CASE WHEN al.doc IS NULL THEN 'removed' WHEN bl.doc IS NULL THEN 'added' ELSE 'changed' END AS change_type
  FROM bl FULL JOIN al USING (source, key, rn)),
d AS (SELECT *, CASE change_type WHEN 'changed' THEN greatest(count(before) OVER w, count(after) OVER w) WHEN 'removed' THEN count(before) OVER w ELSE count(after) OVER w END AS total
  FROM j WINDOW w AS (PARTITION BY source, key)),
changes AS (SELECT source, CASE WHEN total > 1 THEN key || '#' || rn ELSE key END AS key, change_type, before, after FROM d)"""
