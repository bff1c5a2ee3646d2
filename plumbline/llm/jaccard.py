"""N-gram Jaccard join: documents whose sets of word n-grams are similar, as components of the links.

1. One pass counts in how many documents each n-gram is, as sorted runs that are merged by shard; n-grams that more than
   one document has are kept with their counts as sorted arrays, which workers map into memory.
2. A second pass orders each set rare first and gives the part of its prefix that is shared, with a 64-bit signature of the
   set and the parities of its n-grams by hash range. Documents with one signature are one entity from here on, so copies
   cost nothing further. Two sets similar enough share an n-gram of their prefixes; prefix n-grams are joined as posting
   lists, of which those with one entity go.
3. Candidates of a list pass the length filter, the positional filter (what can still follow at the shared n-gram), the
   suffix filter (ranges of unlike parity bound from below how far two sets differ), and are verified once by their sets.
   Only classes are asked for, so a list isn't expanded into all pairs: for two rounds each entity is verified against
   one hub of its lists, which joins large groups. Then what isn't of a list's largest class is verified against
   everything of another class there. So each link joins two entities that are in one class or have been compared.

A group of copies is one entity before lists are joined. A list that many entities share is a skewed key: what joins it is
written first, so that both sides of each join are plain shuffles, which Spark splits (spark.sql.adaptive.skewJoin).

Defined results: A-Z count as a-z; a document with fewer than n words has its whole sequence as its one n-gram; a null
or blank text has no n-gram, links with nothing and is its own component; copies and repeated rows link if they have an
n-gram; component_id is the least doc_id that is reachable (null ids don't count; it is null if all are); other
columns are ignored; an empty table gives an empty table. Sets of equal signature are taken for equal (64 bits: about
k*k / 2**65 clashes among k different sets). The shared folder must be a mounted one for arrays to be mapped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import KEY_ROWS, checked_broadcast, materialise, named, new_path, table
from plumbline.llm.components import components
from plumbline.llm.runs import CHUNK, Counter, by_shard, get, merge_runs, put, runs_of, shard_bits, stretches
from plumbline.llm.tokens import slices
from plumbline.llm.vec import mix, window_hashes, word_hashes

#: Bytes of text whose sets are made together.
BLOCK = 2 << 20
#: Bits of an n-gram's hash by which documents are counted (n-grams that share them count together).
PRINT_BITS = 48
#: Hash ranges of the suffix filter, a bit each.
RANGES = 512
BITMAP = [f"b{i}" for i in range(RANGES // 64)]


def document_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The distinct n-grams of each text, in order of hash."""
    words, offsets = word_hashes(column)
    for i in range(len(offsets) - 1):
        grams = np.sort(window_hashes(words[offsets[i] : offsets[i + 1]], n))
        if len(grams) > 1:
            grams = grams[np.concatenate([[True], grams[1:] != grams[:-1]])]
        yield grams


def signature(grams: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(grams).sum(dtype=np.uint64) + np.uint64(len(grams))]))[0].view(np.int64))


def _count(docs: DataFrame, n: int) -> tuple[str, int]:
    """Write how many documents have each n-gram that more than one has, as sorted arrays by shard; place and bits."""
    spark = docs.sparkSession
    bits, root = shard_bits(docs, "text"), new_path(spark, "grams")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(lambda k: (np.zeros(len(k), np.int64), (k >> np.uint64(PRINT_BITS - bits)).astype(np.int64)))
        for whole in batches:
            for batch in slices(whole, 1, BLOCK):
                sets = [s for s in document_sets(batch.column(1), n) if len(s)]
                if sets:
                    yield from counter.add(np.concatenate(sets) >> np.uint64(64 - PRINT_BITS))
        yield counter.runs()

    def merge(shard: int, runs: pa.Table) -> pa.Table:
        key, times = merge_runs(runs_of(runs))
        put(root, f"key-{shard}.npy", key[times > 1])
        put(root, f"times-{shard}.npy", np.minimum(times[times > 1], 2**32 - 1).astype(np.uint32))
        return pa.table({"shard": pa.array([shard], pa.int32())})

    by_shard(docs.mapInArrow(count, CHUNK), 1 << bits, merge, "shard int")
    return root, bits


def _times(root: str, bits: int, grams: np.ndarray) -> np.ndarray:
    """In how many documents sorted n-grams are; 1 for those that no array has."""
    prints = grams >> np.uint64(64 - PRINT_BITS)
    out = np.ones(len(grams), np.int64)
    for shard, a, b in stretches((prints >> np.uint64(PRINT_BITS - bits)).astype(np.int64)):
        own = get(root, f"key-{shard}.npy")
        if len(own):
            at = np.minimum(np.searchsorted(own, prints[a:b]), len(own) - 1)
            out[a:b] = np.where(own[at] == prints[a:b], get(root, f"times-{shard}.npy")[at], 1)
    return out


def _prefixes(docs: DataFrame, n: int, percent: int, root: str, bits: int) -> DataFrame:
    """A row a document (doc_id, sig, n, b0 to b7: parities by hash range), and one for each n-gram of its prefix that
    another document has (gram, sig, n, pos from 1)."""
    none = lambda k: pa.nulls(k, pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, BLOCK):
                sets = list(document_sets(batch.column(1), n))
                sigs = [signature(s) if len(s) else None for s in sets]
                sizes = np.array([len(s) for s in sets], np.int32)
                every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                bins = np.repeat(np.arange(len(sets)) * RANGES, sizes) + (every & np.uint64(RANGES - 1)).astype(np.int64)
                parity = np.packbits((np.bincount(bins, minlength=len(sets) * RANGES) & 1).astype(np.uint8)).view("<i8").reshape(-1, RANGES // 64)
                k = len(sets)
                yield pa.RecordBatch.from_arrays([batch.column(0), none(k), pa.array(sigs, pa.int64()), pa.array(sizes), pa.nulls(k, pa.int32()), *(pa.array(parity[:, i]) for i in range(RANGES // 64))], names=names)
                kinds, where = np.unique(every, return_inverse=True)
                times = _times(root, bits, kinds)[where]
                grams, of, pos, at = [], [], [], 0
                for i, s in enumerate(sets):
                    often = times[at : at + len(s)]
                    at += len(s)
                    length = len(s) - (percent * len(s) + 99) // 100 + 1
                    alone = int((often == 1).sum())  # these come first, and nothing else has them
                    if len(s) and alone < length:
                        shared = np.flatnonzero(often > 1)
                        order = shared[np.lexsort((s[shared], often[shared]))][: length - alone]
                        grams.append(s[order])
                        of.append(np.full(len(order), i))
                        pos.append(np.arange(len(order)) + alone + 1)
                if grams:
                    of, k = np.concatenate(of), sum(map(len, grams))
                    columns = [none(k), pa.array(np.concatenate(grams).view(np.int64)), pa.array(sigs, pa.int64()).take(pa.array(of)), pa.array(sizes[of]), pa.array(np.concatenate(pos).astype(np.int32)), *[none(k)] * (RANGES // 64)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "gram", "sig", "n", "pos", *BITMAP]
    return docs.mapInArrow(run, "doc_id long, gram long, sig long, n int, pos int, " + ", ".join(f"{b} long" for b in BITMAP))


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """sig, grams of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, BLOCK):
                sets = [s for s in document_sets(batch.column(1), n) if len(s)]
                if sets:
                    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                    grams = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array([signature(s) for s in sets], pa.int64()), grams], names=["sig", "grams"])

    return docs.mapInArrow(run, "sig long, grams array<long>")


def _apart(a: Column, b: Column) -> Column:
    """By how much two sets differ at least: in how many hash ranges one has an odd count and the other an even one."""
    out = F.lit(0)
    for name in BITMAP:
        out = out + F.bit_count(a[name].bitwiseXOR(b[name]))
    return out


def _may_link(a: Column, b: Column, percent: int) -> Column:
    """Length, positional and suffix filters, at an n-gram that both prefixes have."""
    na, nb = a["n"], b["n"]
    needed = F.ceil(percent * (na + nb) / (100 + percent) - 1e-9)
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (1 + F.least(na - a["pos"], nb - b["pos"]) >= needed) & (_apart(a, b) <= na + nb - 2 * needed)


class _Links:
    """Verified links so far, and the classes they make."""

    def __init__(self, docs: DataFrame, n: int, lists: DataFrame, entities: DataFrame, percent: int):
        self.docs, self.n, self.lists, self.entities, self.percent = docs, n, lists, entities, percent
        self.tested: DataFrame | None = None
        self.labels: DataFrame | None = None

    def labelled(self) -> DataFrame:
        """The posting lists with classes: gram, label, at (sig, n, pos, bitmap)."""
        own = self.lists.select("gram", "sig", F.struct("sig", "n", "pos", *BITMAP).alias("at"))
        if self.labels is not None:
            own = own.join(self.labels.select(F.col("node").alias("sig"), "label"), "sig", "left").withColumn("label", F.coalesce("label", "sig"))
        else:
            own = own.withColumn("label", F.col("sig"))
        return own.select("gram", "label", "at")

    def sets(self, pairs: DataFrame) -> DataFrame:
        """sig, grams of the entities of the pairs, from one of the documents of each."""
        sigs = pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
        wanted = materialise(self.entities.join(sigs, "sig", "left_semi").select("sig", "doc_id"), "wanted")
        ids = checked_broadcast(wanted.select("doc_id").where("doc_id is not null").distinct(), KEY_ROWS)
        chosen = self.docs.join(ids, "doc_id", "left_semi")
        if not wanted.where("doc_id is null").isEmpty():
            chosen = chosen.unionByName(self.docs.where("doc_id is null"))
        return materialise(_sets(chosen, self.n), "grams")

    def verify(self, pairs: DataFrame) -> int:
        """Take up those of the candidates (a, b, na, nb) that are links, each looked at once. How many there were."""
        pairs = pairs.distinct()
        if self.tested is not None:
            pairs = pairs.join(self.tested.select("a", "b"), ["a", "b"], "left_anti")
        pairs = materialise(pairs, "pairs")
        count = pairs.count()
        if count:
            sets = self.sets(pairs)
            for side in ("a", "b"):
                pairs = pairs.join(sets.select(F.col("sig").alias(side), F.col("grams").alias(f"g{side}")), side)
            common = F.size(F.array_intersect("ga", "gb"))
            found = pairs.select("a", "b", (100 * common >= self.percent * (F.col("na") + F.col("nb") - common)).alias("linked"))
            found = materialise(found, "tested")
            self.tested = found if self.tested is None else self.tested.unionByName(found)
            self.labels = components(self.tested.where("linked"))
        return count

    @staticmethod
    def _pairs(met: DataFrame, x: str, y: str) -> DataFrame:
        turned = F.col(f"{x}.sig") > F.col(f"{y}.sig")
        pick = lambda c, low: F.when(turned == low, F.col(f"{y}.{c}")).otherwise(F.col(f"{x}.{c}"))
        return met.select(pick("sig", True).alias("a"), pick("sig", False).alias("b"), pick("n", True).alias("na"), pick("n", False).alias("nb"))

    def stars(self, turn: int) -> DataFrame:
        """One candidate for each entity: of the hubs of its lists, the one that it meets most often. At first a list's hub
        has the fewest rarer n-grams of its own, as the original of a group of copies has; later it is any."""
        lists = self.labelled()
        first = F.struct("at.pos", "at.sig") if turn == 0 else F.xxhash64(F.lit(turn), F.col("at.sig"))
        hubs = lists.groupBy("gram").agg(F.min_by(F.struct("label", "at"), first).alias("hub"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").drop("low", "high")
        hubs = materialise(hubs, "hubs")
        met = lists.join(hubs, "gram").where((F.col("label") != F.col("hub.label")) & _may_link(F.col("at"), F.col("hub.at"), self.percent))
        met = met.groupBy(F.col("at.sig").alias("own"), F.col("hub.at.sig").alias("sig")).agg(F.count("*").alias("k"), F.first(F.struct(F.col("at.sig").alias("sig"), F.col("at.n").alias("n"))).alias("x"), F.first(F.struct(F.col("hub.at.sig").alias("sig"), F.col("hub.at.n").alias("n"))).alias("y"))
        best = met.groupBy("own").agg(F.max_by(F.struct("x", "y"), F.struct("k", "sig")).alias("best")).select("best.x", "best.y")
        return self._pairs(best, "x", "y")

    def across(self) -> DataFrame:
        """All candidates of different classes: in each list, what isn't of its largest class against everything."""
        lists = self.labelled()
        if self.labels is None:
            lists = lists.withColumn("largest", F.lit(None).cast("long"))
        else:
            sizes = lists.groupBy("gram", "label").agg(F.count("*").alias("k"))
            largest = sizes.groupBy("gram").agg(F.max_by("label", F.struct("k", "label")).alias("largest"), F.count("*").alias("classes")).where("classes > 1").drop("classes")
            lists = materialise(lists.join(materialise(largest, "largest"), "gram"), "classes")
        rest = lists.where("largest is null or label <> largest").select("gram", F.col("label").alias("own"), F.col("at").alias("from"))
        once = F.coalesce(F.col("label") == F.col("largest"), F.lit(False)) | (F.col("from.sig") < F.col("at.sig"))
        met = rest.join(lists, "gram").where((F.col("label") != F.col("own")) & once & _may_link(F.col("from"), F.col("at"), self.percent))
        return self._pairs(met, "from", "at")


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id for each row of docs. Links: 100 * intersection >= percent * union."""
    own = docs.select(named(doc_id).cast("long").alias("doc_id"), named(text).alias("text"))
    rows = materialise(_prefixes(own, n, percent, *_count(own, n)), "prefixes")
    narrow, postings = rows.where("gram is null").select("doc_id", "sig", "n", *BITMAP), rows.where("gram is not null").select("gram", "sig", "n", "pos")
    entities = materialise(narrow.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("doc_id"), *[F.first(b).alias(b) for b in BITMAP]), "entities")
    postings = materialise(postings.distinct(), "postings")  # copies go here, combined by the tasks that have them
    shared = materialise(postings.groupBy("gram").agg(F.count("*").alias("k")).where("k > 1").select("gram"), "shared")
    lists = postings.join(shared, "gram", "left_semi").join(entities.drop("doc_id"), "sig")
    links = _Links(own, n, materialise(lists, "lists"), entities, percent)
    for turn in range(2):
        if not links.verify(links.stars(turn)):
            break
    links.verify(links.across())
    label = F.lit(None).cast("long") if links.labels is None else F.col("label")
    of = entities if links.labels is None else entities.join(links.labels.withColumnRenamed("node", "sig"), "sig", "left")
    of = of.select("sig", "doc_id", F.coalesce(label, F.col("sig")).alias("label"))
    least = materialise(of.groupBy("label").agg(F.min("doc_id").alias("component_id")), "least")
    of = of.join(least, "label").select(F.col("sig"), "component_id")
    out = narrow.join(of, "sig", "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op6_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)


OP6_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, chr(10)) ELSE ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] END AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
m AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM m JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.other) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
"""
