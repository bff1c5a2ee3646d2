"""Scoring by an interpolated modified Kneser-Ney model of order 2 or 3 that is counted over all training rows.

Words are 64-bit hashes; the sorted array of the training words' hashes is the vocabulary, and a word's place in it its
id. Tasks count words, pairs and triples of ids by numpy, combine what they have, and send sorted, compressed runs to a
shard; a shard merges them, a range of keys after the other, and writes sorted arrays to the shared folder. Workers map
those files into memory and look sorted queries up. Shards follow the bytes of text.

A pair is kept as its second word, sorted in the stretch of its first word, a triple as its third word in the stretch of
its first pair (a pair's index is its place in the pairs' files); counts take a byte, large ones stand aside. Pairs are in
the shard of their first word. Those of a word that alone would fill a quarter of a shard are dealt, by the whole pair,
over shards in proportion to the word's count.

Lookups go through a bounded number of files: once a step has written a shard's arrays, those of adjacent shards are strung
together, so that neither the arrays a worker maps nor the steps of a lookup grow with the shards. In a mounted folder there
are as many of these groups as the square root of the shards, 16 at least; elsewhere each shard stays a group.

P(v | u) = (c(u, v) - D) / c(u) + g(u) P(v), P(v) = (k(v) - D') / K + g' / (V + 1): k counts the different words before v,
K the different pairs, D and D' depend on the count (1, 2, 3 and more) by the counts of counts, and g gives what was
taken off. After an unknown word, P(v) alone counts.

Order 3: P(w | u, v) = (c(u, v, w) - D'') / c(u, v) + g(u, v) P(w | v), and P(w | v) has, in place of c, the number of
different words before a pair (c itself after the start mark), which triples are counted for once more by their last
pair. After a pair that no training row has, P(w | v) counts. A text begins after a start mark and ends with an end token.

Defined results: null or blank texts are one end token; a null id counts as an empty one (held out); repeated rows are
learned and scored one by one; other columns are ignored; without training rows score and base_score take every token
as one of one unknown kind; an empty table gives an empty table. The vocabulary may hold up to 2**32 - 2 words; for
order 3 the bits of a pair's index and of a word's id are 64 at most together. The
shared folder must be a mounted one for files to be mapped; from another store shards are read into memory, of which a
worker keeps a bounded part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import materialise, new_path, table
from plumbline.llm.runs import CHUNK, SHARD_BYTES, Counter, by_place, by_shard, counts_at, every_shard, get, join_begins, join_counts, join_heads, join_rows, mounted, merge_runs, put, put_counts, run_batch, runs_of, shard_bits, small, stretches
from plumbline.llm.tokens import slices
from plumbline.llm.vec import mix, word_hashes

#: Bytes of text that are counted or scored together.
BLOCK = 3 << 20
END = np.uint64(0x2545F4914F6CDD1D)
START_ID = (1 << 32) - 1
_LOW, _HALF = np.uint64(0xFFFFFFFF), np.uint64(32)


# The model


def find(values: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted value in its sorted stretch values[low:high], -1 if it isn't there."""
    low, end, high = low.copy(), high, high.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        less = values[middle] < wanted[open_]
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
        open_ = open_[low[open_] < high[open_]]
    out = np.full(len(low), -1, np.int64)
    inside = np.flatnonzero(low < end)
    found = inside[values[low[inside]] == wanted[inside]]
    out[found] = low[found]
    return out


def begins(at: np.ndarray, size: int) -> np.ndarray:
    """Where the stretch of each of so many heads begins in sorted head numbers, and the end."""
    return small(np.concatenate([[0], np.cumsum(np.bincount(at, minlength=size))]))


def as_pair(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return (u.astype(np.uint64) << _HALF) | v.astype(np.uint64)


@dataclass
class Model:
    """What is small: the arrays are in the files of root. A place is a kind (0: by first word, 1: dealt) and a shard."""

    root: str
    bits: int
    offsets: np.ndarray
    tokens: int = 0
    kinds: int = 0
    docs: int = 0
    frequent: np.ndarray = field(default_factory=lambda: np.array([START_ID], np.int64))
    spread: np.ndarray = field(default_factory=lambda: np.array([0], np.int64))
    frequent_stats: np.ndarray | None = None
    pair_off: tuple = (0.0, 0.0, 0.0)
    word_off: tuple = (0.0, 0.0, 0.0)
    pairs: int = 0
    word_rest: float = 1.0
    order: int = 2
    word_bits: int = 32
    pair_offsets: np.ndarray | None = None
    last_off: tuple = (0.0, 0.0, 0.0)
    last_stats: np.ndarray | None = None
    triple_off: tuple = (0.0, 0.0, 0.0)

    @property
    def shift(self) -> int:
        """Bits of a shard's number within its group; a group of a place, too, is its number without them."""
        return max(0, self.bits - max(4, self.bits // 2)) if mounted(self.root) else 0

    def file(self, name: str, group: int) -> str:
        return f"{name}-all-{group}" if self.shift else f"{name}-{group}"

    def shard_of_hash(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def shard_of_id(self, i: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, i, "right") - 1

    def ids(self, h: np.ndarray) -> np.ndarray:
        """Ids of sorted hashes, -1 for those not in the vocabulary."""
        out = np.full(len(h), -1, np.int64)
        for g, a, b in stretches(self.shard_of_hash(h) >> self.shift):
            own = get(self.root, self.file("hash", g) + ".npy")
            if len(own):
                at = np.minimum(np.searchsorted(own, h[a:b]), len(own) - 1)
                out[a:b] = np.where(own[at] == h[a:b], at + self.offsets[g << self.shift], -1)
        return out

    def of_words(self, name: str, ids: np.ndarray, width: int = 1) -> np.ndarray:
        """Values by id, for sorted ids, a column each."""
        out = np.zeros((len(ids), width), np.int64)
        for g, a, b in stretches(self.shard_of_id(ids) >> self.shift):
            at = (ids[a:b] - self.offsets[g << self.shift])[:, None] * width + np.arange(width)
            out[a:b] = counts_at(self.root, self.file(name, g), at.ravel()).reshape(-1, width)
        return out

    def after_words(self, name: str, ids: np.ndarray, often: np.ndarray) -> np.ndarray:
        """What is known of the pairs with a first word, for sorted ids; often: the rows of the frequent ones."""
        out = self.of_words(name, ids, often.shape[1])
        at = self.frequent_at(ids)
        out[at >= 0] = often[at[at >= 0]]
        return out

    def frequent_at(self, u: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.frequent, u), len(self.frequent) - 1)
        return np.where(self.frequent[at] == u, at, -1)

    def place_of_pair(self, key: np.ndarray) -> np.ndarray:
        u = (key >> _HALF).astype(np.int64)
        at = self.frequent_at(u)
        often = at >= 0
        dealt = (mix(u.astype(np.uint64)) + (mix(key) & ((np.uint64(1) << self.spread[at].astype(np.uint64)) - np.uint64(1)))) & np.uint64((1 << self.bits) - 1)
        return np.where(often, dealt.astype(np.int64) | 1 << self.bits, self.shard_of_id(np.where(often, 0, u)))

    def split(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return place >> self.bits, place & (1 << self.bits) - 1

    def heads(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        """The first words whose pairs are kept there, and where those of each begin among the place's pairs, and the end."""
        group, shard = place >> self.shift, place & (1 << self.bits) - 1
        if place >> self.bits:
            every, local = get(self.root, self.file("heads", group) + ".npy"), shard & (1 << self.shift) - 1
            first, end = np.searchsorted(every, np.array([local, local + 1]) << 32)
            heads = every[first:end] & int(_LOW)
        else:
            heads = np.arange(self.offsets[shard], self.offsets[shard + 1])
            first = self.offsets[shard] - self.offsets[shard >> self.shift << self.shift]
        begin = get(self.root, self.file("pairsat", group) + ".npy")[first : first + len(heads) + 1]
        return heads, begin.astype(np.int64) - self.stretch(place)[0]

    def stretch(self, place: int) -> tuple[int, int]:
        """Where a place's pairs begin and end in the files of its group."""
        base = self.pair_offsets[place >> self.shift << self.shift]
        return int(self.pair_offsets[place] - base), int(self.pair_offsets[place + 1] - base)

    def find_pairs(self, group: int, place: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Where pairs of a group, by place, are in its file, or -1."""
        u = (key >> _HALF).astype(np.int64)
        if group >> self.bits - self.shift:
            heads = get(self.root, self.file("heads", group) + ".npy")
            if not len(heads):
                return np.full(len(key), -1, np.int64)
            head = (place & (1 << self.shift) - 1) << 32 | u
            at = np.minimum(np.searchsorted(heads, head), len(heads) - 1)
            known = heads[at] == head
        else:
            at, known = u - self.offsets[group << self.shift], True
        begin = get(self.root, self.file("pairsat", group) + ".npy")
        low = begin[at].astype(np.int64)
        return find(get(self.root, self.file("pairs", group) + ".npy"), low, np.where(known, begin[at + 1].astype(np.int64), low), key & _LOW)

    def pair_index(self, key: np.ndarray) -> np.ndarray:
        """Indices of sorted pairs, -1 for those not in the training rows."""
        out = np.full(len(key), -1, np.int64)
        place = self.place_of_pair(key)
        order = by_place(place)
        for g, a, b in stretches(place[order] >> self.shift):
            at = self.find_pairs(g, place[order[a:b]], key[order[a:b]])
            out[order[a:b]] = np.where(at >= 0, at + self.pair_offsets[g << self.shift], -1)
        return out

    def place_of_index(self, index: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.pair_offsets, index, "right") - 1

    def of_pairs(self, name: str, index: np.ndarray, width: int = 1) -> np.ndarray:
        """Values by pair, a column each; 0 at index -1."""
        out = np.zeros((len(index), width), np.int64)
        known = np.flatnonzero(index >= 0)
        group = self.place_of_index(index[known]) >> self.shift
        order = by_place(group)
        for g, a, b in stretches(group[order]):
            which = known[order[a:b]]
            at = (index[which] - self.pair_offsets[g << self.shift])[:, None] * width + np.arange(width)
            out[which] = counts_at(self.root, self.file(name, g), at.ravel()).reshape(-1, width)
        return out

    def triple_counts(self, key: np.ndarray) -> np.ndarray:
        """Counts of sorted triples, 0 for those not in the training rows."""
        out = np.zeros(len(key), np.int64)
        bits = np.uint64(self.word_bits)
        first = (key >> bits).astype(np.int64)
        for g, a, b in stretches(self.place_of_index(first) >> self.shift):
            begin, at = get(self.root, self.file("triplesat", g) + ".npy"), first[a:b] - self.pair_offsets[g << self.shift]
            where = find(get(self.root, self.file("triples", g) + ".npy"), begin[at].astype(np.int64), begin[at + 1].astype(np.int64), key[a:b] & np.uint64((1 << self.word_bits) - 1))
            out[a:b][where >= 0] = counts_at(self.root, self.file("triplecount", g), where[where >= 0])
        return out


def _string(spark, model: Model, by_shard: dict, by_place: dict) -> None:
    """String the arrays of each group's shards, or places, together; each kind of arrays and group is a task."""
    root, size = model.root, 1 << model.shift
    tasks = [(name, join, g) for kinds, groups in ((by_shard, 1 << model.bits - model.shift), (by_place, 2 << model.bits - model.shift)) for name, join in kinds.items() for g in range(groups)]
    tasks = [(name, join, g) for name, join, g in tasks if name != "heads" or g >> model.bits - model.shift]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                name, join, g = tasks[i]
                join(root, [f"{name}-{k}" for k in range(g * size, (g + 1) * size)], model.file(name, g))
        yield from ()

    if model.shift:
        spark.range(0, len(tasks), 1, len(tasks)).mapInArrow(run, "id long").collect()


def discounts(n: np.ndarray) -> tuple[float, float, float]:
    """Of counts 1, 2, 3 and more, by the counts of counts 1 to 4."""
    n1, n2, n3, n4 = (float(x) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 0.75, 3 - 4 * y * n4 / n3 if n3 else 0.9]
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1))


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each row and its end, and n + 1 offsets."""
    words, offsets = word_hashes(column)
    n = len(offsets) - 1
    out = np.full(len(words) + n, END, np.uint64)
    out[np.arange(len(words)) + np.repeat(np.arange(n), np.diff(offsets))] = words
    return out, offsets + np.arange(n + 1)


def pair_keys(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[offsets[:-1]] = START_ID
    return as_pair(before, ids)


def _count_of_counts(counts: np.ndarray) -> np.ndarray:
    return np.array([(counts == k).sum() for k in (1, 2, 3, 4)], np.int64)


def _by_class(at: np.ndarray, count: np.ndarray, size: int) -> np.ndarray:
    """How many entries of each head have count 1, 2, 3 and more."""
    return np.bincount(at * 3 + np.minimum(count, 3) - 1, minlength=size * 3).reshape(size, 3)


#: What a shard tells the driver goes along with the runs: kind -1, numbers in keys, rows of frequent words in counts.
_TOLD = "shard int, numbers binary, stats binary"


def _told(shard: int, numbers: np.ndarray, stats: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([shard], pa.int32()), pa.array([numbers.astype(np.int64).tobytes()], pa.binary()), pa.array([stats.astype(np.int64).tobytes()], pa.binary())], names=["kind", "shard", "keys", "counts"])


def _numbers(data: bytes, *shape: int) -> np.ndarray:
    return np.frombuffer(data, np.int64).reshape(*shape)


def _in_turn(runs: DataFrame, shards: int, first, second, what: str) -> list:
    """first(shard, runs) writes a shard's arrays and gives runs by another key and what it tells; second(shard, runs, told)
    writes those and gives what goes to the driver: a row a shard, in order."""
    some = lambda t: t.filter(pc.and_(pc.greater_equal(t["kind"], 0), pc.is_valid(t["keys"])))

    def one(keys: tuple, rows: pa.Table) -> pa.Table:
        return pa.Table.from_batches(first(keys[0].as_py(), some(rows)))

    def two(keys: tuple, rows: pa.Table) -> pa.Table:
        own = rows.filter(pc.equal(rows["kind"], -1))
        numbers, stats = second(keys[0].as_py(), some(rows), own["keys"][0].as_py(), own["counts"][0].as_py())
        return pa.table({"shard": pa.array([keys[0].as_py()], pa.int32()), "numbers": pa.array([numbers.astype(np.int64).tobytes()], pa.binary()), "stats": pa.array([stats.astype(np.int64).tobytes()], pa.binary())})

    merged = runs.unionByName(every_shard(runs.sparkSession, shards)).groupBy("shard").applyInArrow(one, CHUNK)
    return materialise(merged.groupBy("shard").applyInArrow(two, _TOLD), what).orderBy("shard").collect()


def train(docs: DataFrame, text: str = "text", order: int = 2, shard_bytes: int = SHARD_BYTES) -> Model:
    if order not in (2, 3):
        raise ValueError("order 2 or 3")
    own = docs.select(F.col(text).alias("text"))
    model = Model(new_path(docs.sparkSession, "lm"), bits := shard_bits(own, "text", shard_bytes), np.zeros((1 << bits) + 1, np.int64), order=order)
    spark = docs.sparkSession
    _train_words(own, model)
    _string(spark, model, {"hash": join_rows, "count": join_counts}, {})
    _train_pairs(own, model)
    _string(spark, model, {"before": join_counts, "follow": join_counts}, {"heads": join_heads, "pairs": join_rows, "pairsat": join_begins, "paircount": join_counts})
    if order == 3:
        _train_triples(own, model)
        _string(spark, model, {"lastfollow": join_counts}, {"next": join_counts, "last": join_counts, "triples": join_rows, "triplesat": join_begins, "triplecount": join_counts})
    return model


def _train_words(own: DataFrame, model: Model) -> None:
    root, shards = model.root, 1 << model.bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(lambda h: (np.zeros(len(h), np.int64), model.shard_of_hash(h)))
        for whole in batches:
            for batch in slices(whole, 0, BLOCK):
                yield from counter.add(tokens_of(batch.column(0))[0])
        yield counter.runs()

    def merge(shard: int, runs: pa.Table) -> pa.Table:
        h, count = merge_runs(runs_of(runs))
        put(root, f"hash-{shard}.npy", h)
        put_counts(root, f"count-{shard}", count)
        top = np.flatnonzero(count * 4 * shards > count.sum())  # all that are frequent, and some that will turn out not to be
        return pa.table({"shard": pa.array([shard], pa.int32()), "n": [len(h)], "tokens": [int(count.sum())], "docs": [int(count[h == END].sum())], "top": pa.array([top.tolist()], pa.list_(pa.int64())), "times": pa.array([count[top].tolist()], pa.list_(pa.int64()))})

    found = by_shard(own.mapInArrow(count, CHUNK), shards, merge, "shard int, n long, tokens long, docs long, top array<long>, times array<long>")
    rows = found.select("shard", "n", "tokens", "docs").orderBy("shard").collect()
    model.offsets[1:] = np.cumsum([r["n"] for r in rows])
    model.tokens, model.kinds, model.docs = sum(r["tokens"] for r in rows), int(model.offsets[-1]), sum(r["docs"] for r in rows)
    if model.kinds > START_ID - 1:
        raise ValueError("more than 2**32 - 2 words")
    # No more than 4 a shard, since their counts add up to the tokens at most.
    top = found.select("shard", F.inline(F.arrays_zip("top", "times"))).where(F.col("times") * (4 * shards) > model.tokens).collect()
    often = sorted([(int(model.offsets[r["shard"]]) + r["top"], r["times"]) for r in top] + [(START_ID, model.docs)])
    model.frequent = np.array([i for i, _ in often], np.int64)
    model.spread = np.array([min(model.bits, (c * 4 * shards // max(model.tokens, 1)).bit_length()) for _, c in often], np.int64)


def _train_pairs(own: DataFrame, model: Model) -> None:
    root, shards = model.root, 1 << model.bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(lambda key: model.split(model.place_of_pair(key)))
        for whole in batches:
            for batch in slices(whole, 0, BLOCK):
                h, offsets = tokens_of(batch.column(0))
                kinds, where = np.unique(h, return_inverse=True)
                yield from counter.add(pair_keys(model.ids(kinds)[where], offsets))
        yield counter.runs()

    def merge(shard: int, runs: pa.Table) -> list[pa.RecordBatch]:
        numbers, stats, after = np.zeros(6, np.int64), np.zeros((0, 4), np.int64), []
        for kind in (0, 1):
            place = kind << model.bits | shard
            key, count = merge_runs(runs_of(runs.filter(pc.equal(runs["kind"], kind))))
            u = (key >> _HALF).astype(np.int64)
            heads = np.unique(u) if kind else np.arange(model.offsets[shard], model.offsets[shard + 1])
            if kind:
                put(root, f"heads-{place}.npy", heads)
            at = np.searchsorted(heads, u)
            put(root, f"pairs-{place}.npy", (key & _LOW).astype(np.uint32))
            put(root, f"pairsat-{place}.npy", begins(at, len(heads)))
            put_counts(root, f"paircount-{place}", count)
            follow = _by_class(at, count, len(heads))
            if kind:
                stats = np.column_stack([np.searchsorted(model.frequent, heads), follow])
            else:
                put_counts(root, f"follow-{shard}", follow)
            numbers[:4] += _count_of_counts(count)
            numbers[4 + kind] = len(key)
            after.append(key & _LOW)
        v, times = np.unique(np.concatenate(after), return_counts=True)
        return [run_batch(v, times, (np.zeros(len(v), np.int64), model.shard_of_id(v.astype(np.int64)))), _told(shard, numbers, stats)]

    def merge_before(shard: int, runs: pa.Table, numbers: bytes, stats: bytes) -> tuple[np.ndarray, np.ndarray]:
        v, count = merge_runs(runs_of(runs))
        before = np.zeros(int(model.offsets[shard + 1] - model.offsets[shard]), np.int64)
        before[v.astype(np.int64) - model.offsets[shard]] = count
        put_counts(root, f"before-{shard}", before)
        return np.concatenate([_numbers(numbers, -1), _count_of_counts(count), [(count >= 3).sum()]]), _numbers(stats, -1)

    rows = _in_turn(own.mapInArrow(count, CHUNK), shards, merge, merge_before, "pairs")
    told = np.array([_numbers(r["numbers"], 11) for r in rows])
    model.pair_offsets = np.concatenate([[0], np.cumsum(told[:, 4:6].T.ravel())])
    model.pairs, model.pair_off, n = int(model.pair_offsets[-1]), discounts(told[:, :4].sum(0)), told[:, 6:].sum(0)
    model.frequent_stats = _of_frequent(rows, len(model.frequent), 3)
    model.word_off = discounts(n[:4])
    model.word_rest = float(np.dot(model.word_off, n[[0, 1, 4]]) / model.pairs) if model.pairs else 1.0


def _of_frequent(rows: list, size: int, width: int) -> np.ndarray:
    out = np.zeros((size, width), np.int64)
    for r in rows:
        stats = _numbers(r["stats"], -1, 1 + width)
        np.add.at(out, stats[:, 0], stats[:, 1:])
    return out


def _train_triples(own: DataFrame, model: Model) -> None:
    root, shards = model.root, 1 << model.bits
    model.word_bits = max(1, model.kinds.bit_length())
    if model.word_bits + model.pairs.bit_length() > 64:
        raise ValueError("more pairs and words than 64 bits tell apart")
    bits, low = np.uint64(model.word_bits), np.uint64((1 << model.word_bits) - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(lambda key: model.split(model.place_of_index((key >> bits).astype(np.int64))))
        for whole in batches:
            for batch in slices(whole, 0, BLOCK):
                h, offsets = tokens_of(batch.column(0))
                kinds, where = np.unique(h, return_inverse=True)
                ids = model.ids(kinds)[where]
                pairs, back = np.unique(pair_keys(ids, offsets), return_inverse=True)
                key = (model.pair_index(pairs)[back][:-1].astype(np.uint64) << bits) | ids[1:].astype(np.uint64)
                inside = np.ones(len(h), bool)
                inside[offsets[:-1]] = False
                yield from counter.add(key[inside[1:]])
        yield counter.runs()

    def merge(shard: int, runs: pa.Table) -> list[pa.RecordBatch]:
        n, last = np.zeros(4, np.int64), []
        for kind in (0, 1):
            place = kind << model.bits | shard
            key, count = merge_runs(runs_of(runs.filter(pc.equal(runs["kind"], kind))))
            begin, end = model.stretch(place)
            first, third = get(root, model.file("pairs", place >> model.shift) + ".npy")[begin:end], key & low
            at = (key >> bits).astype(np.int64) - model.pair_offsets[place]
            put(root, f"triples-{place}.npy", third.astype(np.uint32))
            put(root, f"triplesat-{place}.npy", begins(at, len(first)))
            put_counts(root, f"triplecount-{place}", count)
            put_counts(root, f"next-{place}", _by_class(at, count, len(first)))
            n += _count_of_counts(count)
            last.append(as_pair(first[at], third))
        pair, times = np.unique(np.concatenate(last), return_counts=True)
        return [run_batch(pair, times, model.split(model.place_of_pair(pair))), _told(shard, n, np.zeros(0))]

    def merge_last(shard: int, runs: pa.Table, numbers: bytes, _: bytes) -> tuple[np.ndarray, np.ndarray]:
        n = np.zeros(4, np.int64)
        for kind in (0, 1):
            place = kind << model.bits | shard
            key, times = merge_runs(runs_of(runs.filter(pc.equal(runs["kind"], kind))))
            (heads, begin), own = model.heads(place), model.stretch(place)[0]
            count = np.zeros(int(begin[-1]), np.int64)
            count[model.find_pairs(place >> model.shift, np.full(len(key), place), key) - own] = times
            of = np.repeat(np.arange(len(heads)), np.diff(begin))
            if kind and len(heads) and heads[-1] == START_ID:
                begun = np.arange(begin[-2], begin[-1])
                count[begun] = counts_at(root, model.file("paircount", place >> model.shift), begun + own)
            put_counts(root, f"last-{place}", count)
            n += _count_of_counts(count)
            some = count > 0
            follow = np.column_stack([_by_class(of[some], count[some], len(heads)), np.bincount(of, count, len(heads)).astype(np.int64)])
            if kind:
                stats = np.column_stack([np.searchsorted(model.frequent, heads), follow])
            else:
                put_counts(root, f"lastfollow-{shard}", follow)
        return np.concatenate([_numbers(numbers, -1), n]), stats

    rows = _in_turn(own.mapInArrow(count, CHUNK), shards, merge, merge_last, "triples")
    n = np.sum([_numbers(r["numbers"], 8) for r in rows], axis=0)
    model.triple_off, model.last_off = discounts(n[:4]), discounts(n[4:])
    model.last_stats = _of_frequent(rows, len(model.frequent), 4)


# Scores


def _less(count: np.ndarray, off: tuple) -> np.ndarray:
    return np.where(count > 0, count - np.array([0.0, *off])[np.minimum(count, 3)], 0.0)


def _given(count: np.ndarray, total: np.ndarray, after: np.ndarray, off: tuple, below: np.ndarray) -> np.ndarray:
    """The interpolated probability; that of the next lower order where nothing follows the context."""
    whole = np.maximum(total, 1)
    return np.where(total > 0, _less(count, off) / whole + after @ np.array(off) / whole * below, below)


def log_probs(model: Model, h: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The training count and the log10 probability of each token."""
    kinds, where = np.unique(h, return_inverse=True)
    ids = model.ids(kinds)
    known = ids >= 0
    count, before = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64)
    count[known], before[known] = model.of_words("count", ids[known])[:, 0], model.of_words("before", ids[known])[:, 0]
    alone = (_less(before, model.word_off) / max(model.pairs, 1) + model.word_rest / (model.kinds + 1))[where]

    first = np.zeros(len(h), bool)
    first[offsets[:-1]] = True
    often = model.last_stats if model.order == 3 else np.column_stack([model.frequent_stats, np.append(count_of_frequent(model), model.docs)])
    after = np.zeros((len(kinds), 4), np.int64)
    if model.order == 3:
        after[known] = model.after_words("lastfollow", ids[known], often)
    else:
        after[known, :3], after[known, 3] = model.after_words("follow", ids[known], often[:, :3]), count[known]
    context = np.zeros((len(h), 4), np.int64)
    context[1:] = after[where][:-1]
    context[first] = often[-1]

    ids_at = ids[where]
    key = pair_keys(np.maximum(ids_at, 0), offsets)
    u_known = first.copy()
    u_known[1:] |= ids_at[:-1] >= 0
    both = u_known & (ids_at >= 0)
    pairs, back = np.unique(key[both], return_inverse=True)
    index = model.pair_index(pairs) if len(pairs) else np.zeros(0, np.int64)
    c = np.zeros(len(h), np.int64)
    c[both] = model.of_pairs("last" if model.order == 3 else "paircount", index)[back, 0]
    p = _given(c, context[:, 3], context[:, :3], model.last_off if model.order == 3 else model.pair_off, alone)
    if model.order == 3:
        p = _of_triples(model, ids_at, first, both, index, back, p)
    return count[where], np.log10(p)


def count_of_frequent(model: Model) -> np.ndarray:
    return model.of_words("count", model.frequent[:-1])[:, 0]


def _of_triples(model: Model, ids_at: np.ndarray, first: np.ndarray, both: np.ndarray, index: np.ndarray, back: np.ndarray, below: np.ndarray) -> np.ndarray:
    n = len(ids_at)
    pair, after = np.full(n, -1, np.int64), np.zeros((n, 4), np.int64)
    pair[both] = index[back]
    after[both] = np.column_stack([model.of_pairs("next", index, 3), model.of_pairs("paircount", index)])[back]
    context, given = np.full(n, -1, np.int64), np.zeros((n, 4), np.int64)
    context[1:], given[1:] = pair[:-1], after[:-1]
    context[first], given[first] = -1, 0
    whole = (context >= 0) & (ids_at >= 0)
    triples, again = np.unique((context[whole].astype(np.uint64) << np.uint64(model.word_bits)) | ids_at[whole].astype(np.uint64), return_inverse=True)
    c = np.zeros(n, np.int64)
    c[whole] = model.triple_counts(triples)[again]
    return _given(c, given[:, 3], given[:, :3], model.triple_off, below)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score (log10) of each row; perplexity is 10 ** (-score / n_tokens)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, BLOCK):
                h, offsets = tokens_of(batch.column(1))
                count, p = log_probs(model, h, offsets)
                base = np.log10((count + 0.1) / (model.tokens + 0.1 * (model.kinds + 1)))
                at = offsets[:-1]
                columns = [batch.column(0), pa.array(np.diff(offsets)), *(pa.array(np.add.reduceat(x, at)) for x in ((count > 0).astype(np.int64), base, p))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 10 == 0


def op9_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs.where(~held_out(F.col("doc_id"))), order=3)
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
