"""Packing documents into sequences by minimum bin slack.

Each task packs its own rows, window of documents by window. A document longer than the capacity gives full sequences;
what remains of each document is a piece of less than the capacity. Of the pieces only the count by length matters: a
bitset subset-sum over the remaining lengths (a bit per reachable sum) finds the multiset that fills a sequence from its
longest piece closest to capacity, backtracking gives the counts, and the pattern is used as often as the counts allow.
Once no multiset fills a sequence, the pieces left are laid end to end and cut at capacity, and the last stretch is cut
into powers of two, which need no padding. So a window pads nothing, at the cost of one row of short sequences.

Nothing is shuffled or collected; memory is bounded by a window (and by one document's ids), and a lost task is redone
alone. Defined results: a null text is empty and still has its end id; repeated rows are packed one by one, and the
pieces' start tells which document's part they are; other columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import table
from plumbline.llm.tokens import default_vocabulary, encoder, slices

#: Documents and ids that are packed together at most (a document with more ids stands alone).
WINDOW_DOCS, WINDOW_IDS = 16384, 2 << 20
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def best_fill(counts: dict[int, int], longest: int, capacity: int) -> dict[int, int]:
    """Lengths and how often each: with one of the longest, the multiset of the least slack."""
    room = capacity - longest
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == longest), room // length)
        take = 1
        while left > 0:  # counts as sums of powers of two: each step is one shift
            take = min(take, left)
            steps.append((reach, length, take))
            reach |= reach << length * take & mask
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    at, found = reach.bit_length() - 1, {longest: 1}
    for before, length, take in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            found[length] = found.get(length, 0) + take
    return found


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[dict[int, int], int]], dict[int, int]]:
    """Patterns that fill a sequence, how often each is used, and the counts that no pattern fills."""
    left, rest, patterns = {k: v for k, v in counts.items() if v}, {}, []
    while left:
        longest = max(left)
        fill = best_fill(left, longest, capacity)
        if sum(k * v for k, v in fill.items()) < capacity:
            rest[longest] = left.pop(longest)
            continue
        times = min(left[k] // v for k, v in fill.items())
        patterns.append((fill, times))
        for k, v in fill.items():
            left[k] -= v * times
            if not left[k]:
                del left[k]
    return patterns, rest


def pack(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of (document, start, length, sequence, offset); sequences are numbered from 0."""
    out, at = [], 0
    full = lengths // capacity
    doc = np.repeat(np.arange(len(lengths)), full)
    if len(doc):
        first = np.concatenate([[0], np.cumsum(full)[:-1]])
        start = (np.arange(len(doc)) - first[doc]) * capacity
        out.append(np.stack([doc, start, np.full(len(doc), capacity), np.arange(len(doc)), np.zeros(len(doc), np.int64)], 1))
        at = len(doc)
    rests = lengths - full * capacity
    order = np.argsort(rests, kind="stable")
    order = order[rests[order] > 0]
    values, begin, count = np.unique(rests[order], return_index=True, return_counts=True)
    free = {int(v): order[b : b + c] for v, b, c in zip(values, begin, count, strict=True)}
    patterns, rest = plan({k: len(v) for k, v in free.items()}, capacity)
    for fill, times in patterns:
        offset = 0
        for length, each in fill.items():
            docs, free[length] = free[length][: each * times], free[length][each * times :]
            slot = np.arange(each * times)
            out.append(np.stack([docs, full[docs] * capacity, np.full(len(docs), length), at + slot // each, offset + slot % each * length], 1))
            offset += length * each
        at += times
    docs = np.concatenate([free[k] for k in rest]) if rest else np.zeros(0, np.int64)
    stream = []
    edges = _edges(int(rests[docs].sum()), capacity)
    ends = np.cumsum(rests[docs])
    for doc, end in zip(docs.tolist(), ends.tolist(), strict=True):
        begin = int(end - rests[doc])
        k = int(np.searchsorted(edges, begin, "right")) - 1
        where = begin
        while where < end:
            stop = min(int(edges[k + 1]), end)
            stream.append((doc, int(full[doc]) * capacity + where - begin, stop - where, at + k, where - int(edges[k])))
            where, k = stop, k + 1
    if stream:
        out.append(np.array(stream, dtype=np.int64))
    return np.concatenate(out) if out else np.zeros((0, 5), np.int64)


def _edges(total: int, capacity: int) -> np.ndarray:
    """Where sequences begin in a stretch: at each multiple of the capacity, then at powers of two, large ones first."""
    edges = list(range(0, total + 1, capacity))
    tail = total - edges[-1]
    for bit in reversed(range(tail.bit_length())):
        if tail >> bit & 1:
            edges.append(edges[-1] + (1 << bit))
    return np.array(edges, dtype=np.int64)


def pack_documents(docs: DataFrame, capacity: int = 2048, end_id: int = 1, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row a piece: doc_id, start, length, doc_tokens, sequence_id, offset and ids (little-endian, 32 bits each)."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, at = encoder(path), TaskContext.get().partitionId() << 40
        keys: list[pa.Array] = []
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        for whole in batches:
            for batch in slices(whole, 1):
                flat, offsets = words.ragged(batch.column(1))
                lengths = np.diff(offsets)
                out = np.full(len(flat) + len(lengths), end_id, dtype="<u4")
                out[np.arange(len(flat)) + np.repeat(np.arange(len(lengths)), lengths)] = flat
                keys.append(batch.column(0))
                ids.append(out)
                sizes.append(lengths + 1)
                if sum(map(len, sizes)) >= WINDOW_DOCS or sum(map(len, ids)) >= WINDOW_IDS:
                    at = yield from _packed(keys, ids, sizes, capacity, at)
                    keys, ids, sizes = [], [], []
        if keys:
            yield from _packed(keys, ids, sizes, capacity, at)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)


def _packed(keys: list, ids: list, sizes: list, capacity: int, at: int):
    key, flat, lengths = pa.concat_arrays(keys), np.concatenate(ids), np.concatenate(sizes)
    first = np.cumsum(lengths) - lengths
    rows = pack(lengths, capacity)
    for part in range(0, len(rows), 1024):
        doc, start, length, sequence, offset = rows[part : part + 1024].T
        begin = first[doc] + start
        ends = np.concatenate([[0], np.cumsum(length)])
        chosen = flat[np.repeat(begin - ends[:-1], length) + np.arange(ends[-1])]
        blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(ends * 4), pa.py_buffer(chosen)]).cast(pa.binary())
        columns = [key.take(pa.array(doc)), *(pa.array(x, pa.int64()) for x in (start, length, lengths[doc], sequence + at, offset)), blobs]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
    return at + (int(rows[:, 3].max()) + 1 if len(rows) else 0)


def with_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_pack_documents(spark, sf_dir: str) -> DataFrame:
    return with_digest(pack_documents(table(spark, sf_dir, "documents")))
