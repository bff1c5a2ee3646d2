"""Sorted runs of 64-bit keys with counts: counted by tasks, merged by shard, kept as arrays in the shared folder and
mapped into memory by workers."""

from __future__ import annotations

import os
import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import materialise

#: Counted entries that a task holds before it sends them on.
HELD = 1 << 20
#: Bytes of text to a shard, whose distinct entries one task merges (about 16 bytes of memory to one of text).
SHARD_BYTES = 16 << 20
CHUNK = "kind int, shard int, keys binary, counts binary"


# Arrays in the shared folder


def _local(path: str) -> str | None:
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return path if "://" not in path and not path.startswith("viewfs:") else None


def put(root: str, name: str, array: np.ndarray) -> None:
    """Written aside and renamed, so that a second attempt of a task changes nothing."""
    here = _local(root)
    if here is None:
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(root)
        with store.open_output_stream(f"{at}/{name}") as f:
            np.save(f, array)
        return
    os.makedirs(here, exist_ok=True)
    aside = f"{here}/.{name}.{uuid.uuid4().hex}"
    with open(aside, "wb") as f:
        np.save(f, array)
    os.replace(aside, f"{here}/{name}")


#: Mappings that a worker keeps, and bytes of arrays that it keeps where the folder isn't mounted; the oldest go first.
KEPT_ARRAYS, KEPT_BYTES = 8192, 256 << 20
_kept: OrderedDict[tuple[str, str], tuple[np.ndarray, int]] = OrderedDict()
_read: list[int] = [0]


def get(root: str, name: str) -> np.ndarray:
    if (root, name) in _kept:
        _kept.move_to_end((root, name))
        return _kept[root, name][0]
    here = _local(root)
    if here is None:
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(root)
        with store.open_input_file(f"{at}/{name}") as f:
            array = np.load(f)
    else:
        array = np.load(f"{here}/{name}", mmap_mode="r").view(np.ndarray)
    _kept[root, name] = array, 0 if here else array.nbytes
    _read[0] += _kept[root, name][1]
    while len(_kept) > 1 and (len(_kept) > KEPT_ARRAYS or _read[0] > KEPT_BYTES):
        _read[0] -= _kept.popitem(last=False)[1][1]
    return array


def small(values: np.ndarray) -> np.ndarray:
    """The same values in the narrowest unsigned type."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def put_counts(root: str, name: str, values: np.ndarray) -> None:
    """Whole numbers from 0, a byte each; those from 255 stand in a second file with their places."""
    values = values.ravel()
    large = np.flatnonzero(values >= 255)
    put(root, f"{name}.npy", np.minimum(values, 255).astype(np.uint8))
    put(root, f"{name}-large.npy", np.stack([large, values[large].astype(np.int64)]))


def counts_at(root: str, name: str, at: np.ndarray) -> np.ndarray:
    out = get(root, f"{name}.npy")[at].astype(np.int64)
    large = np.flatnonzero(out == 255)
    if len(large):
        places, values = get(root, f"{name}-large.npy")
        out[large] = values[np.searchsorted(places, at[large])]
    return out


# Arrays of adjacent shards, strung together in a mounted folder: a part after the other, never a whole in memory


def mounted(root: str) -> bool:
    return _local(root) is not None


def _string(root: str, parts: list[str], whole: str, dtype, more: int, piece) -> None:
    """piece(array, place of the part, entries before it) of each part as one array, with room for so many more entries at
    its end, which hold the sum; then the parts go. Where an attempt has done so before, nothing is left but to remove them."""
    here = _local(root)
    if not os.path.exists(f"{here}/{whole}.npy"):
        arrays = [np.load(f"{here}/{x}.npy", mmap_mode="r") for x in parts]
        ends = np.cumsum([0, *(len(x) - more for x in arrays)])
        kind = np.dtype(dtype(arrays))
        aside = f"{here}/.{whole}.{uuid.uuid4().hex}"
        with open(aside, "wb") as f:
            np.lib.format.write_array_header_1_0(f, {"descr": np.lib.format.dtype_to_descr(kind), "fortran_order": False, "shape": (int(ends[-1]) + more,)})
            before = 0
            for k, array in enumerate(arrays):
                f.write(np.ascontiguousarray(piece(array[: len(array) - more], k, before).astype(kind)).data)
                before += int(array[-1]) if more else len(array)
            f.write(np.array([before] * more).astype(kind).data)
        os.replace(aside, f"{here}/{whole}.npy")
    for x in parts:
        if os.path.exists(f"{here}/{x}.npy"):
            os.remove(f"{here}/{x}.npy")


def join_rows(root: str, parts: list[str], whole: str) -> None:
    _string(root, parts, whole, lambda arrays: arrays[0].dtype, 0, lambda x, k, before: x)


def join_heads(root: str, parts: list[str], whole: str) -> None:
    """With the part's number above 32 bits, so that they stay in order."""
    _string(root, parts, whole, lambda arrays: np.int64, 0, lambda x, k, before: x | k << 32)


def join_begins(root: str, parts: list[str], whole: str) -> None:
    """Of stretches that follow each other: the end of a part is the begin of the next."""
    _string(root, parts, whole, lambda arrays: np.min_scalar_type(sum(int(x[-1]) for x in arrays)), 1, lambda x, k, before: x.astype(np.int64) + before)


def join_counts(root: str, parts: list[str], whole: str) -> None:
    """The large ones first, as their places need the lengths of the parts."""
    here = _local(root)
    if not os.path.exists(f"{here}/{whole}-large.npy"):
        ends = np.cumsum([0, *(len(np.load(f"{here}/{x}.npy", mmap_mode="r")) for x in parts)])
        put(root, f"{whole}-large.npy", np.concatenate([np.load(f"{here}/{x}-large.npy") + np.array([[n], [0]]) for x, n in zip(parts, ends[:-1], strict=True)], axis=1))
    join_rows(root, parts, whole)
    for x in parts:
        if os.path.exists(f"{here}/{x}-large.npy"):
            os.remove(f"{here}/{x}-large.npy")


# Runs of sorted keys and counts


def _squeeze(values: np.ndarray) -> bytes:
    import zstandard

    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _expand(data: bytes, kind: type) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def pack_run(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    return _squeeze(np.diff(keys, prepend=np.uint64(0))), _squeeze(counts.astype(np.uint32))


def merge_runs(runs: list[tuple[bytes, bytes]], piece: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of all runs together; about so many entries are sorted at once, a range of keys after the other."""
    keys = [np.cumsum(_expand(k, np.uint64), dtype=np.uint64) for k, _ in runs]
    counts = [_expand(c, np.uint32) for _, c in runs]
    pieces = sum(map(len, keys)) // piece + 1
    if pieces == 1:
        return combine(keys, counts)
    some = np.sort(np.concatenate([k[:: 1 + len(k) // 256] for k in keys]))
    cuts = some[np.arange(1, pieces) * len(some) // pieces]
    ends = [np.concatenate([[0], np.searchsorted(k, cuts), [len(k)]]) for k in keys]
    parts = [combine([k[e[i] : e[i + 1]] for k, e in zip(keys, ends, strict=True)], [c[e[i] : e[i + 1]] for c, e in zip(counts, ends, strict=True)]) for i in range(pieces)]
    return np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])


def combine(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key, count = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


class Counter:
    """Counts keys and gives runs by kind and shard when it holds many."""

    def __init__(self, shard_of):
        self.shard_of, self.keys, self.counts, self.held = shard_of, [], [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        key, count = np.unique(keys, return_counts=True)
        self.keys.append(key)
        self.counts.append(count)
        self.held += len(key)
        if self.held > HELD:
            key, count = combine(self.keys, self.counts)
            self.keys, self.counts, self.held = [key], [count], len(key)
            if self.held > HELD // 2:
                yield self.runs()

    def runs(self) -> pa.RecordBatch:
        key, count = combine(self.keys, self.counts)
        self.keys, self.counts, self.held = [], [], 0
        return run_batch(key, count, self.shard_of(key))


def run_batch(key: np.ndarray, count: np.ndarray, where: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    """where: kind and shard of each key."""
    kind, shard = where
    place = kind.astype(np.int64) << 32 | shard.astype(np.int64)
    order = np.argsort(place, kind="stable")
    values, first = np.unique(place[order], return_index=True)
    rows = []
    for value, part in zip(values.tolist(), np.split(order, first[1:]) if len(values) else [], strict=True):
        rows.append((value >> 32, value & 0xFFFFFFFF, *pack_run(key[part], count[part])))
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["kind", "shard", "keys", "counts"])


def by_place(place: np.ndarray) -> np.ndarray:
    """The order that brings equal places together, in which they were (narrow numbers sort by digits)."""
    return np.argsort(small(place), kind="stable")


def stretches(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Value, begin and end of each run of equal values."""
    if len(values):
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(values)], strict=True):
            yield int(values[a]), a, b


def shard_bits(docs: DataFrame, text: str, shard_bytes: int = SHARD_BYTES) -> int:
    """Shards, as a power of two, follow the bytes of text."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(4, (size // shard_bytes).bit_length())


def every_shard(spark: SparkSession, shards: int) -> DataFrame:
    """A row without a run for each shard."""
    none = F.lit(None).cast("binary")
    return spark.range(shards).select(F.lit(0).alias("kind"), F.col("id").cast("int").alias("shard"), none.alias("keys"), none.alias("counts"))


def runs_of(rows: pa.Table) -> list[tuple[bytes, bytes]]:
    return list(zip(rows["keys"].to_pylist(), rows["counts"].to_pylist(), strict=True))


def by_shard(runs: DataFrame, shards: int, f, schema: str) -> DataFrame:
    """f(shard, runs) for each shard, also for those without runs; its rows, one a shard, written."""

    def g(keys: tuple, rows: pa.Table) -> pa.Table:
        return f(keys[0].as_py(), rows.filter(pc.is_valid(rows["keys"])))

    every = every_shard(runs.sparkSession, shards)
    return materialise(runs.unionByName(every).groupBy("shard").applyInArrow(g, schema), "shards")
