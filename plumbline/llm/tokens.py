"""Encoding of whole Arrow string columns by a public tokenizer, each distinct word of a batch once."""

from __future__ import annotations

import ctypes
import os
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from plumbline.llm.vec import string_parts

#: Bytes of text encoded together.
BATCH_BYTES = 2 << 20
#: Words whose ids a Python worker keeps from task to task, the first that it meets (about 200 bytes each).
KEPT_WORDS = 300_000


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Letters that stay one letter in lower case and in normal form, then punctuation that makes one part.
_PLAIN = re.compile("([a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([.,!?;:|&%$*#]+)?")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """For tokenizers that drop white space before they merge, so that a text's ids are its words' ids in order."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_part = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_part[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self.folds = self.tokenizer.encode("Qz", add_special_tokens=False).ids == self.tokenizer.encode("qz", add_special_tokens=False).ids
        self.places: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.begin = np.zeros(1, np.int64)

    def _ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A place for each word; ids one after the other; where each place begins (and the last ends)."""
        places = np.fromiter(map(self.places.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(places < 0)
        if not len(new):
            return places, self.flat, self.begin
        added, sizes = self._encode([words[i] for i in new.tolist()])
        flat = np.concatenate([self.flat, added])
        begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])
        places[new] = len(self.begin) - 1 + np.arange(len(new))
        room = max(0, KEPT_WORDS - len(self.places))
        if room:
            kept = new[:room].tolist()
            self.places.update(zip([words[i] for i in kept], places[new[:room]].tolist(), strict=True))
            end = len(self.places)
            self.begin = begin[: end + 1].copy()
            self.flat = flat[: self.begin[-1]].copy()
        return places, flat, begin

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has.

        Words of letters, or letters and then punctuation, are encoded as one text: how many pieces end a part of it is
        known, and so where each word ends. If that doesn't come out, and for other words, each is encoded alone.
        """
        parts = np.fromiter((0 if m is None else 1 if m[2] is None else 2 for m in map(_PLAIN.fullmatch, words)), np.int64, len(words))
        plain, odd = np.flatnonzero(parts > 0), np.flatnonzero(parts == 0)
        sizes = np.zeros(len(words), np.int64)
        joined = self.tokenizer.encode_batch_fast([" ".join([words[i] for i in plain.tolist()])], add_special_tokens=False)[0].ids
        joined = np.array(joined, np.uint32)
        ends = np.flatnonzero(self.ends_part[joined])
        if len(ends) != parts.sum():
            plain, odd, joined = plain[:0], np.arange(len(words)), joined[:0]
        else:
            sizes[plain] = np.diff(ends[np.cumsum(parts[plain]) - 1] + 1, prepend=0)
        each = [e.ids for e in self.tokenizer.encode_batch_fast([words[i] for i in odd.tolist()], add_special_tokens=False)]
        sizes[odd] = np.fromiter(map(len, each), np.int64, len(each))
        out = np.zeros(int(sizes.sum()), np.uint32)
        of_odd = np.zeros(len(words), bool)
        of_odd[odd] = True
        where = np.repeat(of_odd, sizes)
        out[where] = np.fromiter(chain.from_iterable(each), np.uint32, int(sizes[odd].sum()))
        out[~where] = joined
        return out, sizes

    def ragged(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and n + 1 offsets of the rows into them. Nulls are empty."""
        text = pc.fill_null(column.cast(pa.large_string()), "")
        if self.folds and not pc.any(pc.match_substring(text, "<|")).as_py():  # no special token can come about
            data, at = string_parts(text)
            lower = _LOWER[data[at[0] : at[-1]]] if len(text) else data
            text = pa.LargeStringArray.from_buffers(len(text), pa.py_buffer(at - at[0] if len(at) else np.zeros(1, np.int64)), pa.py_buffer(lower))
        lists = pc.ascii_split_whitespace(text)
        coded = pc.dictionary_encode(lists.flatten())
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        places, flat, begin = self._ids_of(coded.dictionary.to_pylist())
        words = places[coded.indices.to_numpy(zero_copy_only=False)]
        lengths = begin[words + 1] - begin[words]
        ends = np.cumsum(lengths)
        ids = flat[np.repeat(begin[words] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        offsets = lists.offsets.to_numpy().astype(np.int64)
        return ids, np.concatenate([[0], ends])[offsets - offsets[0]]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder a Python worker."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def slices(batch: pa.RecordBatch, column: int, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about so many bytes of a string column; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, to - at)
        at = to
    give_back()


def give_back() -> None:
    """Return freed memory to the system: workers live on from stage to stage, beside an executor that needs it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
