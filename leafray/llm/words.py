"""Words of a column of texts, found and hashed with numpy, many texts at once.

No Python object is made per word and nothing is remembered between batches, so
a worker needs a few arrays the size of one piece of a batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that are worked on at once, about; a longer text makes a piece of its own.
PIECE = 1 << 20
#: Bytes of a word beyond which it is hashed by itself.
LONG = 256
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)

#: Tables from bytes to bytes, in which what separates words becomes a space.
PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[9:14] = 32
LOWER = PLAIN.copy()
LOWER[65:91] += 32


def release() -> None:
    """Give freed memory back: idle workers stay beside those of the next stage, and what they hold counts for the executor."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def pieces(batches: Iterable[pa.RecordBatch], column: str, most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices with about ``most`` bytes of text at most; memory is released after each batch."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, to - at)
            at = to
        del batch
        release()


class Words:
    """Words of texts: ``begin`` and ``end`` of each in ``data``, ``first`` the number of each text's first word (one more at the end), ``bounds`` the texts' bytes.

    Words are runs of bytes that ``table`` does not turn into a space; ``data``
    holds the bytes after that table. Null texts have no words.
    """

    def __init__(self, texts: pa.Array, table: np.ndarray = PLAIN):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        _, offsets, raw = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        size = int(bounds[-1] - bounds[0])
        # eight more bytes, so that words can be read eight bytes at a time
        self.data = np.full(size + 8, 32, np.uint8)
        if size:
            np.take(table, np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]], out=self.data[:size])
        self.bounds = bounds - bounds[0]
        self.inside = self.data[:size] != 32
        starts, lasts = self.inside.copy(), self.inside.copy()
        starts[1:] &= ~self.inside[:-1]
        lasts[:-1] &= ~self.inside[1:]
        at, to = self.bounds[:-1], self.bounds[1:]
        full = at < to
        starts[at[full]] = self.inside[at[full]]
        lasts[to[full] - 1] = self.inside[to[full] - 1]
        self.begin, self.end = np.flatnonzero(starts), np.flatnonzero(lasts) + 1
        self.first = np.searchsorted(self.begin, self.bounds)

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def left(self) -> np.ndarray:
        """Words from each word (counted) to the end of its text."""
        return np.repeat(self.first[1:], self.counts()) - np.arange(len(self.begin))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        length = self.end - self.begin
        out = length.astype(np.uint64) * _MIX
        eights = np.ndarray((len(self.data) - 7,), "<u8", self.data, 0, (1,))
        todo = np.flatnonzero(length <= LONG)
        at = 0
        while len(todo):
            here = np.minimum(length[todo] - at, 8).astype(np.uint64)
            x = eights[self.begin[todo] + at] & (_FULL >> ((np.uint64(8) - here) << np.uint64(3)))
            out[todo] = _combined(out[todo], x)
            at += 8
            todo = todo[length[todo] > at]
        for k in np.flatnonzero(length > LONG).tolist():
            out[k] = xxhash.xxh3_64_intdigest(self.data[self.begin[k] : self.end[k]])
        return out

    def joined(self, i: int, drop: Iterable[tuple[int, int]] = ()) -> bytes:
        """The words of text ``i``, without those in the word ranges ``drop`` (counted in the text), joined by one space."""
        lo, hi = int(self.bounds[i]), int(self.bounds[i + 1])
        keep = self.inside[lo:hi].copy()
        keep[1:] |= self.inside[lo : hi - 1] if hi > lo else keep[1:]
        first, n = int(self.first[i]), int(self.first[i + 1] - self.first[i])
        for a, b in drop:
            keep[self.begin[first + a] - lo : (self.begin[first + b] if b < n else hi) - lo] = False
        return self.data[lo:hi][keep].tobytes().removesuffix(b" ")

    def between(self, a: int, b: int) -> bytes:
        """The words from number ``a`` to before ``b`` (of one text, counted over all), joined by one space."""
        lo, hi = int(self.begin[a]), int(self.end[b - 1])
        keep = self.inside[lo:hi].copy()
        keep[1:] |= self.inside[lo : hi - 1]
        return self.data[lo:hi][keep].tobytes()


def split(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; none of null."""
    return (text or "").encode().split()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def _combined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _MULT
    x ^= b
    x *= _MIX
    x ^= x >> np.uint64(32)
    return x


def runs(h: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` words that start at each place (none where the words end earlier), from hashes of runs of 1, 2, 4, ... words."""
    n = len(h) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done, level, size = None, 0, h, 1
    while True:
        if length & size:
            part = level[done : done + n]
            out = part if out is None else _combined(out, part)
            done += size
        if done == length:
            return mixed(out + np.uint64(length))
        level = _combined(level[:-size], level[size:])
        size *= 2


def shingle_sets(words: Words, length: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its ``length``-word shingles; a shorter text is one shingle, no word none."""
    h = words.hashes()
    whole = runs(h, length)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        out.append(np.unique(whole[a : b - length + 1]) if b - a >= length else runs(h[a:b], b - a) if b > a else h[:0])
    return out


def listed(arrays: list[np.ndarray], kind: pa.DataType, valid: np.ndarray | None = None) -> pa.ListArray:
    """Arrays as one column of lists; where ``valid`` is false, null."""
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays], dtype=np.int64)]).astype(np.int32)
    values = pa.array(np.concatenate(arrays) if arrays else np.empty(0, kind.to_pandas_dtype()), kind)
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=None if valid is None else pa.array(~valid))
