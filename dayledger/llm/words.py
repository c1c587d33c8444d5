"""Words of texts and their hashes, in numpy, for use inside tasks.

A word is a run of characters other than space, tab, line feed, vertical tab, form feed
and carriage return. A missing text has no words.
"""

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: White space of ``str.split`` that does not part words here.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    return _WORD.findall(text) if _OTHER_SPACE.search(text) else text.split()


class Memo(dict):
    """Remembers a function's values; starts anew past ``size`` so that memory stays bounded."""

    def __init__(self, function: Callable, size: int = 100_000):
        super().__init__()
        self.function, self.size = function, size

    def __missing__(self, key):
        value = self[key] = self.function(key)
        return value

    def trim(self) -> None:
        if len(self) > self.size:
            self.clear()


def word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))


#: One per worker process: what is known outlives a task.
_HASHES = Memo(word_hash)


def hashes(words: list[str]) -> np.ndarray:
    _HASHES.trim()
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


#: Is a byte part of a word? What parts words is below 128, so a text's UTF-8 need not be decoded.
_IN_WORD = np.ones(256, bool)
_IN_WORD[[0x20, *range(0x09, 0x0E)]] = False
#: The first 0 to 8 bytes of a little-endian number.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Bytes of a word that are hashed eight at a time for all words together.
_LONG = 256


class Words:
    """Hashes of a column's words, without a Python object for each: text ``i`` has words ``ends[i]`` to ``ends[i + 1]``.

    ``first`` and ``last`` are their places in ``data``, ``at`` those of the texts. These hashes are not those of ``hashes``.
    """

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string())
        at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
        n = int(at[-1] - at[0])
        held = np.zeros(n + 8, np.uint8)
        if n:
            held[:n] = np.frombuffer(column.buffers()[2], np.uint8, n, int(at[0]))
        self.at = at = at - at[0]
        self.data = held[:n]
        inside = _IN_WORD[self.data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        begin, end = at[:-1][at[:-1] < at[1:]], at[1:][at[:-1] < at[1:]] - 1
        first[begin], last[end] = inside[begin], inside[end]
        self.first, self.last = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.ends = np.searchsorted(self.first, at)
        eight = np.ndarray(n + 1, "<u8", held, strides=(1,))
        size = self.last - self.first
        h = mix((eight[self.first] & _FIRST[np.minimum(size, 8)]) ^ (size.astype(np.uint64) * GOLDEN))
        left = np.flatnonzero((size > 8) & (size <= _LONG))
        for k in range(8, _LONG, 8):
            left = left[size[left] > k]
            if not len(left):
                break
            h[left] = mix(h[left] * GOLDEN + (eight[self.first[left] + k] & _FIRST[np.minimum(size[left] - k, 8)]))
        for i in np.flatnonzero(size > _LONG).tolist():
            h[i] = xxhash.xxh64_intdigest(self.data[self.first[i] : self.last[i]])
        self.hashes = h

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.ends[i] : self.ends[i + 1]]


def slices(batches: Iterable[pa.RecordBatch], column: str, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of batches of about ``size`` bytes in a column of texts, a row at least: memory stays flat."""
    for batch in batches:
        at = np.concatenate(([0], np.cumsum(pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(), dtype=np.int64)))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(at, at[start] + size, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def mix(z: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64; wraps around."""
    z = (z ^ (z >> _S30)) * _M1
    z = (z ^ (z >> _S27)) * _M2
    return z ^ (z >> _S31)


def shingles(h: np.ndarray, k: int = 5) -> np.ndarray:
    """One hash for each run of ``k`` words; a text of fewer words is one run."""
    if not len(h):
        return h
    k = min(k, len(h))
    n = len(h) - k + 1
    s = np.full(n, k, np.uint64)
    for j in range(k):
        s = s * GOLDEN + h[j : j + n]
    return mix(s)


def pieces_of_batches(
    batches: Iterable[pa.RecordBatch], column: str, words: int = 200_000, split: Callable = words_of
) -> Iterator[tuple[pa.RecordBatch, list[list[str]]]]:
    """Slices of batches with their rows' words, about ``words`` at a time: memory stays flat."""
    for batch in batches:
        texts, start, held, n = batch.column(column), 0, [], 0
        for i in range(len(texts)):
            held.append(split(texts[i].as_py() or ""))
            n += len(held[-1])
            if n >= words or i + 1 == len(texts):
                yield batch.slice(start, len(held)), held
                start, held, n = i + 1, [], 0
