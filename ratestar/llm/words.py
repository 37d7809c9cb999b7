"""Words of a text column as numpy arrays: borders, 64-bit hashes, hashes of runs of words.

Helpers for code inside Spark tasks. A batch of texts is one byte buffer; a word
is a maximal run of bytes of a class. All classes used here hold every byte from
0x80 on, so cutting bytes equals cutting characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Texts are worked on in slices of about so many bytes, whatever the batch size.
SLICE_BYTES = 2 << 20
#: Longer words are hashed one by one.
LONG_WORD = 64

_U = np.uint64


def byte_class(*separators: tuple[int, int]) -> np.ndarray:
    """True for bytes of words: all but the given inclusive ranges."""
    table = np.ones(256, dtype=bool)
    for low, high in separators:
        table[low:high + 1] = False
    return table


#: `[^\x20\x09-\x0D]+`
BLANK_SEPARATED = byte_class((0x20, 0x20), (0x09, 0x0D))
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, for lower-cased text
ALPHANUMERIC = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def looked_up(buffer: np.ndarray, table: np.ndarray) -> np.ndarray:
    """table[buffer] for bytes, without widening them to indexes."""
    return np.frombuffer(buffer.tobytes().translate(table.astype(np.uint8).tobytes()), np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all (the finalizer of splitmix64)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


@dataclass
class Words:
    """The words of consecutive texts: text d has the words first[d] to first[d + 1]."""

    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The number of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def last(self) -> np.ndarray:
        """For each word the index after the last word of its text."""
        return np.repeat(self.first[1:], self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return _hash_words(self.buffer, self.starts, self.ends, seed)

    def bytes_of(self, i: int) -> bytes:
        return self.buffer[self.starts[i]:self.ends[i]].tobytes()


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column with about limit bytes each, or one row."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        base = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield begin, end
        begin = end


def split_words(column: pa.Array, table: np.ndarray = BLANK_SEPARATED, lower: bool = False) -> Words:
    """The words of each text; null is a text without words."""
    texts = pc.fill_null(column.cast(pa.large_binary()), b"")
    joined = pc.binary_join_element_wise(texts, pa.scalar(b"\n", pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    size = len(joined)
    offsets = np.frombuffer(joined.buffers()[1], dtype=np.int64)[joined.offset:joined.offset + size + 1]
    body = np.frombuffer(joined.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]] if size else np.empty(0, np.uint8)
    # One separator in front, eight behind: lanes of eight bytes may be read past the last word.
    buffer = np.full(len(body) + 9, 10, dtype=np.uint8)
    buffer[1:-8] = looked_up(body, LOWER) if lower else body
    inside = looked_up(buffer, table).view(np.int8)
    change = np.diff(inside)
    starts = np.flatnonzero(change == 1) + 1
    ends = np.flatnonzero(change == -1) + 1
    first = np.searchsorted(starts, offsets - offsets[0] + 1) if size else np.zeros(1, dtype=np.int64)
    return Words(buffer, starts, ends, first)


def _hash_words(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    lengths = ends - starts
    lanes = np.ndarray((max(0, len(buffer) - 7),), dtype="<u8", buffer=buffer, strides=(1,))
    keep = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=_U)
    out = mix(lengths.astype(_U) + _U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64)))
    todo = np.flatnonzero(lengths <= LONG_WORD)
    for at in range(0, LONG_WORD, 8):
        todo = todo[lengths[todo] > at]
        if not len(todo):
            break
        lane = lanes[starts[todo] + at] & keep[np.minimum(lengths[todo] - at, 8)]
        out[todo] = mix((out[todo] ^ lane) + _U(0x9E3779B97F4A7C15))
    for i in np.flatnonzero(lengths > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(buffer[starts[i]:ends[i]].tobytes(), seed=seed)
    return out


_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=_U)


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Rabin-Karp hash of the run of `length` words that starts at each index (0 to n - length).

    Runs may span texts; the caller leaves those out. The prefix sums roll over
    all words modulo 2^64, in which the odd base has an inverse.
    """
    n = len(words)
    if n < length:
        return np.empty(0, dtype=_U)
    sums = np.zeros(n + 1, dtype=_U)
    np.cumsum(words * _powers(_BASE, n), out=sums[1:])
    return mix((sums[length:] - sums[:-length]) * _powers(_INVERSE, n - length + 1))
