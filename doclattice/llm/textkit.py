"""Vectorised word and n-gram hashing over the UTF-8 buffers of Arrow string columns.

Words are byte runs between separators; all offsets are taken from the Arrow buffers, so no Python
string is made for a word. A word's hash is a polynomial over random byte values modulo 2**64, taken
from one running sum over the chunk, then mixed; an n-gram's is the same construction over word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text that are hashed at once; one longer document makes a chunk of its own.
CHUNK_BYTES = 1 << 20

#: ASCII white space: 0x20 and 0x09 to 0x0D.
SPACE_SEPARATORS = (0x20, *range(0x09, 0x0E))


def _odd(seed: int) -> int:
    return int(np.random.default_rng(seed).integers(0, 1 << 63, dtype=np.uint64)) * 2 + 1 & (1 << 64) - 1


@dataclass(frozen=True)
class Alphabet:
    """How bytes become words: a separator mask and a random 64-bit value for each byte (seeded)."""

    separators: tuple[int, ...] = SPACE_SEPARATORS
    lower: bool = False
    seed: int = 20240601

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        letter = np.ones(256, bool)
        letter[list(self.separators)] = False
        values = np.random.default_rng(self.seed).integers(1, 1 << 63, 256, dtype=np.uint64)
        if self.lower:
            values[65:91] = values[97:123]
        return letter, values


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64 for i < n, kept and grown as needed."""
    up, down = _POWERS.get(base, (None, None))
    if up is None or len(up) < n:
        size = 1 << n.bit_length()
        inverse = pow(base, -1, 1 << 64)
        up, down = np.full(size, base, U64), np.full(size, inverse, U64)
        up[0] = down[0] = 1
        np.cumprod(up, out=up)
        np.cumprod(down, out=down)
        if size <= 4 * CHUNK_BYTES:
            _POWERS[base] = up, down
    return up, down


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective finaliser (two multiply-xorshift rounds)."""
    x = x + U64(0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019 * salt & (1 << 64) - 1)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@dataclass
class Words:
    """Words of the rows first..first+rows-1 of a batch. doc: row of each word, counted from first."""

    first: int
    rows: int
    hashes: np.ndarray
    doc: np.ndarray
    counts: np.ndarray

    def ngrams(self, k: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each start, and the index of that start, within rows."""
        w, n = self.hashes, len(self.hashes)
        if n < k:
            return np.empty(0, U64), np.empty(0, np.int64)
        up, down = powers(_odd(seed), n + 1)
        run = np.zeros(n + 1, U64)
        np.cumsum(w * up[:n], out=run[1:])
        at = np.flatnonzero(self.doc[: n - k + 1] == self.doc[k - 1 :])
        return mix((run[at + k] - run[at]) * down[at], 1), at

    def whole(self, seed: int = 11) -> np.ndarray:
        """Hash of the whole word sequence of each row; 0 where it has no words."""
        out = np.zeros(self.rows, U64)
        n = len(self.hashes)
        if n:
            up, down = powers(_odd(seed), n + 1)
            run = np.zeros(n + 1, U64)
            np.cumsum(self.hashes * up[:n], out=run[1:])
            ends = np.cumsum(self.counts)
            starts = ends - self.counts
            full = self.counts > 0
            out[full] = mix((run[ends] - run[starts])[full] * down[starts[full]] + self.counts[full].astype(U64), 2)
        return out


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)


def spans(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most limit bytes, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def words(column: pa.Array, alphabet: Alphabet) -> Iterator[Words]:
    """The words of each row, a bounded chunk at a time. Null is no text."""
    offsets, data = _buffers(column)
    letter, values = alphabet.tables()
    base = _odd(alphabet.seed + 1)
    for i, j in spans(offsets):
        lo, hi = int(offsets[i]), int(offsets[j])
        part = data[lo:hi]
        n = hi - lo
        inside = letter[part]
        cut = np.zeros(n + 1, bool)
        cut[offsets[i : j + 1] - lo] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | cut[:n]))
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
        up, down = powers(base, n + 1)
        run = np.zeros(n + 1, U64)
        np.cumsum(values[part] * up[:n], out=run[1:])
        hashes = mix((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))
        doc = np.searchsorted(offsets[i + 1 : j + 1] - lo, starts, "right")
        yield Words(i, j - i, hashes, doc, np.bincount(doc, minlength=j - i))
