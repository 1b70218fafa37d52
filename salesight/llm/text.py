"""Words, lines and their hashes, computed over whole Arrow batches of texts.

All functions work on bytes of UTF-8 in numpy, a bounded chunk of rows at a time; a
text longer than a chunk is a chunk of its own. Hashes are 64 bits wide and the same
on every run and machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_ALL = np.arange(256)
#: Bytes of words `[^\x20\x09-\x0D]+`.
SPACED = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))
#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of a text with A-Z in lower case, so A-Z count.
ALNUM = (
    ((_ALL >= 0x30) & (_ALL <= 0x39))
    | ((_ALL >= 0x41) & (_ALL <= 0x5A))
    | ((_ALL >= 0x61) & (_ALL <= 0x7A))
    | (_ALL >= 0x80)
)
#: Each byte with A-Z in lower case.
LOWER = np.where((_ALL >= 0x41) & (_ALL <= 0x5A), _ALL + 0x20, _ALL).astype(np.uint8)

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20)).integers(
    1, 1 << 63, 256, dtype=np.uint64
)
_powers: dict[int, np.ndarray] = {}


class Chunk(NamedTuple):
    """Rows ``first`` to ``last`` of a batch: their bytes and where each row begins."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


class Words(NamedTuple):
    """Byte ranges of the words of a chunk; row i has words ``rows[i]:rows[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Consecutive rows of about ``limit`` bytes together; a null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    buffers = texts.buffers()
    at = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield Chunk(first, last, data[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


def pieces(data: np.ndarray, member: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[np.ndarray]:
    """Consecutive parts of a text of about ``limit`` bytes, cut where no run of member bytes is."""
    first, step = 0, 1 << 16
    while first < len(data):
        last = min(first + limit, len(data))
        while last < len(data):
            gaps = np.flatnonzero(~member[data[last : last + step]])
            if len(gaps):
                last += int(gaps[0])
                break
            last = min(last + step, len(data))
        yield data[first:last]
        first = last


def runs(member: np.ndarray, bounds: np.ndarray) -> Words:
    """Maximal runs of True that cross no row bound."""
    n = len(member)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = member[:-1], member[1:]
    inner = bounds[(bounds > 0) & (bounds < n)]
    before[inner], after[inner - 1] = False, False
    starts = np.flatnonzero(member & ~before)
    ends = np.flatnonzero(member & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, bounds))


def words(chunk: Chunk, table: np.ndarray = SPACED) -> Words:
    return runs(table[chunk.data], chunk.bounds)


def lines(chunk: Chunk) -> Words:
    r"""The \n-split lines of each row, empty ones included; an empty row has one line."""
    breaks = np.flatnonzero(chunk.data == 0x0A)
    starts = np.sort(np.concatenate([chunk.bounds[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([chunk.bounds[1:], breaks]), kind="stable")
    counts = np.diff(np.searchsorted(breaks, chunk.bounds)) + 1
    return Words(starts, ends, np.concatenate([[0], np.cumsum(counts)]))


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers of an odd base modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 2 * CHUNK_BYTES)
        made = np.full(size, base, np.uint64)
        made[0] = 1
        have = np.cumprod(made, dtype=np.uint64)
        if size <= 8 * CHUNK_BYTES:  # one very long text leaves no table behind
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Hashes of any ranges of a sequence of 64-bit values, each in constant time."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(_MULTIPLIER, n), out=self.prefix[1:])
        self.back = powers(_INVERSE, n + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
        raw = (self.prefix[ends] - self.prefix[starts]) * self.back[starts]
        return mix(raw + mix((ends - starts).astype(np.uint64) + np.uint64(seed << 32)))


def byte_hasher(data: np.ndarray) -> Hasher:
    return Hasher(_BYTE_VALUES[data])


def word_hashes(data: np.ndarray, found: Words) -> np.ndarray:
    return byte_hasher(data)(found.starts, found.ends)


def row_of(rows: np.ndarray) -> np.ndarray:
    """For each item the row it belongs to, from where each row's items begin."""
    return np.repeat(np.arange(len(rows) - 1), np.diff(rows))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def per_row(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of each row's items, 0 for a row without items."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[rows[1:]] - total[rows[:-1]]


def joined(data: np.ndarray, found: Words) -> tuple[np.ndarray, np.ndarray]:
    r"""The words with one space after each, \n after a row's last; where each word starts."""
    lengths = found.ends - found.starts
    moved = np.cumsum(lengths + 1) - lengths - 1
    out = np.full(int(lengths.sum()) + len(lengths), 0x20, np.uint8)
    shift = np.repeat(moved - found.starts, lengths)
    inside = np.repeat(found.starts - np.cumsum(lengths) + lengths, lengths) + np.arange(len(shift))
    out[inside + shift] = data[inside]
    last = found.rows[1:][np.diff(found.rows) > 0] - 1
    out[moved[last] + lengths[last]] = 0x0A
    return out, moved
