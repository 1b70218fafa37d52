"""Byte-level BPE encoding and decoding by a two-tier lookup.

A text is cut into pre-tokens by a pattern. Those that are in the vocabulary as a whole
are one token, found for a whole block at once by a minimal perfect hash: as many slots as
entries, each slot with the hash of its entry, so what is not in the vocabulary is seen.
The others are merged from single bytes: the pairs of neighbours wait in a heap by rank, then
place; merging two unlinks the right one and puts the new pairs in the heap, stale ones are
skipped when they come up. A worker keeps what it merged in a bounded cache. Decoding gathers
the bytes of the ids.

Rows: a null text is empty and has no tokens; blocks of a bounded number of pre-tokens are
encoded, digested and dropped, also inside a long text, so memory follows the longest
text (its characters) and the longest pre-token (some 200 bytes for each of its bytes);
bytes that are no UTF-8 count as U+FFFD; special strings are ordinary text; repeated rows
and null ids are rows like others; an empty table gives an empty result. Columns but
doc_id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain, islice, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesight.llm import text as T
from salesight.llm.tables import map_batches, records

#: Pre-tokens encoded at a time, and characters up to which a text is cut in one go.
BLOCK_TOKENS = 1 << 17
BLOCK_CHARS = 1 << 19
#: Entries of each of the two generations of a worker's cache, and the longest pre-token in
#: it. A full young generation becomes the old one, so what is in use stays.
CACHE_ENTRIES = 400_000
CACHE_BYTES = 128

# Letters and numbers of Unicode 17 and later drafts, which the regex library
# knows and the encoder to be matched, on Unicode 16, takes for unassigned.
LATE = (
    r"\u0558\u058B-\u058C\u088F\u0C5C\u0CDC\u208F\u209D-\u209F\uA7CE-\uA7CF\uA7D2\uA7D4\uA7DD\uA7E2\uA7F1"
    r"\uAB6C-\uAB6D\U000107BB-\U000107BF\U00010940-\U00010959\U00010EC5-\U00010EC7\U00010ED9-\U00010EEE"
    r"\U00011B0A\U00011DB0-\U00011DDB\U00011DE0-\U00011DE9\U00011DF1\U0001246F\U00012475-\U0001247F"
    r"\U00012550-\U00012686\U00016EA0-\U00016EB8\U00016EBB-\U00016ED3\U00016FF2-\U00016FF6"
    r"\U000187F8-\U000187FF\U00018CD6-\U00018CDA\U00018D09-\U00018D20\U00018D80-\U00018DF2"
    r"\U00018E00-\U00019191\U000191A0-\U000191D2\U0001B123-\U0001B128\U0001B168\U0001D6A6"
    r"\U0001DF1F-\U0001DF24\U0001DF2B-\U0001DF81\U0001DF90-\U0001DF96\U0001DFCD-\U0001DFFF"
    r"\U0001E6C0-\U0001E6DE\U0001E6E0-\U0001E6E2\U0001E6E4-\U0001E6E5\U0001E6E7-\U0001E6ED"
    r"\U0001E6F0-\U0001E6F4\U0001E6FE-\U0001E6FF\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD"
    r"\U000323B0-\U00033479\U0003D000-\U0003FC3F"
)

_workers: dict[bytes, Codec] = {}


class PerfectHash(NamedTuple):
    """Slots 0..n-1 for n hashes: hash the key to a bucket, and by the bucket's shift to a slot.

    A bucket of one key has the slot itself as its shift, as -1 - slot.
    """

    shifts: np.ndarray
    hashes: np.ndarray  # by slot

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        shift = self.shifts[_bucket(hashes, len(self.shifts))]
        slot = np.where(shift < 0, -1 - shift, _slot(hashes, shift, len(self.hashes)))
        return np.where(self.hashes[slot] == hashes, slot, -1)


def _bucket(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def _slot(hashes: np.ndarray, shift: np.ndarray | int, n: int) -> np.ndarray:
    moved = hashes + np.asarray(shift, np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (T.mix(moved) % np.uint64(n)).astype(np.int64)


def perfect_hash(hashes: np.ndarray) -> PerfectHash:
    """A minimal perfect hash of distinct 64-bit hashes; large buckets are placed first."""
    n = len(hashes)
    shifts, slots = np.zeros(n, np.int64), np.zeros(n, np.uint64)
    if not n:
        return PerfectHash(shifts, slots)
    bucket = _bucket(hashes, n)
    order = np.argsort(bucket, kind="stable")
    groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)
    groups.sort(key=len, reverse=True)
    free = np.ones(n, bool)
    singles = []
    for group in groups:
        if len(group) == 1:
            singles.append(group[0])
            continue
        keys, shift = hashes[group], 0
        while True:
            at = _slot(keys, shift, n)
            if free[at].all() and len(set(at.tolist())) == len(at):
                break
            shift += 1
        free[at] = False
        shifts[bucket[group[0]]], slots[at] = shift, keys
    left = np.flatnonzero(free)
    shifts[bucket[singles]], slots[left] = -1 - left, hashes[singles]
    return PerfectHash(shifts, slots)


class Vocabulary(NamedTuple):
    """Ranks of byte strings as arrays: what is broadcast."""

    pattern: str
    hash: PerfectHash
    ids: np.ndarray  # by slot
    data: np.ndarray  # all entries, in order of their ids
    starts: np.ndarray  # by id, one more than the largest


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and its rank on every line."""
    with open(path, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def vocabulary(ranks: dict[bytes, int], pattern: str) -> Vocabulary:
    size = max(ranks.values(), default=-1) + 1
    by_id = [b""] * size
    for token, rank in ranks.items():
        by_id[rank] = token
    starts = np.concatenate([[0], np.cumsum([len(t) for t in by_id], dtype=np.int64)])
    data = np.frombuffer(b"".join(by_id), np.uint8)
    used = np.array(sorted(ranks.values()), np.int64)
    hashes = T.byte_hasher(data)(starts[used], starts[used + 1])
    made = perfect_hash(hashes)
    ids = np.zeros(len(used), np.uint32)
    ids[made.find(hashes)] = used
    return Vocabulary(pattern, made, ids, data, starts)


def pair_ranks(ranks: dict[bytes, int]) -> list[int]:
    """The rank of every two bytes, -1 for none, by their value as one number."""
    return [ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]


def merge(piece: bytes, ranks: dict[bytes, int], pairs: list[int]) -> list[int]:
    """The ids of a pre-token: always the pair of lowest rank, leftmost first.

    Parts are linked by where they begin; ``now`` has the rank of each part with the next
    one, and a heap entry (rank, place, in one integer) that differs from it is stale.
    """
    n = len(piece)
    rank_of = ranks.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    now = [pairs[a << 8 | b] for a, b in pairwise(piece)]
    now.append(-1)
    heap = [rank << 32 | i for i, rank in enumerate(now) if rank >= 0]
    heapq.heapify(heap)
    while heap:
        entry = heapq.heappop(heap)
        i = entry & 0xFFFFFFFF
        if now[i] != entry >> 32:
            continue
        middle = after[i]
        end = after[i] = after[middle]
        now[i] = now[middle] = -1
        if end < n:
            before[end] = i
            rank = now[i] = rank_of(piece[i : after[end]], -1)
            if rank >= 0:
                heapq.heappush(heap, rank << 32 | i)
        first = before[i]
        if first >= 0:
            rank = now[first] = rank_of(piece[first:end], -1)
            if rank >= 0:
                heapq.heappush(heap, rank << 32 | first)
    found, i = [], 0
    while i < n:
        found.append(ranks[piece[i : after[i]]])
        i = after[i]
    return found


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Consecutive positions of ranges, one range after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


class Codec:
    """Encodes and decodes on one worker."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.cut = regex.compile(vocab.pattern)
        self.late = regex.compile(f"[{LATE}]")
        strict = vocab.pattern
        for known in (r"\p{L}", r"\p{N}"):
            strict = strict.replace(known, f"[{known}--[{LATE}]]")
        self.strict = regex.compile("(?V1)" + strict)
        raw, at = vocab.data.tobytes(), vocab.starts.tolist()
        self.ranks = {raw[at[i] : at[i + 1]]: i for i in sorted(vocab.ids.tolist())}
        self.pairs = pair_ranks(self.ranks)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def pre_tokens(self, text: str) -> Iterator[list[str]]:
        """The pattern's matches, a bounded number at a time."""
        plain = text.isascii() or not self.late.search(text)
        matches = (self.cut if plain else self.strict).finditer(text)
        if plain and len(text) <= BLOCK_CHARS and not self.cut.groups:
            yield self.cut.findall(text)
            return
        while block := [m.group() for m in islice(matches, BLOCK_TOKENS)]:
            yield block

    def _merged(self, piece: bytes) -> bytes:
        """The ids of a pre-token that the young cache lacks, as little-endian 32-bit integers."""
        found = self.old.get(piece)
        if found is None:
            found = np.array(merge(piece, self.ranks, self.pairs), "<u4").tobytes()
        if len(piece) <= CACHE_BYTES:
            if len(self.young) >= CACHE_ENTRIES:
                self.old, self.young = self.young, {}
            self.young[piece] = found
        return found

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pre-tokens, and where each pre-token's begin."""
        joined = "".join(pieces)
        raw = joined.encode()
        data = np.frombuffer(raw, np.uint8)
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))])
        if len(raw) > len(joined):  # from characters to bytes
            bounds = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(raw))[bounds]
        starts, ends = bounds[:-1], bounds[1:]
        slots = self.vocab.hash.find(T.byte_hasher(data)(starts, ends))
        whole = slots >= 0
        missed = np.flatnonzero(~whole)
        parts = [
            self.young.get(piece := raw[s:e]) or self._merged(piece)
            for s, e in zip(starts[missed].tolist(), ends[missed].tolist(), strict=True)
        ]
        counts = np.ones(len(pieces), np.int64)
        counts[missed] = np.fromiter(map(len, parts), np.int64, len(parts)) >> 2
        at = np.concatenate([[0], np.cumsum(counts)])
        ids = np.empty(at[-1], "<u4")
        ids[at[:-1][whole]] = self.vocab.ids[slots[whole]]
        ids[_spread(at[missed], counts[missed])] = np.frombuffer(b"".join(parts), "<u4")
        return ids, at

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of ids, and where each id's begin."""
        starts = self.vocab.starts[ids]
        lengths = self.vocab.starts[ids.astype(np.int64) + 1] - starts
        return self.vocab.data[_spread(starts, lengths)], np.concatenate([[0], np.cumsum(lengths)])

    def encode_text(self, text: str) -> list[int]:
        return [i for block in self.pre_tokens(text) for i in self.encode(block)[0].tolist()]

    def decode_bytes(self, ids: list[int]) -> bytes:
        return self.decode(np.array(ids, np.uint32))[0].tobytes()


def worker_codec(vocab: Vocabulary) -> Codec:
    key = vocab.pattern.encode() + vocab.data.tobytes()
    mark = hashlib.sha256(key + vocab.starts.tobytes()).digest()
    if mark not in _workers:
        _workers.clear()
        _workers[mark] = Codec(vocab)
    return _workers[mark]


def _texts(column: pa.Array) -> Iterator[str]:
    for value in column.cast(pa.binary()):
        yield (value.as_py() or b"").decode("utf-8", "replace")


def blocks(codec: Codec, texts: Iterator[str]) -> Iterator[list[tuple[int, list[str]]]]:
    """Rows with their pre-tokens, short rows together, a long one over several blocks."""
    held: list[tuple[int, list[str]]] = []
    n = 0
    for row, text in enumerate(texts):
        for pieces in codec.pre_tokens(text):
            held.append((row, pieces))
            n += len(pieces)
            if n >= BLOCK_TOKENS:
                yield held
                held, n = [], 0
    if held:
        yield held


def encoded(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and ``ids`` (an array) of every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(read_ranks(ranks_path), pattern))

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(shared.value)
        for row, text in enumerate(_texts(batch.column(1))):
            ids = pa.array([codec.encode_text(text)], pa.list_(pa.int32()))
            yield records(doc_id=batch.column(0).slice(row, 1), ids=ids)

    return map_batches(_rows(docs), step, "doc_id bigint, ids array<int>")


def decoded(rows: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and ``text`` (as bytes) of every row of ``rows`` (doc_id, ids); null ids are none."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary(read_ranks(ranks_path), pattern))

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(shared.value)
        texts = [codec.decode_bytes(ids.as_py() or []) for ids in batch.column(1)]
        yield records(doc_id=batch.column(0), text=pa.array(texts, pa.binary()))

    used = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids")
    return map_batches(used, step, "doc_id bigint, text binary")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row of ``docs`` (doc_id, text).

    The ids are digested as little-endian unsigned integers of 32 bits, then decoded. The
    ranks are read on the driver and broadcast: the vocabulary bounds them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(read_ranks(ranks_path), pattern))

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(shared.value)
        n_tokens = np.zeros(batch.num_rows, np.int64)
        of_ids = [hashlib.sha256() for _ in range(batch.num_rows)]
        of_bytes = [hashlib.sha256() for _ in range(batch.num_rows)]
        for held in blocks(codec, _texts(batch.column(1))):
            ids, at = codec.encode(list(chain.from_iterable(pieces for _, pieces in held)))
            data, place = codec.decode(ids)
            first = 0
            for row, pieces in held:
                last = first + len(pieces)
                a, b = int(at[first]), int(at[last])
                of_ids[row].update(ids[a:b])
                of_bytes[row].update(data[place[a] : place[b]])
                n_tokens[row] += b - a
                first = last
        yield records(
            doc_id=batch.column(0),
            n_tokens=n_tokens,
            ids_sha256=pa.array([h.hexdigest() for h in of_ids], pa.string()),
            decoded_sha256=pa.array([h.hexdigest() for h in of_bytes], pa.string()),
        )

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_batches(_rows(docs), step, schema)
