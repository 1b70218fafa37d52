"""Token counts by a two-tier lookup on the map side.

A pre-token is a run of characters without ASCII white space. The tokenizer must treat
such runs on their own: then a text has as many tokens as its pre-tokens have together.
Lengths of frequent pre-tokens come from a compact hash table that is broadcast; those
it lacks are encoded by the tokenizer, once for each worker as far as its bounded cache
reaches. No pre-token is ever shuffled.

Rows: a null text counts as empty (0 bytes, 0 tokens); ids may be null or repeat.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesight.llm import text as T
from salesight.llm.tables import map_batches, records

#: The table of frequent pre-tokens: entries, and documents sampled to find them. Both
#: only decide how often a worker has to encode, never a count.
TABLE_ENTRIES = 30_000
TABLE_DOCS = 2_000
#: Pre-tokens that a batch of sampled documents names, at most.
BATCH_ENTRIES = 4_000
#: Entries of a worker's cache; a full cache starts anew.
CACHE_ENTRIES = 300_000

_workers: dict[str, Encoder] = {}


class LengthTable:
    """Open addressing over 64-bit hashes, looked up a whole array at a time."""

    def __init__(self, hashes: np.ndarray, lengths: np.ndarray):
        self.mask = (1 << max(4, int(len(hashes) * 2).bit_length())) - 1
        self.keys = np.zeros(self.mask + 1, np.uint64)
        self.lengths = np.full(self.mask + 1, -1, np.int32)
        self.probes = 1
        for key, length in zip(hashes.tolist(), lengths.tolist(), strict=True):
            at, tried = key & self.mask, 1
            while self.lengths[at] >= 0:
                at, tried = (at + 1) & self.mask, tried + 1
            self.keys[at], self.lengths[at] = key, length
            self.probes = max(self.probes, tried)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The length of each pre-token, or -1."""
        found = np.full(len(hashes), -1, np.int32)
        at = (hashes & np.uint64(self.mask)).astype(np.int64)
        left = np.arange(len(hashes))
        for _ in range(self.probes):
            hit = (self.keys[at] == hashes[left]) & (self.lengths[at] >= 0)
            found[left[hit]] = self.lengths[at[hit]]
            on = ~hit & (self.lengths[at] >= 0)
            left, at = left[on], (at[on] + 1) & self.mask
        return found


class Encoder:
    """A worker's tokenizer with its cache of lengths."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cache: dict[bytes, int] = {}

    def lengths(self, tokens: list[bytes]) -> list[int]:
        new = [t for t in tokens if t not in self.cache]
        if len(self.cache) + len(new) > CACHE_ENTRIES:
            self.cache, new = {}, tokens
        if new:
            texts = [t.decode("utf-8", "replace") for t in new]
            encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            self.cache.update(zip(new, (len(e) for e in encoded), strict=True))
        return [self.cache[t] for t in tokens]


def worker_encoder(definition: str) -> Encoder:
    if definition not in _workers:
        _workers.clear()
        _workers[definition] = Encoder(definition)
    return _workers[definition]


def frequent_pre_tokens(docs: DataFrame, entries: int, sample_docs: int) -> list[bytes]:
    """The pre-tokens that are most frequent in a bounded sample of documents."""
    total = docs.count()
    if not total:
        return []
    sample = docs.select("text").sample(fraction=min(1.0, sample_docs / total), seed=1)

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for value in batch.column(0):
            seen.update((value.as_py() or "").encode().split())
        top = seen.most_common(min(entries, BATCH_ENTRIES))
        yield records(
            token=pa.array([t for t, _ in top], pa.binary()),
            n=pa.array([n for _, n in top], pa.int64()),
        )

    together: Counter[bytes] = Counter()
    for row in map_batches(sample, count, "token binary, n bigint").collect():
        together[bytes(row.token)] += row.n
    return [t for t, _ in together.most_common(entries)]


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = 2048,
    entries: int = TABLE_ENTRIES,
    sample_docs: int = TABLE_DOCS,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs`` (doc_id, text).

    ``tokenizer_path`` names a file of the tokenizers library. It is read on the driver
    and sent to the workers with the table: its vocabulary and ``entries`` bound both.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    frequent = frequent_pre_tokens(docs, entries, sample_docs)
    joined = np.frombuffer(b" ".join(frequent), np.uint8)
    chunk = T.Chunk(0, 1, joined, np.array([0, len(joined)]))
    hashes = T.word_hashes(joined, T.words(chunk))
    lengths = np.array(Encoder(definition).lengths(frequent), np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((definition, LengthTable(hashes, lengths)))

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        definition, table = shared.value
        encoder = worker_encoder(definition)
        n_bytes, n_tokens = [], []
        for chunk in T.chunks(batch.column(1)):
            found = T.words(chunk)
            hashes = T.word_hashes(chunk.data, found)
            lengths = table.find(hashes)
            missed = np.flatnonzero(lengths < 0)
            if len(missed):
                _, first, back = np.unique(hashes[missed], return_index=True, return_inverse=True)
                raw, at = chunk.data.tobytes(), missed[first]
                tokens = [
                    raw[s:e]
                    for s, e in zip(found.starts[at].tolist(), found.ends[at].tolist(), strict=True)
                ]
                lengths[missed] = np.array(encoder.lengths(tokens), np.int32)[back]
            n_tokens.append(T.per_row(lengths, found.rows))
            n_bytes.append(np.diff(chunk.bounds))
        if n_bytes:
            yield records(
                doc_id=batch.column(0),
                n_bytes=np.concatenate(n_bytes),
                n_tokens=np.concatenate(n_tokens),
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    counted = map_batches(rows, count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
