"""Benchmark decontamination by spaced-seed hashing.

A seed is the hash of the tokens at a mask's places; tokens at its other places may
differ. Hashes of all places of the test items are looked up for all places of the
training texts, and around each hit the two texts are compared token by token. A
document is contaminated by an item if ``SPAN`` tokens of both in a row agree in all but
``SUBSTITUTIONS``. The masks find every such overlap: wherever two differing tokens lie
among thirteen, one mask fits between them (a test tries all placements).

Tokens are runs of letters and digits with A-Z in lower case, so punctuation and markup
around words do not matter. Items of fewer than ``SPAN`` tokens are looked for whole,
without substitutions; items of fewer than ``LEAST`` tokens match nothing.

The test items are read in blocks of a bounded size; each block is broadcast and meets
all training texts in one scan without a shuffle.

Rows: null texts match nothing; null or repeated ids are reported as they are, one row
for each training row and distinct item; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesight.llm import text as T
from salesight.llm.tables import map_batches, records

SPAN = 13
SUBSTITUTIONS = 2
LEAST = 6
#: Places whose tokens count.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))
#: Bytes of test text in a block.
BLOCK_BYTES = 4 << 20

SCHEMA = "doc_id bigint, item_id bigint, start_word bigint, end_word bigint, n_equal bigint"


def tokens(chunk: T.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a chunk and where each row's begin."""
    chunk = chunk._replace(data=T.LOWER[chunk.data])
    found = T.words(chunk, T.ALNUM)
    return T.word_hashes(chunk.data, found), found.rows


def masked(hashes: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """The seed at every place, row bounds left aside."""
    n = max(0, len(hashes) - mask[-1])
    total = np.full(n, len(mask), np.uint64)
    for k, place in enumerate(mask):
        total += hashes[place : place + n] * np.uint64((k * 0x9E3779B97F4A7C15 | 1) % (1 << 64))
    return T.mix(total)


class Seeds(NamedTuple):
    """All seeds of a block of test items."""

    ids: pa.Array  # of items, null where an item has none
    tokens: np.ndarray
    rows: np.ndarray  # where each item's tokens begin
    masks: list[tuple[int, ...]]
    keys: list[np.ndarray]  # sorted seeds of each mask
    places: list[np.ndarray]  # the token each of them starts at
    sieve: list[np.ndarray]  # by low bits: whether any seed has them


def seeds(ids: pa.Array, hashes: np.ndarray, rows: np.ndarray) -> Seeds:
    lengths = np.diff(rows)
    short = sorted({int(n) for n in lengths if LEAST <= n < SPAN})
    masks = [*MASKS, *(tuple(range(n)) for n in short)]
    owner = T.row_of(rows)
    made = Seeds(ids, hashes, rows, masks, [], [], [])
    for mask in masks:
        found = masked(hashes, mask)
        at = np.arange(len(found))
        length = lengths[owner[at]]
        whole = len(mask) == mask[-1] + 1
        fits = (length == len(mask)) if whole else (length >= SPAN)
        at = at[fits & (at + mask[-1] < rows[owner[at] + 1])]
        order = at[np.argsort(found[at], kind="stable")]
        made.keys.append(found[order])
        made.places.append(order)
        sieve = np.zeros(1 << min(26, max(12, int(len(order)).bit_length() + 7)), bool)
        sieve[(found[order] & np.uint64(len(sieve) - 1)).astype(np.int64)] = True
        made.sieve.append(sieve)
    return made


def overlap(ours: np.ndarray, theirs: np.ndarray) -> tuple[int, int, int] | None:
    """Of two aligned token sequences: first and last token that an agreeing window covers,
    and the number of equal tokens between, or None."""
    width = min(SPAN, len(theirs))
    allowed = SUBSTITUTIONS if width == SPAN else 0
    if len(ours) < width:
        return None
    equal = ours == theirs
    total = np.concatenate([[0], np.cumsum(equal)])
    good = np.flatnonzero(total[width:] - total[:-width] >= width - allowed)
    if not len(good):
        return None
    first, last = int(good[0]), int(good[-1]) + width
    return first, last - 1, int(total[last] - total[first])


def matches(test: Seeds, hashes: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, first word, last word, equal words), the best alignment of each row and item."""
    hits = []
    for mask, keys, places, sieve in zip(test.masks, test.keys, test.places, test.sieve, strict=True):
        found = masked(hashes, mask)
        at = np.flatnonzero(sieve[(found & np.uint64(len(sieve) - 1)).astype(np.int64)])
        low = np.searchsorted(keys, found[at], "left")
        count = np.searchsorted(keys, found[at], "right") - low
        each = np.repeat(np.arange(len(at)), count)
        nth = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
        hits.append(np.stack([at[each], places[low[each] + nth]], axis=1))
    pairs = np.concatenate(hits)
    if not len(pairs):
        return
    row = np.searchsorted(rows, pairs[:, 0], "right") - 1
    item = np.searchsorted(test.rows, pairs[:, 1], "right") - 1
    shift = (pairs[:, 0] - rows[row]) - (pairs[:, 1] - test.rows[item])
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for r, i, d in np.unique(np.stack([row, item, shift], axis=1), axis=0).tolist():
        theirs = test.tokens[test.rows[i] : test.rows[i + 1]]
        ours = hashes[rows[r] : rows[r + 1]]
        if len(theirs) < SPAN:
            cut = slice(0, len(theirs)) if 0 <= d <= len(ours) - len(theirs) else slice(0, 0)
        else:
            cut = slice(max(0, -d), max(0, min(len(theirs), len(ours) - d)))
        theirs = theirs[cut]
        found = overlap(ours[cut.start + d : cut.start + d + len(theirs)], theirs) if len(theirs) else None
        if found:
            first, last, equal = found
            new = (equal, -(cut.start + d + first), -(cut.start + d + last))
            best[r, i] = max(best.get((r, i), new), new)
    for (r, i), (equal, first, last) in best.items():
        yield r, i, -first, -last, equal


def _block(items: DataFrame) -> Seeds:
    rows = items.collect()  # a block: bounded by BLOCK_BYTES, or one item
    ids = pa.array([r.item_id for r in rows], pa.int64())
    hashes, bounds = [], [np.zeros(1, np.int64)]
    for chunk in T.chunks(pa.array([r.text for r in rows], pa.string())):
        found, starts = tokens(chunk)
        hashes.append(found)
        bounds.append(starts[1:] + bounds[-1][-1])
    return seeds(ids, np.concatenate([*hashes, np.zeros(0, np.uint64)]), np.concatenate(bounds))


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[Broadcast]:
    """The benchmark's seeds, a block of items at a time, on every worker."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter(
        "text IS NOT NULL"
    )
    items = items.distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
        yield items.sparkSession.sparkContext.broadcast(_block(items.filter(mine)))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row for each row of ``docs`` and test item that overlap: doc_id, item_id, the first
    and last word covered (words of the document from 0), and the equal words in between."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = []
    for shared in _blocks(benchmark, block_bytes):

        def step(batch: pa.RecordBatch, shared=shared) -> Iterator[pa.RecordBatch]:
            test, ids = shared.value, batch.column(0)
            for chunk in T.chunks(batch.column(1)):
                hits = list(matches(test, *tokens(chunk)))
                if hits:
                    row, item, first, last, equal = np.array(hits).T
                    yield records(
                        doc_id=ids.take(pa.array(row + chunk.first)),
                        item_id=test.ids.take(pa.array(item)),
                        start_word=first,
                        end_word=last,
                        n_equal=equal,
                    )

        found.append(map_batches(rows, step, SCHEMA))
    return reduce(DataFrame.unionAll, found or [docs.sparkSession.createDataFrame([], SCHEMA)])


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that no test item overlaps."""
    schema, at = docs.schema, docs.columns.index("text")
    docs = docs.toDF(*[f"c{i}" for i in range(len(schema))])  # names with dots have no way into batches
    for shared in _blocks(benchmark, block_bytes):

        def step(batch: pa.RecordBatch, shared=shared) -> Iterator[pa.RecordBatch]:
            clean = np.ones(batch.num_rows, bool)
            for chunk in T.chunks(batch.column(at)):
                for hit in matches(shared.value, *tokens(chunk)):
                    clean[chunk.first + hit[0]] = False
            yield batch.filter(pa.array(clean))

        docs = map_batches(docs, step, docs.schema)
    return docs.toDF(*schema.names)
