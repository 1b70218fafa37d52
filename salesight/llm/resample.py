"""Importance resampling towards a target: hashed n-gram features, log ratios, top scores.

A text's features are its runs of 1 to ``width`` consecutive words, joined by one space,
repeats included; a feature's bucket is the CRC-32 of its UTF-8 bytes modulo ``buckets``.
A bucket's gain is the log ratio of its smoothed shares in the target texts and in the
documents, a document's weight the sum of gains over its features. Weights plus Gumbel
noise from a hash of the id, highest first, draw documents without replacement, each with
chances in proportion to the exponent of its weight.

Method, inside tasks: the distinct features of a chunk of rows are grouped by byte length
into two-dimensional arrays, the CRCs of a group advance together, one column of bytes
at a time, and the buckets are scattered back to all occurrences. Only bucket counts (a fixed
number of them, added up per task and then shuffled) and one gain per bucket travel;
features are computed again for the weights rather than stored. The draw needs ranks of
the best only, and takes them from range partitions.

Rows: a null text has no words; a text longer than a chunk is worked off in pieces cut
between words, the last ``width - 1`` words carried over, so memory follows the chunk and the
longest word; repeated rows are documents of their own, with equal scores, ranked next to
each other; a null id is hashed as an empty one and comes last among equal scores; with no
target text every bucket counts as empty there; an empty table gives an empty result.
Columns but doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesight.llm import text as T
from salesight.llm.tables import map_batches, records, text_key, write_table
from salesight.operators.ordering import running_before

WIDTH = 3
BUCKETS = 10_000
LEAST_WORDS = 20
SEED = 42
#: Groups with fewer features than this are hashed one by one: no column to share.
LEAST_GROUP = 16


def _crc_steps() -> np.ndarray:
    """What each low byte adds to the CRC-32 (reflected polynomial 0xEDB88320)."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = (steps >> 1) ^ np.where(steps & 1, np.uint32(0xEDB88320), np.uint32(0))
    return steps


_STEPS = _crc_steps()


def crc_rows(matrix: np.ndarray) -> np.ndarray:
    """The CRC-32 of every row of a two-dimensional array of bytes, column by column."""
    crc = np.full(len(matrix), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(matrix.T):
        crc = _STEPS[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
    return ~crc


def crc_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of byte ranges, those of equal length together."""
    found = np.zeros(len(starts), np.uint32)
    lengths = ends - starts
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for group in np.split(order, cuts):
        if not len(group):
            continue
        length = int(lengths[group[0]])
        if len(group) < LEAST_GROUP:
            found[group] = [zlib.crc32(data[s : s + length]) for s in starts[group].tolist()]
        else:
            windows = np.lib.stride_tricks.sliding_window_view(data, length)
            found[group] = crc_rows(windows[starts[group]])
    return found


class Features(NamedTuple):
    """Buckets of the features of some rows, the row of each, and each row's words."""

    buckets: np.ndarray
    rows: np.ndarray
    n_words: np.ndarray


def features(
    chunk: T.Chunk, width: int = WIDTH, buckets: int = BUCKETS, carried: int = 0
) -> Features:
    """Features of a chunk; those that end in the first ``carried`` words were counted before."""
    lower = chunk._replace(data=T.LOWER[chunk.data])
    found = T.words(lower, T.ALNUM)
    joined, at = T.joined(lower.data, found)
    stop = at + found.ends - found.starts
    owner = T.row_of(found.rows)
    nth = np.arange(len(at)) - found.rows[owner]
    lasts = [np.flatnonzero((nth >= n) & (np.arange(len(at)) >= carried)) for n in range(width)]
    starts = np.concatenate([at[last - n] for n, last in enumerate(lasts)])
    last = np.concatenate(lasts)
    ends = stop[last]
    hashes = T.byte_hasher(joined)(starts, ends)
    _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
    crc = crc_ranges(joined, starts[first], ends[first])
    n_words = np.diff(found.rows) - (carried if len(found.rows) == 2 else 0)
    return Features((crc % np.uint32(buckets)).astype(np.int64)[back], owner[last], n_words)


def _tail(chunk: T.Chunk, words: int) -> np.ndarray:
    """The last words of a one-row chunk, each with a space after it."""
    found = T.words(chunk, T.ALNUM)
    at = max(0, len(found.starts) - words)
    kept = [chunk.data[s:e] for s, e in zip(found.starts[at:], found.ends[at:], strict=True)]
    space = np.array([0x20], np.uint8)
    return np.concatenate([x for word in kept for x in (word, space)] or [space[:0]])


def row_features(texts: pa.Array, width: int, buckets: int) -> Iterator[tuple[int, Features]]:
    """Features of all rows, a chunk or a piece of a long text at a time, with the first row."""
    for chunk in T.chunks(texts):
        if len(chunk.data) <= 2 * T.CHUNK_BYTES:
            yield chunk.first, features(chunk, width, buckets)
            continue
        before = np.zeros(0, np.uint8)
        for piece in T.pieces(chunk.data, T.ALNUM):
            carried = int(np.count_nonzero(before == 0x20))
            data = np.concatenate([before, piece])
            part = T.Chunk(chunk.first, chunk.last, data, np.array([0, len(data)]))
            yield chunk.first, features(part, width, buckets, carried)
            before = _tail(part, width - 1)


def bucket_counts(texts: DataFrame, width: int = WIDTH, buckets: int = BUCKETS) -> DataFrame:
    """bucket and n, the number of features of all ``texts`` (text) in it; empty ones are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, found in row_features(batch.column(0), width, buckets):
                total += np.bincount(found.buckets, minlength=buckets)
        there = np.flatnonzero(total)
        yield records(bucket=there.astype(np.int32), n=total[there])

    counted = texts.select(F.col("text").cast("string")).mapInArrow(run, "bucket int, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(
    docs: DataFrame, target: DataFrame, width: int = WIDTH, buckets: int = BUCKETS
) -> DataFrame:
    """bucket and gain, in thousandths of the natural logarithm, for every bucket."""
    here = bucket_counts(docs, width, buckets).withColumnRenamed("n", "s")
    there = bucket_counts(target, width, buckets).withColumnRenamed("n", "t")
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(here, "bucket", "left").join(there, "bucket", "left").na.fill(0)
    both = write_table(both, "bucket-counts")
    s, t, n = F.col("s").cast("double"), F.col("t").cast("double"), float(buckets)
    totals = both.agg(F.sum("s").cast("double"), F.sum("t").cast("double")).first()
    ratio = ((t + 1) * F.lit(totals[0] + n)) / ((s + 1) * F.lit(totals[1] + n))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("bigint").alias("gain"))


def weights(
    docs: DataFrame, gain: np.ndarray, width: int = WIDTH
) -> DataFrame:
    """doc_id, tk (see ``tables.text_key``), n_words, n_features and weight of every row.

    ``gain`` has one value for each bucket and is broadcast.
    """
    buckets = len(gain)
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        figures = np.zeros((3, batch.num_rows), np.int64)
        for first, found in row_features(batch.column(2), width, buckets):
            n = len(found.n_words)
            here = figures[:, first : first + n]
            here[0] += found.n_words
            order = np.concatenate([[0], np.cumsum(np.bincount(found.rows, minlength=n))])
            by_row = np.argsort(found.rows, kind="stable")
            here[1] += np.diff(order)
            here[2] += T.per_row(shared.value[found.buckets[by_row]], order)
        yield records(
            doc_id=batch.column(0), tk=batch.column(1),
            n_words=figures[0], n_features=figures[1], weight=figures[2],
        )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text_key(F.col("text")).alias("tk"),
        F.col("text").cast("string").alias("text"),
    )
    schema = "doc_id bigint, tk bigint, n_words bigint, n_features bigint, weight bigint"
    return map_batches(rows, step, schema)


def noise(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise, in thousandths, from the first 32 bits of a hash of the key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    uniform = (drawn + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    width: int = WIDTH,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, tk, n_words, n_features, weight, score and rank of every row of ``docs``.

    Of the N documents of ``least_words`` words or more, the floor(percent * N / 100) with
    the highest scores are drawn and have a rank from 1 on; ties go to the smaller id.
    """
    found = gains(docs, target, width, buckets).collect()  # one row per bucket
    gain = np.zeros(buckets, np.int64)
    gain[[r.bucket for r in found]] = [r.gain for r in found]
    score = F.col("weight") + noise(F.col("doc_id"), seed)
    fit = (F.col("n_words") >= least_words).cast("int")
    scored = weights(docs, gain, width).withColumns({"score": score, "fit": fit})
    scored = scored.withColumn("copy", F.monotonically_increasing_id())
    order = [F.desc("fit"), F.desc("score"), F.col("doc_id").asc_nulls_last(), F.col("tk"), F.col("copy")]
    placed = running_before(write_table(scored, "scored"), order, F.col("fit").cast("bigint"), "ahead", total="n")
    drawn = (F.col("fit") == 1) & (F.col("ahead") < F.expr(f"n * {percent} div 100"))
    rank = F.when(drawn, F.col("ahead") + 1).cast("bigint")
    return placed.withColumn("rank", rank).drop("fit", "ahead", "n", "copy")
