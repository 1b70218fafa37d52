"""SimHash near-duplicates: fingerprints, pigeonhole block join, exact components.

The fingerprint of a text is the bitwise majority over the XXH64 values (seed 42) of its
word shingles. Two fingerprints that differ in at most ``distance`` bits agree in at
least ``blocks - distance`` of ``blocks`` bit ranges, so they meet under the key of one
such choice of ranges. Copies share a fingerprint and are one row from there on.

Rows: null and empty texts have no shingles and fingerprint zero, and are linked like
any other; a null id is never a component's id; repeated rows are separate rows with
one fingerprint; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesight.llm import text as T
from salesight.llm.components import components
from salesight.llm.tables import column, free_names, map_batches, records, text_key, write_table

SEED = 42
BLOCKS = 6


def shingle_hashes(chunk: T.Chunk, width: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of the chunk's shingles, repeats included, and where each row's begin."""
    lower = T.LOWER[chunk.data]
    member = T.SPACED[lower]
    found = T.runs(member, chunk.bounds)
    kept = member.copy()
    kept[found.ends[found.ends < len(kept)]] = True
    moved = np.concatenate([[0], np.cumsum(kept)])
    lower[~member] = 0x20
    joined = lower[kept].tobytes()
    n_words = np.diff(found.rows)
    counts = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    rows = np.concatenate([[0], np.cumsum(counts)])
    owner = T.row_of(rows)
    first = found.rows[owner] + np.arange(rows[-1]) - rows[owner]
    last = np.minimum(first + width, found.rows[owner + 1]) - 1
    starts, ends = moved[found.starts[first]], moved[found.ends[last]]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
    return np.array(hashes, np.uint64), rows


def majority_bits(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """One fingerprint per row: a bit is set if over half of the row's hashes set it."""
    found = np.zeros(len(rows) - 1, np.uint64)
    counts = np.diff(rows)
    full = np.flatnonzero(counts)
    if len(full):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes = np.add.reduceat(bits, rows[full], axis=0, dtype=np.int32)
        won = np.packbits(2 * votes > counts[full, None], axis=1)
        found[full] = np.ascontiguousarray(won).view(">u8").ravel()
    return found


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, tk and fingerprint ``fp`` (a signed 64-bit integer) of every row."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        made = [majority_bits(*shingle_hashes(c, width)) for c in T.chunks(batch.column(2))]
        if made:
            yield records(doc_id=batch.column(0), tk=batch.column(1), fp=T.signed(np.concatenate(made)))

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_key(F.col("text")).alias("tk"), "text"
    )
    return map_batches(rows, step, "doc_id bigint, tk bigint, fp bigint")


def block_masks(distance: int, blocks: int = BLOCKS) -> list[int]:
    """A bit mask for every choice of ``blocks - distance`` of the ``blocks`` bit ranges."""
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    ranges = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(ranges, blocks - distance)]


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint")


def close_pairs(fps: DataFrame, distance: int = 3, blocks: int = BLOCKS) -> DataFrame:
    """Every pair u < v of the distinct values ``fp`` that differ in 1 to ``distance`` bits, once."""
    masks = block_masks(distance, blocks)
    keys = F.array(
        *[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(_signed(m)).alias("key")) for i, m in enumerate(masks)]
    )
    keyed = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.choice", "k.key")
    left = keyed.select(F.col("fp").alias("u"), "choice", "key")
    right = keyed.select(F.col("fp").alias("v"), "choice", "key")
    differing = F.col("u").bitwiseXOR(F.col("v"))
    joined = left.join(right, ["choice", "key"]).filter(
        (F.col("u") < F.col("v")) & (F.bit_count(differing) <= distance)
    )
    met = [F.when(differing.bitwiseAND(_signed(m)) == 0, F.lit(i)) for i, m in enumerate(masks)]
    return joined.filter(F.col("choice") == F.coalesce(*met)).select("u", "v")


def near_duplicates(
    docs: DataFrame, width: int = 3, distance: int = 3, blocks: int = BLOCKS
) -> DataFrame:
    """doc_id, tk, fp and the component of every row: component_id, the smallest id reachable
    over links, and ``first``, the row (unnamed, doc_id, tk) that comes first in it."""
    rows = write_table(fingerprints(docs, width), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tk")
    distinct = write_table(
        rows.groupBy("fp").agg(F.min("doc_id").alias("lo"), F.min(place).alias("first")), "distinct-fp"
    )
    linked = components(close_pairs(distinct.select("fp"), distance, blocks))
    roots = distinct.join(linked, distinct.fp == linked.u, "left").select(
        "fp", "lo", "first", F.coalesce("root", "fp").alias("root")
    )
    least = roots.groupBy("root").agg(F.min("lo").alias("component_id"), F.min("first").alias("first"))
    named = roots.select("fp", "root").join(least, "root").drop("root")
    return rows.join(named, "fp").select("doc_id", "tk", "fp", "component_id", "first")


def one_of_each(docs: DataFrame, width: int = 3, distance: int = 3, blocks: int = BLOCKS) -> DataFrame:
    """``docs``, with all their columns, reduced to the first row of each component.

    Rows come by id, null last, then by a hash of the text; of rows equal in both one stays.
    """
    return first_rows(docs, near_duplicates(docs, width, distance, blocks))


def first_rows(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Those of ``docs`` that come first by ``found`` (doc_id, tk and the first row's place).

    Rows go, or are ordered among their equals, by a table of the keys that are not first or
    stand for several rows; where that is small, Catalyst broadcasts it and no text moves.
    """
    here = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tk")
    d, t, nth = free_names(docs, "_d", "_t", "_nth")
    keys = found.groupBy("doc_id", "tk").agg(F.max(here == F.col("first")).alias("stays"), F.count(F.lit(1)).alias("n"))
    odd = write_table(keys.filter("n > 1 OR NOT stays"), "odd-keys")
    gone = odd.select(F.col("doc_id").alias(d), F.col("tk").alias(t), "stays")
    again = gone.filter("stays").drop("stays")
    same = docs.doc_id.cast("bigint").eqNullSafe(F.col(d)) & (text_key(docs.text) == F.col(t))
    columns = [column(c) for c in docs.columns]
    lone = docs.join(gone.drop("stays"), same, "left_anti").select(*columns)
    equal = Window.partitionBy(d, t).orderBy(F.xxhash64(*columns))
    ordered = docs.join(again, same).withColumn(nth, F.row_number().over(equal))
    return lone.unionByName(ordered.filter(F.col(nth) == 1).select(*columns))


def fingerprint_text(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
