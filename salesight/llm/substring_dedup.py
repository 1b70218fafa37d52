"""Substring dedup: words inside a window that an earlier document has as well.

Windows double in length: those of the base length that are repeated in another document
are extended to twice that length, and only what is repeated at that length counts.

* Base level. Every long window is represented by the least hash among the base windows
  it holds, its anchor. Equal long windows have equal anchors, so an anchor found in one
  document alone drops all windows behind it. Neighbouring windows mostly share one, so
  a run of windows is one row (anchor, hash of the run's words).
* Extension. A run that stands in several documents is a repeat for all but the smallest
  id. Where one anchor has different runs, the run's first holder is read again and its
  long windows are compared one by one; copies of a run follow its first holder.

Groups are reduced to minima before any shuffle, so copies by the million cost one row
per task. Keys are pairs of 64-bit hashes (anchor and run, anchor and window).

Rows: a null text has no words; a row with a null id is left whole and removes nothing;
rows of one id do not remove from each other, be they equal or not; texts shorter than a
window are kept whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesight.llm import text as T
from salesight.llm.tables import map_batches, pack_texts, records, text_key, unpack, write_table

RUN_SCHEMA = "anchor bigint, run bigint, doc_id bigint, tk bigint, start int, n int"


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost minimum of every ``width`` neighbours."""
    best, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        left, right = best[:-step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        span += step
    return best


class Windows:
    """The long windows of a chunk's rows, their anchors and runs."""

    def __init__(self, chunk: T.Chunk, window: int):
        self.window, base = window, (window + 1) // 2
        found = T.words(chunk)
        self.rows = found.rows
        total = len(found.starts)
        self.hasher = T.Hasher(T.word_hashes(chunk.data, found))
        if total < window:
            self.starts = self.first = self.count = np.zeros(0, np.int64)
            return
        at = np.arange(total - base + 1)
        bases = self.hasher(at, at + base)
        anchors = sliding_argmin(bases, window - base + 1)
        end_of_row = np.repeat(found.rows[1:], np.diff(found.rows))
        starts = np.flatnonzero(np.arange(len(anchors)) + window <= end_of_row[: len(anchors)])
        owner = T.row_of(found.rows)[starts]
        anchors = anchors[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (np.diff(anchors) != 0) | (np.diff(owner) != 0)
        self.first = starts[new]
        self.count = np.diff(np.append(np.flatnonzero(new), len(starts)))
        self.owner = owner[new]
        self.anchor = bases[anchors[new]]
        words = self.hasher(self.first, self.first + self.count + window - 1)
        self.run = T.mix(words + T.mix((anchors[new] - self.first).astype(np.uint64)))

    def hashes(self, starts: np.ndarray) -> np.ndarray:
        return self.hasher(starts, starts + self.window, seed=1)


def _keyed(docs: DataFrame) -> DataFrame:
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_key(F.col("text")).alias("tk"), "text"
    )
    return keyed.filter("doc_id IS NOT NULL")


def runs(docs: DataFrame, window: int) -> DataFrame:
    """Every run of windows with one anchor: where it starts and how many windows it has."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for chunk in T.chunks(batch.column(2)):
            found = Windows(chunk, window)
            if len(found.first):
                owner = found.owner + chunk.first
                yield records(
                    anchor=T.signed(found.anchor),
                    run=T.signed(found.run),
                    doc_id=ids[owner],
                    tk=keys[owner],
                    start=(found.first - found.rows[found.owner]).astype(np.int32),
                    n=found.count.astype(np.int32),
                )

    return map_batches(_keyed(docs), step, RUN_SCHEMA)


def _first_window_holders(docs: DataFrame, readers: DataFrame, window: int) -> DataFrame:
    """For the runs in ``readers``, the offsets of windows that a smaller id has as well."""
    asked = readers.groupBy("doc_id", "tk").agg(
        F.collect_list(F.struct("start", "n", "anchor", "run")).alias("asked")
    )
    texts = pack_texts(docs.filter("doc_id IS NOT NULL")).dropDuplicates(["doc_id", "tk"])
    schema = "anchor bigint, hash bigint, run bigint, offset int, doc_id bigint"

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(batch.num_rows):
            (chunk,) = T.chunks(pa.array([unpack(batch.column(1)[i])]))
            hasher = Windows(chunk, window)
            wanted = batch.column(2)[i].values
            start, n, anchor, run = (wanted.field(k).to_numpy() for k in range(4))
            each = np.repeat(np.arange(len(start)), n)
            offset = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            yield records(
                anchor=anchor[each],
                hash=T.signed(hasher.hashes(start[each] + offset)),
                run=run[each],
                offset=offset.astype(np.int32),
                doc_id=np.full(len(each), batch.column(0)[i].as_py()),
            )

    joined = texts.join(asked, ["doc_id", "tk"]).select("doc_id", "packed", "asked")
    windows = write_table(map_batches(joined, step, schema), "windows")
    least = windows.groupBy("anchor", "hash").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")
    )
    later = windows.join(least.filter("lo < hi"), ["anchor", "hash"]).filter("doc_id > lo")
    return later.groupBy("anchor", "run").agg(F.collect_list("offset").alias("offsets"))


def repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """doc_id, tk and ``marks``: starts and counts of the windows that a smaller id has too.

    A mark is a run of ``n`` repeated windows from word ``start`` on; ``offsets`` names the
    repeated ones where not all are.
    """
    found = runs(docs, window)
    anchors = found.groupBy("anchor").agg(
        F.min("doc_id").alias("lo"),
        F.max("doc_id").alias("hi"),
        (F.min("run") != F.max("run")).alias("varied"),
    )
    # written, so that the join deals both sides itself and can split a hot anchor
    anchors = write_table(anchors.filter("lo < hi").select("anchor", "varied"), "anchors")
    repeated = write_table(found.join(anchors, "anchor"), "repeated")
    holders = repeated.groupBy("anchor", "run").agg(
        F.min(F.struct("doc_id", "tk", "start", "n")).alias("first"),
        F.first("varied").alias("varied"),
        F.max("doc_id").alias("hi"),
    )
    holders = write_table(
        holders.select("anchor", "run", "first.*", "varied", "hi"), "first-holders"
    )
    offsets = _first_window_holders(docs, holders.filter("varied"), window)
    verdicts = (
        holders.select("anchor", "run", F.col("doc_id").alias("lo"), "hi")
        .join(offsets, ["anchor", "run"], "left")
        .filter("lo < hi OR offsets IS NOT NULL")
    )
    verdicts = write_table(verdicts, "verdicts")
    marked = repeated.join(verdicts, ["anchor", "run"]).withColumn(
        "offsets", F.when(F.col("doc_id") == F.col("lo"), F.col("offsets"))
    )
    marked = marked.filter("doc_id > lo OR offsets IS NOT NULL")
    return marked.groupBy("doc_id", "tk").agg(
        F.collect_list(F.struct("start", "n", "offsets")).alias("marks")
    )


def removed_words(n_words: int, marks: list[dict] | None, window: int) -> np.ndarray:
    """Which words the marked windows cover."""
    edge = np.zeros(n_words + 1, np.int32)
    for mark in marks or ():
        if mark["offsets"] is None:
            edge[mark["start"]] += 1
            edge[mark["start"] + mark["n"] + window - 1] -= 1
        else:
            for offset in mark["offsets"]:
                edge[mark["start"] + offset] += 1
                edge[mark["start"] + offset + window] -= 1
    return np.cumsum(edge[:-1]) > 0


def drop_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept (the words left, joined by one space)."""
    marks = write_table(repeats(docs, window), "marks")
    joined = pack_texts(docs).join(marks, ["doc_id", "tk"], "left").select("doc_id", "packed", "marks")

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n_words, n_removed, kept = [], [], []
        for packed, marks in zip(batch.column(1), batch.column(2), strict=True):
            words = unpack(packed).encode().split()
            gone = removed_words(len(words), marks.as_py(), window)
            n_words.append(len(words))
            n_removed.append(int(gone.sum()))
            if n_removed[-1]:
                words = [words[i] for i in np.flatnonzero(~gone)]
            kept.append(b" ".join(words).decode())
        yield records(
            doc_id=batch.column(0),
            n_words=pa.array(n_words, pa.int64()),
            n_removed=pa.array(n_removed, pa.int64()),
            kept=pa.array(kept, pa.string()),
        )

    return map_batches(joined, step, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


