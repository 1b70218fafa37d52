"""Line dedup with a segment-partition edit join.

A line goes if an equal line, or one within ``distance`` edits of it, stands earlier in
the corpus (by doc_id, then line). Lines are compared without surrounding white space.
Equal lines go at any length but blank ones; near lines from ``NEAR_CHARS`` code points.
A ``least`` that is given holds for both: lines shorter than it always stay.

Near lines: every distinct line is split into distance + 1 segments. Of two lines within
the distance, the longer holds one of the shorter's segments unchanged, shifted by no
more than the edits before and after it allow, so for each shorter length only those
places are probed. Keys that stand for one line alone go before the join. Pairs that
meet are compared by the parities of their characters and character pairs, which few
edits can change only a little, and the texts of the rest by banded bit-parallel edit
distance.

Rows: null texts have one empty line; null ids come last; rows of one id are ordered by
a hash of their texts, and rows equal in both are treated alike; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from salesight.llm import text as T
from salesight.llm.tables import column, free_names, map_batches, records, text_key, write_table

DISTANCE = 1
#: Code points from which equal lines go (blank lines have none), and near lines.
LEAST_CHARS = 1
NEAR_CHARS = 20
#: 64-bit words of the set that picks the lines to compare (8 MB).
SIEVE_WORDS = 1 << 20

_BAND = 64
_FULL = (1 << _BAND) - 1


def banded_distance(a: str, b: str, most: int) -> int:
    """The edit distance of two texts, or ``most`` + 1 if it is more (``most`` up to 31).

    The columns of the matrix are bit vectors of vertical differences that only hold the
    band around the diagonal, and move down with it.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return most + 1
    low, high = 0, len(b)
    while low < high and a[low] == b[low]:
        low += 1
    cut = 0
    while cut < high - low and a[len(a) - 1 - cut] == b[high - 1 - cut]:
        cut += 1
    a, b = a[low : len(a) - cut], b[low : high - cut]
    if not b or not most:
        return min(len(a), most + 1)
    if len(a) <= most:
        most_here = len(a)
    else:
        most_here = most
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    up, down = _FULL << (_BAND - most_here - 1) & _FULL, 0
    score, edge = most_here, 1 << (_BAND - 2)
    for i, c in enumerate(b):
        start = most_here + 1 - _BAND + i
        mask = places.get(c, 0)
        mask = (mask << -start if start < 0 else mask >> start) & _FULL
        diagonal = (((mask & up) + up) ^ up | mask | down) & _FULL
        plus, minus = down | ~(diagonal | up) & _FULL, diagonal & up
        if i < len(a) - most_here:
            score += not diagonal >> (_BAND - 1)
        else:
            score += bool(plus & edge) - bool(minus & edge)
            edge >>= 1
        up = minus | ~(diagonal >> 1 | plus) & _FULL
        down = diagonal >> 1 & plus
    return min(score, most + 1)


class Lines:
    """The stripped lines of a chunk: byte and code point ranges, hashes."""

    def __init__(self, chunk: T.Chunk):
        data = chunk.data
        raw, found = T.lines(chunk), T.words(chunk)
        first = np.searchsorted(found.starts, raw.starts)
        last = np.searchsorted(found.starts, raw.ends)
        blank = first == last
        at = np.append(found.starts, len(data))
        self.starts = np.where(blank, raw.starts, at[first])
        self.ends = np.where(blank, raw.starts, np.append(found.ends, 0)[last - 1])
        self.rows = raw.rows
        self.hasher = T.byte_hasher(data)
        self.ids = self.hasher(self.starts, self.ends, seed=2)
        #: Byte at which each code point begins, and the code point each line begins at.
        self.heads = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        self.first = np.searchsorted(self.heads, self.starts)
        self.chars = np.searchsorted(self.heads, self.ends) - self.first
        self.data = data

    def numbers(self) -> np.ndarray:
        """The number of each line in its row."""
        return np.arange(len(self.starts)) - self.rows[T.row_of(self.rows)]

    def sketches(self, which: np.ndarray) -> np.ndarray:
        """Parities of a line's characters (low half) and character pairs (high half)."""
        one = np.uint64(1)
        codes = np.add.reduceat(T._BYTE_VALUES[self.data], self.heads[:-1])
        pairs = T.mix(codes[:-1] * np.uint64(3) + codes[1:])
        singles = np.zeros(len(codes) + 1, np.uint64)
        doubles = np.zeros(len(codes) + 1, np.uint64)
        np.bitwise_xor.accumulate(one << (T.mix(codes) & np.uint64(31)), out=singles[1:])
        np.bitwise_xor.accumulate(one << (np.uint64(32) + (pairs & np.uint64(31))), out=doubles[1:-1])
        a, n = self.first[which], self.chars[which]
        return singles[a + n] ^ singles[a] ^ doubles[a + n - 1] ^ doubles[a]

    def segment_keys(self, which: np.ndarray, length: np.ndarray, segment: int, distance: int, place: np.ndarray) -> np.ndarray:
        """Hash of the code points that a segment of a line of ``length`` would have at ``place``."""
        begin, end = segment_bounds(length, segment, distance)
        a = self.first[which] + place
        key = self.hasher(self.heads[a], self.heads[a + end - begin], seed=3)
        return T.mix(key + T.mix((length * (distance + 1) + segment).astype(np.uint64)))


def segment_bounds(length: np.ndarray, segment: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    return length * segment // (distance + 1), length * (segment + 1) // (distance + 1)


def shifts(segment: int, longer_by: int, distance: int) -> range:
    """Places, from a segment's own on, at which a line longer by so much may hold it."""
    after = distance - segment
    low, high = max(-segment, longer_by - after), min(segment, longer_by + after)
    return range(low, high + 1)


def occurrences(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """line (a hash), doc_id, tk and ln of every line of at least ``least`` code points."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for chunk in T.chunks(batch.column(2)):
            lines = Lines(chunk)
            long = np.flatnonzero(lines.chars >= least)
            row = pa.array(T.row_of(lines.rows)[long] + chunk.first)
            yield records(
                line=T.signed(lines.ids[long]),
                doc_id=batch.column(0).take(row),
                tk=batch.column(1).take(row),
                ln=lines.numbers()[long].astype(np.int32),
            )

    return map_batches(_keyed(docs), step, "line bigint, doc_id bigint, tk bigint, ln int")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_key(F.col("text")).alias("tk"), "text"
    )


def segments(docs: DataFrame, distance: int = DISTANCE, least: int = NEAR_CHARS) -> DataFrame:
    """key, line, sketch, own: a row for each segment of a line (own) and each probe.

    Lines that a batch holds several times are taken once.
    """

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.uint64)
        for chunk in T.chunks(batch.column(2)):
            lines = Lines(chunk)
            long = np.flatnonzero(lines.chars >= least)
            ids, first = np.unique(lines.ids[long], return_index=True)
            new = ~np.isin(ids, seen)
            seen = np.concatenate([seen, ids[new]])
            which = long[first[new]]
            if not len(which):
                continue
            chars, keys, own = lines.chars[which], [], []
            sketch = lines.sketches(which)
            kept = []
            for shorter in range(distance + 1):
                length = chars - shorter
                for segment in range(distance + 1):
                    begin, end = segment_bounds(length, segment, distance)
                    for shift in shifts(segment, shorter, distance):
                        at = begin + shift
                        fits = (at >= 0) & (at + end - begin <= chars) & (length >= least)
                        place = np.flatnonzero(fits)
                        keys.append(lines.segment_keys(which[place], length[place], segment, distance, at[place]))
                        own.append(np.full(len(place), not shorter and not shift))
                        kept.append(place)
            place = np.concatenate(kept)
            yield records(
                key=T.signed(np.concatenate(keys)),
                line=T.signed(lines.ids[which][place]),
                sketch=T.signed(sketch[place]),
                own=np.concatenate(own),
            )

    return map_batches(_keyed(docs).select("doc_id", "tk", "text"), step, "key bigint, line bigint, sketch bigint, own boolean")


def candidates(rows: DataFrame, distance: int) -> DataFrame:
    """Pairs u, v of lines that share a key and whose sketches differ by few edits' worth."""
    keys = rows.groupBy("key").agg(
        F.min("line").alias("lo"), F.max("line").alias("hi"), F.max("own").alias("own")
    )
    shared = rows.join(keys.filter("lo <> hi AND own").select("key"), "key", "left_semi")
    shared = write_table(shared.distinct(), "shared-segments")
    left = shared.filter("own").select("key", F.col("line").alias("a"), F.col("sketch").alias("sa"))
    right = shared.select("key", F.col("line").alias("b"), F.col("sketch").alias("sb"), "own")
    changed = F.col("sa").bitwiseXOR(F.col("sb"))
    close = (F.bit_count(changed.bitwiseAND(F.lit((1 << 32) - 1))) <= 2 * distance) & (
        F.bit_count(F.shiftrightunsigned(changed, 32)) <= 4 * distance
    )
    # of two segments of equal place, one order of the pair is enough
    met = left.join(right, "key").filter(close & (F.col("a") != F.col("b")) & (~F.col("own") | (F.col("a") < F.col("b"))))
    return met.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()


def sieve(lines: DataFrame) -> np.ndarray:
    """A bit set of fixed size that holds every line's hash, to pass over most other lines.

    At most ``SIEVE_WORDS`` rows reach the driver, however many lines there are.
    """
    word = F.shiftrightunsigned("line", 6).bitwiseAND(F.lit(SIEVE_WORDS - 1)).cast("int")
    bit = F.expr("shiftleft(1L, cast(line & 63 as int))")
    # as Arrow columns: a million rows as Python objects take hundreds of MB of the driver
    rows = lines.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    made = np.zeros(SIEVE_WORDS, np.uint64)
    made[rows["word"].to_numpy().astype(np.int64)] = rows["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return made


def line_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """line and its text, once for each line of ``wanted`` (line).

    Texts are cut into lines where they are read; only lines that the sieve lets through
    are shuffled, and the join leaves out those it let through by chance.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sieve(wanted))

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bits, seen, one = shared.value, np.zeros(0, np.uint64), np.uint64(1)
        for chunk in T.chunks(batch.column(0)):
            lines = Lines(chunk)
            word = (lines.ids >> np.uint64(6)) & np.uint64(SIEVE_WORDS - 1)
            held = np.flatnonzero(bits[word.astype(np.int64)] >> (lines.ids & np.uint64(63)) & one)
            ids, first = np.unique(lines.ids[held], return_index=True)
            new = ~np.isin(ids, seen)
            seen, at, raw = np.concatenate([seen, ids[new]]), held[first[new]], chunk.data.tobytes()
            words = [raw[a:b].decode("utf-8", "replace") for a, b in zip(lines.starts[at].tolist(), lines.ends[at].tolist(), strict=True)]
            yield records(line=T.signed(ids[new]), words=pa.array(words, pa.string()))

    found = map_batches(docs.select("text"), step, "line bigint, words string")
    return found.join(wanted, "line", "left_semi").dropDuplicates(["line"])


def _verify(batch: pa.RecordBatch, distance: int) -> Iterator[pa.RecordBatch]:
    near = [
        banded_distance(a.as_py(), b.as_py(), distance) <= distance
        for a, b in zip(batch.column(2), batch.column(3), strict=True)
    ]
    kept = batch.filter(pa.array(near, pa.bool_()))
    yield records(u=kept.column(0), v=kept.column(1))


def near_lines(docs: DataFrame, distance: int = DISTANCE, least: int = NEAR_CHARS) -> DataFrame:
    """Every pair u, v of distinct lines within 1 to ``distance`` edits, once."""
    rows = write_table(segments(docs, distance, least), "segments")
    pairs = write_table(candidates(rows, distance), "line-pairs")
    named = write_table(pairs.select(F.explode(F.array("u", "v")).alias("line")).distinct(), "near-lines")
    texts = write_table(line_texts(docs, named), "line-texts")
    both = pairs.join(texts.select(F.col("line").alias("u"), F.col("words").alias("a")), "u").join(
        texts.select(F.col("line").alias("v"), F.col("words").alias("b")), "v"
    )
    return map_batches(both.select("u", "v", "a", "b"), partial(_verify, distance=distance), "u bigint, v bigint")


def repeated_lines(docs: DataFrame, distance: int = DISTANCE, least: int | None = None) -> DataFrame:
    """doc_id, tk, removed: numbers of the lines to go, and n_exact, how many of them have
    an equal line earlier. Only documents that lose lines have a row."""
    found = write_table(occurrences(docs, LEAST_CHARS if least is None else least), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tk", "ln")
    firsts = write_table(
        found.groupBy("line").agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("n")), "first-lines"
    )
    links = near_lines(docs, distance, NEAR_CHARS if least is None else least)
    linked = links.select(F.col("u").alias("line"), F.col("v").alias("other")).unionByName(
        links.select(F.col("v").alias("line"), F.col("u").alias("other"))
    )
    linked = write_table(linked, "line-links")
    earlier = linked.join(
        firsts.select(F.col("line").alias("other"), F.col("place").alias("other_place")), "other"
    ).groupBy("line").agg(F.min("other_place").alias("near"))
    verdicts = firsts.join(earlier, "line", "left").filter("n > 1 OR near < place")
    # written, so that the join deals both sides itself and can split a hot line
    verdicts = write_table(verdicts.select("line", F.col("place").alias("own"), "near"), "line-verdicts")
    placed = found.withColumn("place", place).join(verdicts, "line")
    gone = placed.filter("place > own OR near < place")
    return gone.groupBy("doc_id", "tk").agg(
        F.sort_array(F.collect_set("ln")).alias("removed"),
        F.size(F.collect_set(F.when(F.col("place") > F.col("own"), F.col("ln")))).alias("n_exact"),
    )


def line_counts(docs: DataFrame, distance: int = DISTANCE, least: int | None = None) -> DataFrame:
    """Per row: doc_id, n_lines, n_exact, n_near (lines that go by kind) and their numbers."""
    gone = write_table(repeated_lines(docs, distance, least), "repeated-lines")
    size = F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1
    rows = _keyed(docs).select("doc_id", "tk", F.coalesce(size, F.lit(1)).cast("bigint").alias("n_lines"))
    gone = gone.select(F.col("doc_id").alias("d"), F.col("tk").alias("t"), "removed", "n_exact")
    joined = rows.join(gone, rows.doc_id.eqNullSafe(gone.d) & (rows.tk == gone.t), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    exact = F.coalesce("n_exact", F.lit(0)).cast("bigint")
    return joined.select("doc_id", "n_lines", exact.alias("n_exact"), (F.size(removed) - exact).alias("n_near"), removed.alias("removed"))


def drop_repeated_lines(docs: DataFrame, distance: int = DISTANCE, least: int | None = None) -> DataFrame:
    """``docs`` without the lines that go; a document all of whose lines go, goes itself.

    All columns stay; n_chars, where there is one, counts the new text.
    """
    gone = write_table(repeated_lines(docs, distance, least), "repeated-lines")
    d, t, numbers = free_names(docs, "_d", "_t", "_removed")
    gone = gone.select(F.col("doc_id").alias(d), F.col("tk").alias(t), F.col("removed").alias(numbers))
    same = docs.doc_id.cast("bigint").eqNullSafe(F.col(d)) & (text_key(docs.text) == F.col(t))
    joined = docs.join(gone, same, "left")
    kept = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains(numbers, i))
    whole = F.col(numbers).isNull()
    joined = joined.withColumn("text", F.when(whole, F.col("text")).otherwise(F.array_join(kept, "\n")))
    joined = joined.filter(whole | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*map(column, docs.columns))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        if isinstance(kind, S.NumericType):
            joined = joined.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return joined
