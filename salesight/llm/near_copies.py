"""Near copies of documents: SimHash, and five-word shingle sets with a Jaccard index of 0.8.

Each set of shingles has a SimHash fingerprint. Sets whose fingerprints differ in at most
three bits meet first (``simhash.close_pairs``) and are linked if their index is 0.8 or more;
pairs that these links connect are not met again. At that index up to 16 of the 64 bits
differ, which no choice of blocks finds, so an exact join follows for the pairs that
fingerprints leave.

Two sets of that similarity share one of the first n // 5 + 1 shingles of each, in any one
order of all shingles, so a join on these prefixes misses no pair. Shingles that are
frequent in a sample come last in the order, and before them those that a first round of
prefixes finds in two sets or more: what is left in the prefixes of sets that resemble no
other is nearly all their own. The order decides cost only. Pairs that meet
are compared by size, by the shingles left after the one they share, and by parity
bitmaps, none of which can reject a near copy, and the rest by their whole sets.

Large groups: each prefix shingle's first and last set are compared with its others, and
what they link is one component from there on; only pairs of different components that
share a shingle are compared after that, so copies of one text are not paired up. As the
members of a large group share many shingles two by two, a set meets one partner first and
its other pairs wait: those that chains of links have made one component are not compared.

Rows: words and lower case are those of ``simhash``; a text under five words is one
shingle; null and empty texts have none and equal each other; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesight.llm import text as T
from salesight.llm.components import components
from salesight.llm.line_dedup import SIEVE_WORDS, sieve
from salesight.llm.simhash import close_pairs, first_rows, majority_bits
from salesight.llm.tables import map_batches, records, text_key, unpack, write_table

WIDTH = 5
#: Rows of the sample that shows frequent shingles, and how many of them it may name.
SAMPLE_ROWS = 20_000
FREQUENT = 1 << 16
LEAST_FREQUENT = 8
#: Words of parity bits, a power of two: 512 bits tell sets of up to about 1,000 shingles apart
#: (256 do up to 480, under the mean of documents of 3 KB, so most pairs that met passed them).
BITMAPS = 8
#: Turns in which a set meets one partner, before all pairs still open are compared.
TURNS = 2
#: Sets that a task keeps at hand while it compares pairs.
KNOWN_SETS = 64


def shingles(chunk: T.Chunk, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each row, ascending, and where each row's begin."""
    lower = T.LOWER[chunk.data]
    found = T.words(chunk._replace(data=lower))
    n_words = np.diff(found.rows)
    counts = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    rows = np.concatenate([[0], np.cumsum(counts)])
    owner = T.row_of(rows)
    first = found.rows[owner] + np.arange(rows[-1]) - rows[owner]
    last = np.minimum(first + width, found.rows[owner + 1])
    hashes = T.Hasher(T.word_hashes(lower, found))(first, last, seed=5)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.searchsorted(owner[new], np.arange(len(n_words) + 1))


def set_ids(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A hash of each row's set of shingles."""
    total = T.per_row(T.signed(T.mix(hashes)), rows).view(np.uint64)
    return T.mix(total + np.diff(rows).astype(np.uint64))


def bitmaps(hashes: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Parities of each row's shingles by hash: one shingle more or less changes one bit."""
    word = 65 - BITMAPS.bit_length()  # the topmost bits name the word, the next six the bit
    bit = np.uint64(1) << (hashes >> np.uint64(word - 6) & np.uint64(63))
    made = []
    for k in range(BITMAPS):
        running = np.zeros(len(hashes) + 1, np.uint64)
        np.bitwise_xor.accumulate(np.where(hashes >> np.uint64(word) == k, bit, np.uint64(0)), out=running[1:])
        made.append(running[rows[1:]] ^ running[rows[:-1]])
    return made


def sets(docs: DataFrame, key: Column | None = None) -> DataFrame:
    """doc_id, tk and the shingle set of every row: its hash ``sid``, SimHash fingerprint, size and bitmaps.

    ``key`` tells rows of one id apart, by default by their texts.
    """
    key = text_key(F.col("text")) if key is None else key

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for chunk in T.chunks(batch.column(2)):
            hashes, rows = shingles(chunk)
            at = slice(chunk.first, chunk.last)
            yield records(
                doc_id=batch.column(0)[at], tk=batch.column(1)[at], sid=T.signed(set_ids(hashes, rows)),
                fp=T.signed(majority_bits(T.mix(hashes), rows)), n=np.diff(rows).astype(np.int32),
                **{f"b{k}": T.signed(b) for k, b in enumerate(bitmaps(hashes, rows))},
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), key.alias("tk"), "text")
    fields = "".join(f", b{k} bigint" for k in range(BITMAPS))
    return map_batches(rows, step, "doc_id bigint, tk bigint, sid bigint, fp bigint, n int" + fields)


def frequent_shingles(docs: DataFrame, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, and counts of the shingles frequent in a sample of the rows."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for chunk in T.chunks(batch.column(0)):
            yield records(key=T.signed(shingles(chunk)[0]))

    every = max(1, n_rows // SAMPLE_ROWS)
    sample = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(every)) == 0).select("text")
    counts = map_batches(sample, step, "key bigint").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    # as many rows of the whole table, whatever share of them is in the sample
    least = max(2, LEAST_FREQUENT // every)
    most = counts.filter(F.col("n") >= least).orderBy(F.desc("n"), "key").limit(FREQUENT).toArrow()
    keys, n = (most[c].to_numpy().astype(np.int64) for c in ("key", "n"))
    keys = keys.view(np.uint64)
    order = np.argsort(keys)
    return keys[order], n[order]


def _held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes a sieve lets through."""
    word = (hashes >> np.uint64(6)) & np.uint64(SIEVE_WORDS - 1)
    return (bits[word.astype(np.int64)] >> (hashes & np.uint64(63)) & np.uint64(1)).astype(bool)


def sifted(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose hash ``line`` is in ``wanted`` (line), and few others: a filter before a join."""
    shared = rows.sparkSession.sparkContext.broadcast(sieve(wanted))

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes = batch.column(batch.schema.get_field_index("line")).to_numpy(zero_copy_only=False)
        yield batch.filter(pa.array(_held(shared.value, hashes.astype(np.int64).view(np.uint64))))

    return map_batches(rows, step, rows.schema)


def prefixes(
    docs: DataFrame,
    frequent: tuple[np.ndarray, np.ndarray],
    common: DataFrame | None = None,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """key, sid and place of each shingle that a set may have to share, and the one before it
    in the set's order (``prev``, null for the first).

    Shingles that a sieve of ``common`` (line) holds come after others, before the frequent ones.
    With ``wanted`` (line), keys outside it are left out as far as a sieve tells them.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((*frequent, *(None if t is None else sieve(t) for t in (common, wanted))))

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known, counts, later, bits = shared.value
        seen = np.zeros(0, np.uint64)
        for chunk in T.chunks(batch.column(0)):
            hashes, rows = shingles(chunk)
            weight = np.zeros(len(hashes), np.int64) if later is None else _held(later, hashes).astype(np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                weight = np.where(known[at] == hashes, counts[at], weight)  # counts are 2 or more
            owner = T.row_of(rows)
            order = np.lexsort((hashes, weight, owner))
            ids = set_ids(hashes, rows)
            _, first = np.unique(ids, return_index=True)
            new = np.zeros(len(ids), bool)
            new[first] = True
            new &= ~np.isin(ids, seen)
            seen = np.concatenate([seen, ids[new]])
            place = np.arange(len(hashes)) - rows[owner]
            ordered = T.signed(hashes[order])
            kept = new[owner] & (place <= np.diff(rows)[owner] // 5)
            if bits is not None:
                kept &= _held(bits, hashes[order])
            prev = pa.array(np.roll(ordered, 1)[kept], mask=place[kept] == 0)
            yield records(
                key=ordered[kept], sid=T.signed(ids[owner][kept]), place=place[kept].astype(np.int32), prev=prev
            )

    return map_batches(docs.select("text"), step, "key bigint, sid bigint, place int, prev bigint")


def _may_be_near(a: str, b: str) -> Column:
    """False only for pairs of sets (structs ``a`` and ``b``) whose index is under 0.8, or
    whose first common shingle is another one."""
    a, b = F.col(a), F.col(b)
    both = a["n"] + b["n"]
    left = F.least(a["n"] - a["place"], b["n"] - b["place"])
    changed = sum((F.bit_count(a[f"b{k}"].bitwiseXOR(b[f"b{k}"])) for k in range(BITMAPS)), F.lit(0))
    return (9 * left >= 4 * both) & (5 * F.least(a["n"], b["n"]) >= 4 * F.greatest(a["n"], b["n"])) & (9 * changed <= both)


def _first_of_run(a: str, b: str) -> Column:
    """False only for pairs that share the shingle before as well. Its rows have both sets, with
    more shingles left, so they meet there: a run of common shingles is one row, not one each."""
    return F.coalesce(F.col(a)["prev"] != F.col(b)["prev"], F.lit(True))


def packed_sets(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``line`` (a set's hash) and one text, packed, of every set in ``pairs`` (u, v)."""
    wanted = write_table(pairs.select(F.explode(F.array("u", "v")).alias("line")).distinct(), "copy-names")
    shared = docs.sparkSession.sparkContext.broadcast(sieve(wanted))

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bits, seen = shared.value, np.zeros(0, np.uint64)
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for chunk in T.chunks(batch.column(0)):
            ids, at = np.unique(set_ids(*shingles(chunk)), return_index=True)
            held = _held(bits, ids) & ~np.isin(ids, seen)
            seen = np.concatenate([seen, ids[held]])
            raw = [chunk.data[chunk.bounds[i] : chunk.bounds[i + 1]].tobytes() for i in at[held].tolist()]
            yield records(line=T.signed(ids[held]), packed=pa.array([squeeze(r) for r in raw], pa.binary()))

    found = map_batches(docs.select("text"), step, "line bigint, packed binary")
    return write_table(found.join(wanted, "line", "left_semi").dropDuplicates(["line"]), "copy-texts")


def near_sets(pairs: DataFrame, packed: DataFrame) -> DataFrame:
    """Those of ``pairs`` (u, v) of sets whose Jaccard index is 0.8 or more."""

    def verify(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}

        def shingles_of(name: object, packed: object) -> np.ndarray:
            if name not in known:
                if len(known) >= KNOWN_SETS:
                    known.clear()
                known[name] = shingles(next(T.chunks(pa.array([unpack(packed)]))))[0]
            return known[name]

        near = []
        for u, v, packed_u, packed_v in zip(*batch.columns, strict=True):
            a, b = shingles_of(u.as_py(), packed_u), shingles_of(v.as_py(), packed_v)
            near.append(9 * len(np.intersect1d(a, b, assume_unique=True)) >= 4 * (len(a) + len(b)))
        kept = batch.filter(pa.array(near, pa.bool_()))
        yield records(u=kept.column(0), v=kept.column(1))

    # only texts in the pairs are dealt out, which are few in the later turns
    of_u, of_v = (
        packed.join(pairs.select(F.col(side).alias("line")).distinct(), "line", "left_semi") for side in ("u", "v")
    )
    both = pairs.join(of_u.select(F.col("line").alias("u"), F.col("packed").alias("a")), "u").join(
        of_v.select(F.col("line").alias("v"), F.col("packed").alias("b")), "v"
    )
    return write_table(map_batches(both.select("u", "v", "a", "b"), verify, "u bigint, v bigint"), "copy-links")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose sets are not in one component."""
    for side in ("u", "v"):
        root = roots.select(F.col("u").alias(side), F.col("root").alias(f"root_{side}"))
        pairs = pairs.join(root, side, "left")
    return pairs.filter(F.coalesce("root_u", "u") != F.coalesce("root_v", "v")).select("u", "v")


def chained(pairs: DataFrame, packed: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Links that connect what ``links`` and all near ones of ``pairs`` (u, v) connect.

    Each turn compares every set with the least partner left to it and then drops the pairs
    that are connected; in the end all that remain are compared. So no pair is left out but
    those whose sets are in one component in any case. ``packed`` has the sets' texts.
    """
    left = pairs
    for _ in range(TURNS):
        turn = write_table(left.groupBy("v").agg(F.min("u").alias("u")).select("u", "v"), "copy-turn")
        found = near_sets(turn, packed)
        roots = components(found if links is None else links.unionByName(found))
        waiting = left.join(turn, ["u", "v"], "left_anti")
        left = write_table(_apart(waiting, roots), "copy-left")
        links = roots.select("u", F.col("root").alias("v"))  # as stars, which the next turn contracts at once
    return links.unionByName(near_sets(left, packed))


def fingerprint_pairs(distinct: DataFrame) -> DataFrame:
    """u and v of sets whose fingerprints differ in at most three bits: of sets with one
    fingerprint each meets the least, which stands for them towards other fingerprints."""
    fps = write_table(distinct.groupBy("fp").agg(F.min("sid").alias("lo")), "set-fingerprints")
    same = distinct.join(fps, "fp").filter("lo < sid").select(F.col("lo").alias("u"), F.col("sid").alias("v"))
    near = close_pairs(fps.select("fp"))
    for side in ("u", "v"):
        near = near.join(fps.select(F.col("fp").alias(side), F.col("lo").alias(f"{side}_lo")), side)
    return same.unionByName(near.select(F.least("u_lo", "v_lo").alias("u"), F.greatest("u_lo", "v_lo").alias("v")))


def _pairs(met: DataFrame) -> DataFrame:
    near = met.filter(_may_be_near("a", "b"))
    return near.select(F.least("a.sid", "b.sid").alias("u"), F.greatest("a.sid", "b.sid").alias("v")).distinct()


def _in_two_sets(places: DataFrame) -> DataFrame:
    """The keys that two sets or more have."""
    ends = places.groupBy("key").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi"))
    return write_table(ends.filter("lo <> hi").select("key"), "shared-shingles")


def linked_sets(docs: DataFrame, distinct: DataFrame, n_rows: int) -> DataFrame:
    """u and root of every set that is linked to a smaller one, by chains of near copies."""
    frequent = frequent_shingles(docs, n_rows)
    # made again rather than written: few of them are in two sets
    common = _in_two_sets(prefixes(docs, frequent)).select(F.col("key").alias("line"))
    ends = _in_two_sets(prefixes(docs, frequent, common))
    again = prefixes(docs, frequent, common, ends.select(F.col("key").alias("line")))
    shared = again.join(ends, "key", "left_semi").distinct()
    figures = distinct.select("sid", F.struct("sid", "n", *[f"b{k}" for k in range(BITMAPS)]).alias("figures"))
    one = F.struct(
        "sid", F.col("figures.n").alias("n"), "place", "prev", *[F.col(f"figures.b{k}").alias(f"b{k}") for k in range(BITMAPS)]
    )
    shared = write_table(shared.join(figures, "sid").select("key", one.alias("a")), "shared-prefixes")

    hubs = shared.groupBy("key").agg(F.min("a").alias("lo"), F.max("a").alias("hi"))
    hubs = write_table(hubs, "prefix-hubs")
    met = shared.join(hubs, "key").select("a", F.explode(F.array("lo", "hi")).alias("b")).filter("a.sid <> b.sid")
    by_print = write_table(fingerprint_pairs(distinct), "print-pairs")
    by_prefix = write_table(_pairs(met), "copy-pairs")
    packed = packed_sets(docs, by_print.unionByName(by_prefix))
    linked = components(chained(by_print, packed))
    by_prefix = write_table(_apart(by_prefix, linked), "copy-apart")
    linked = components(chained(by_prefix, packed, linked.select("u", F.col("root").alias("v"))))

    roots = linked.select(F.col("u").alias("sid"), "root")
    member = shared.withColumn("sid", F.col("a.sid")).join(roots, "sid", "left")
    member = write_table(member.select("key", "a", F.coalesce("root", "sid").alias("root")), "prefix-roots")
    sizes = member.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.groupBy("key").agg(F.max(F.struct("n", "root")).alias("most"), F.count(F.lit(1)).alias("n_roots"))
    most = write_table(most.filter("n_roots > 1").select("key", F.col("most.root").alias("most")), "prefix-most")
    open_ = write_table(member.join(most, "key"), "prefix-open")
    # of two sets of different components, one at least is outside the shingle's largest
    left = open_.filter("root <> most")
    right = open_.select("key", F.col("a").alias("b"), F.col("root").alias("other"))
    apart = (F.col("root") != F.col("other")) & ((F.col("other") == F.col("most")) | (F.col("a.sid") < F.col("b.sid")))
    more = _pairs(left.join(right, "key").filter(apart & _first_of_run("a", "b") & _may_be_near("a", "b")))
    more = write_table(more, "copy-pairs")
    return components(chained(more, packed_sets(docs, more), linked.select("u", F.col("root").alias("v"))))


def near_duplicates(docs: DataFrame, key: Column | None = None) -> DataFrame:
    """doc_id, tk and ``first``, the row (unnamed, doc_id, tk) that comes first among a row's near copies."""
    rows = write_table(sets(docs, key), "shingle-sets")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tk")
    same = [F.min(c).alias(c) for c in ["fp", "n", *[f"b{k}" for k in range(BITMAPS)]]]
    distinct = write_table(rows.groupBy("sid").agg(F.min(place).alias("first"), *same), "distinct-sets")
    linked = linked_sets(docs, distinct, rows.count())
    roots = distinct.join(linked, distinct.sid == linked.u, "left").select("sid", "first", F.coalesce("root", "sid").alias("root"))
    least = roots.groupBy("root").agg(F.min("first").alias("first"))
    named = write_table(roots.select("sid", "root").join(least, "root").drop("root"), "first-sets")
    return rows.join(named, "sid").select("doc_id", "tk", "first")


def earlier_texts(docs: DataFrame, before: DataFrame) -> DataFrame:
    """doc_id, tk (by the text of ``docs``) and the text that ``before`` has for the row.

    A row keeps its own text where that is blank or has a line that the earlier one lacks,
    and where its id is not in ``before``. An id with several texts there, or none (null),
    does not say which text a row had: that is the one with all of the row's lines, the least
    by its key if several have. Keys are compared first, so that only texts that did change
    are looked up.
    """
    own = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_key(F.col("text")).alias("tk"), F.col("text").alias("text")
    )
    was = before.select(
        F.col("doc_id").cast("bigint").alias("id"), text_key(F.col("text")).alias("was_tk"), F.col("text").alias("was")
    )
    full = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    same_id = F.col("doc_id").eqNullSafe(F.col("id"))
    texts = was.groupBy("id").agg(F.min("was_tk").alias("was_tk"), F.max("was_tk").alias("last"))
    one_text = F.col("id").isNotNull() & (F.col("was_tk") == F.col("last"))
    one = own.filter(full).select("doc_id", "tk").join(texts.filter(one_text), same_id)
    one = one.filter("tk <> was_tk").select("doc_id", "tk", "was_tk").distinct()
    unsure = write_table(texts.filter(~one_text).select("id"), "unsure-ids")
    changed = write_table(one.unionByName(_texts_by_lines(own.filter(full), was, unsure)), "changed-texts")

    keys = changed.select(F.col("doc_id").alias("_d"), F.col("tk").alias("_t"), "was_tk")
    same_row = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tk") == F.col("_t"))
    same = own.join(keys, same_row, "left_anti")
    wanted = changed.select(F.col("doc_id").alias("_id"), F.col("was_tk").alias("_tk")).distinct()
    named = F.xxhash64("id", "was_tk").alias("line")
    was = sifted(was.select("*", named), wanted.select(F.xxhash64("_id", "_tk").alias("line"))).drop("line")
    was = was.join(wanted, F.col("id").eqNullSafe(F.col("_id")) & (F.col("was_tk") == F.col("_tk")), "left_semi")
    was = was.dropDuplicates(["id", "was_tk"])  # a row may be there twice
    found = own.join(keys, same_row).drop("_d", "_t").withColumnRenamed("was_tk", "old_tk")
    both = found.join(was, same_id & (F.col("old_tk") == F.col("was_tk")))
    text = F.when(_has_lines("was", "text"), F.col("was")).otherwise(F.col("text")).alias("text")
    return same.unionByName(both.select("doc_id", "tk", text))


def _has_lines(text: str, part: str) -> Column:
    """Whether a text has every line of another."""
    return F.size(F.array_except(F.split(part, "\n"), F.split(text, "\n"))) == 0


def _texts_by_lines(own: DataFrame, was: DataFrame, unsure: DataFrame) -> DataFrame:
    """doc_id, tk and was_tk of the rows whose ids are in ``unsure`` (id) and whose text is not
    among that id's: the least text with all lines of the row, met by its first full line."""
    same_id = F.col("doc_id").eqNullSafe(F.col("id"))
    known = unsure.withColumnRenamed("id", "known")
    old = was.join(known, F.col("id").eqNullSafe(F.col("known")), "left_semi").dropDuplicates(["id", "was_tk"])
    cut = own.join(unsure, same_id, "left_semi")
    cut = cut.join(old.select("id", "was_tk"), same_id & (F.col("tk") == F.col("was_tk")), "left_anti")
    cut = write_table(cut.dropDuplicates(["doc_id", "tk"]), "cut-texts")
    full = lambda lines: F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    first = F.xxhash64(full(F.split("text", "\n"))[0]).alias("first")
    lines = F.transform(F.array_distinct(full(F.split("was", "\n"))), lambda x: F.xxhash64(x))
    met = old.select("id", "was_tk", "was", F.explode(lines).alias("line"))
    met = cut.select("doc_id", "tk", "text", first).join(met, same_id & (F.col("first") == F.col("line")))
    return met.filter(_has_lines("was", "text")).groupBy("doc_id", "tk").agg(F.min("was_tk").alias("was_tk"))


def one_of_each(docs: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """``docs``, with all their columns, reduced to the first row of each group of near copies.

    ``before`` has the documents (doc_id, text) as they were before parts of them were
    removed; then those texts are compared, and the rows of ``docs`` returned as they are.
    """
    if before is None:
        return first_rows(docs, near_duplicates(docs))
    judged = write_table(earlier_texts(docs, before), "earlier-texts")
    return first_rows(docs, near_duplicates(judged, F.col("tk")))
