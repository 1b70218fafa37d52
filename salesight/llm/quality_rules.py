"""Quality rules: a learned decision list over statistics of a text.

Sequential covering grows one conjunction of thresholds at a time by information gain on
one part of the labelled rows, prunes it on the other part, and drops the rows it covers;
a rule must be right on ``precision`` of the pruning rows that it covers. The list is
emitted as one Spark conditional expression, first match first; what no rule rejects
stays.

Rows: a null text has no words and fails the base rules like an empty one; null or
repeated ids are judged row by row; without usable labels the list is empty and the base
rules decide alone; ratios of a text without words are null and match no rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from salesight.llm import text as T
from salesight.llm.tables import map_batches, records

#: Labelled rows that a list is fitted on, at most.
SAMPLE_ROWS = 20_000
#: Base rules: the fewest words, and the most words in repeated windows in percent.
LEAST_WORDS = 50
REPEAT_PERCENT = 50

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_digits", "n_exclaim", "n_distinct_words",
)

#: Figures that rules may use: numerator, denominator.
RATIOS = {
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "exclaim_per_word": ("n_exclaim", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
}


def _bytes(values: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


SYMBOLS = _bytes(b"#*$%&|<>")
UPPER = _bytes(bytes(range(ord("A"), ord("Z") + 1)))
DIGITS = _bytes(b"0123456789")
EXCLAIM = _bytes(b"!")
#: Bytes of a word that begin a code point.
HEADS = T.SPACED & ~_bytes(bytes(range(0x80, 0xC0)))


def _in_row(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of items with equal hash in one row: the number, the first one's place, and the group."""
    owner = T.row_of(rows).astype(np.uint64)
    own = T.mix(hashes + T.mix(owner + np.uint64(1)))
    _, first, group, count = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
    return count, first, group


def chunk_statistics(chunk: T.Chunk) -> dict[str, np.ndarray]:
    """The figures of ``COUNTS`` for each row of a chunk."""
    found = T.words(chunk)
    hasher = T.byte_hasher(chunk.data)
    hashes = hasher(found.starts, found.ends)
    made = {"n_words": np.diff(found.rows)}
    for name, table in {
        "word_chars": HEADS, "n_symbols": SYMBOLS, "n_upper": UPPER, "n_digits": DIGITS, "n_exclaim": EXCLAIM,
    }.items():
        made[name] = T.per_row(table[chunk.data], chunk.bounds)

    lines = T.lines(chunk)
    spoken = np.searchsorted(found.starts, lines.ends) > np.searchsorted(found.starts, lines.starts)
    owner = T.row_of(lines.rows)[spoken]
    rows = np.searchsorted(owner, np.arange(len(chunk.bounds)))
    _, first, _ = _in_row(hasher(lines.starts[spoken], lines.ends[spoken]), rows)
    later = np.ones(len(owner), bool)
    later[first] = False
    made["n_lines"] = np.diff(rows)
    made["n_dup_lines"] = T.per_row(later, rows)

    _, first, _ = _in_row(hashes, found.rows)
    new = np.zeros(len(hashes), bool)
    new[first] = True
    made["n_distinct_words"] = T.per_row(new, found.rows)

    at = np.arange(max(0, len(hashes) - 2))
    owner = T.row_of(found.rows)
    at = at[owner[at] == owner[at + 2]]
    rows = np.searchsorted(owner[at], np.arange(len(chunk.bounds)))
    count, _, group = _in_row(T.Hasher(hashes)(at, at + 3), rows)
    repeated = at[count[group] > 1]
    covered = np.zeros(len(hashes), bool)
    for k in range(3):
        covered[repeated + k] = True
    made["n_repeat_words"] = T.per_row(covered, found.rows)
    return made


def statistics(docs: DataFrame, *also: str) -> DataFrame:
    """doc_id, the columns ``also`` and the figures of ``COUNTS`` for every row."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        made = [chunk_statistics(c) for c in T.chunks(batch.column("text"))]
        if made:
            columns = {name: batch.column(name) for name in ("doc_id", *also)}
            yield records(**columns, **{c: np.concatenate([m[c] for m in made]) for c in COUNTS})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *also, "text")
    kept = [f for f in rows.schema.fields if f.name != "text"]
    return map_batches(rows, step, S.StructType([*kept, *(S.StructField(c, S.LongType()) for c in COUNTS)]))


class Condition(NamedTuple):
    figure: str
    above: bool
    threshold: float

    def holds(self, figures: dict[str, np.ndarray]) -> np.ndarray:
        with np.errstate(invalid="ignore"):
            x = figures[self.figure]
            return x > self.threshold if self.above else x <= self.threshold

    def column(self) -> Column:
        over, under = RATIOS[self.figure]
        x = F.try_divide(F.col(over).cast("double"), F.col(under))
        return x > self.threshold if self.above else x <= self.threshold

    def __str__(self) -> str:
        return f"{self.figure} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, figures: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """The rows that a rule's conditions all hold for."""
    for condition in rule:
        rows = rows[condition.holds(figures)[rows]]
    return rows


def _grow(figures: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray, cuts: int, longest: int) -> Rule:
    """Add the condition of most gain until the rule covers rejected rows alone."""
    rule: Rule = ()
    while len(rule) < longest and len(rows) and not bad[rows].all():
        p, n = bad[rows].sum(), (~bad[rows]).sum()
        before = np.log2(p / (p + n)) if p else 0.0
        best, gain = None, 1e-9
        for name, x in figures.items():
            x = x[rows]
            known = np.isfinite(x)
            values = np.unique(x[known])
            if len(values) > cuts:
                values = np.unique(np.quantile(x[known], np.linspace(0, 1, cuts)))
            places = (values[1:] + values[:-1]) / 2
            order = np.argsort(x[known], kind="stable")
            ends = np.searchsorted(x[known][order], places, "right")
            hit = np.concatenate([[0], np.cumsum(bad[rows][known][order])])
            low_p, low_n = hit[ends], ends - hit[ends]
            for above, ps, ns in ((False, low_p, low_n), (True, hit[-1] - low_p, len(order) - hit[-1] - low_n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gains = np.where(ps > 0, ps * (np.log2(ps / (ps + ns)) - before), -1.0)
                if len(gains) and gains.max() > gain:
                    gain = float(gains.max())
                    best = Condition(name, above, float(places[int(gains.argmax())]))
        if best is None:
            break
        rule = (*rule, best)
        rows = rows[best.holds(figures)[rows]]
    return rule


def _prune(rule: Rule, figures: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> tuple[Rule, float]:
    """The shortest beginning of the rule that is best on the pruning rows, and its precision."""
    best, worth, right = (), -2.0, 0.0
    for size in range(1, len(rule) + 1):
        hit = covers(rule[:size], figures, rows)
        p, n = int(bad[hit].sum()), int((~bad[hit]).sum())
        value = (p - n) / (p + n) if p + n else -1.0
        if value > worth + 1e-12:
            best, worth, right = rule[:size], value, p / (p + n) if p + n else 0.0
    return best, right


def learn(
    figures: dict[str, np.ndarray],
    bad: np.ndarray,
    precision: float = 0.9,
    most_rules: int = 16,
    longest: int = 4,
    cuts: int = 65,
    least_covered: int = 2,
) -> list[Rule]:
    """Rules that reject, in order. Every third row prunes, the others grow.

    What a failed rule covers is left aside, and the next one grows on the rest.
    """
    rules: list[Rule] = []
    rows = np.arange(len(bad))
    for _ in range(2 * most_rules):
        grow, prune = rows[rows % 3 != 0], rows[rows % 3 == 0]
        grown = _grow(figures, bad, grow, cuts, longest)
        if not grown or len(rules) == most_rules:
            break
        rule, right = _prune(grown, figures, bad, prune)
        hit = covers(rule, figures, rows)
        if right >= precision and bad[hit].mean() >= precision and bad[hit].sum() >= least_covered:
            rules.append(rule)
        else:
            hit = covers(grown, figures, rows)
        rows = np.setdiff1d(rows, hit, assume_unique=True)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects a row, or null, as one conditional."""
    chain = None
    for number, rule in enumerate(rules):
        holds = F.lit(True)
        for condition in rule:
            holds = holds & F.coalesce(condition.column(), F.lit(False))
        chain = F.when(holds, F.lit(number)) if chain is None else chain.when(holds, F.lit(number))
    return F.lit(None).cast("int") if chain is None else chain


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn from ``labels`` (doc_id, quality; 0 is to be rejected), at most ``sample_rows`` ids.

    Rows that the base rules reject teach nothing. The ids come in the order of a hash, so the sample is the same on every run. Only
    the sampled rows' figures reach the driver.
    """
    marked = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("_quality"))
    )
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(
        F.broadcast(sample), "doc_id"
    )
    table = statistics(rows, "_quality").filter(~base_failed()).orderBy(F.xxhash64("doc_id"), *COUNTS).limit(sample_rows)
    seen = table.toPandas()
    if seen.empty:
        return []
    with np.errstate(divide="ignore", invalid="ignore"):
        figures = {
            name: seen[a].to_numpy(float) / seen[b].to_numpy(float) for name, (a, b) in RATIOS.items()
        }
    return learn(figures, seen["_quality"].to_numpy() == 0)


def base_failed() -> Column:
    """Too short, or mostly repeated windows of words."""
    repeated = 100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    return (F.col("n_words") < LEAST_WORDS) | repeated


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add base_failed, rule (number of the rule that rejects, or null) and kept."""
    return stats.withColumns({"base_failed": base_failed(), "rule": verdict(rules)}).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull()
    )


def keep_documents(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs``, with all their columns, that neither the base rules nor ``rules`` reject."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select("doc_id", whole.alias("_row"), "text")
    return judge(statistics(rows, "_row"), rules).filter("kept").select("_row.*")
