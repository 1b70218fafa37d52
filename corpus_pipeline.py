"""From raw documents to a training mix, in five stages.

Each stage takes all that the one before kept and hands on whole rows with the columns
of ``documents``; the last adds what the mix takes of each document. Every stage's
result is written before the next reads it, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesight.llm import decontaminate, line_dedup, mixing, near_copies, quality_rules, simhash
from salesight.llm.queries import table
from salesight.llm.tables import free_names, write_table

#: Rules are learned from labels, lines may differ by an edit, fingerprints are hashes and
#: overlaps tolerate substitutions: the stages are tested against brute force instead.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the base rules or the learned decision list reject."""
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.keep_documents(docs, rules)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that an earlier line equals or nearly equals, and documents left empty."""
    return line_dedup.drop_repeated_lines(docs)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of near copies, by two methods.

    First documents are compared as they were before lines were removed (five-word Jaccard
    >= 0.8): of a near copy, those that differ are all that is left, and they resemble nothing.
    SimHash fingerprints within three bits link most of them, each link checked by its index; as
    about 10 of 64 bits differ at this index, an exact join on the sets' prefixes finds those that
    are left. Then the texts handed on are compared as ``op6_simhash`` does it: of documents that
    differed only in lines now removed, the first of each component stays.
    """
    kept = near_copies.one_of_each(docs, before=table(spark, sf_dir, "documents"))
    return simhash.one_of_each(kept)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that overlap a benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, in the order of the mix; the rest goes."""
    size = free_names(docs, "size")[0]
    sized = docs.withColumn(size, mixing.count_words(F.col("text")))
    return mixing.mix(sized, size=size).filter("taken > 0")


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", copies),
    ("benchmark decontamination", leaks),
    ("mixing sources", source_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
