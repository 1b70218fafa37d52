"""The corpus queries: each operator over its whole table, and SQL where it can be stated."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesight.llm import (
    byte_bpe,
    decontaminate,
    line_dedup,
    merkle,
    mixing,
    notices,
    page_diff,
    quality_rules,
    resample,
    simhash,
    substring_dedup,
    token_counts,
    toxicity,
)
from salesight.llm.tables import write_table
from salesight.session import tune

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.drop_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(documents(spark, sf_dir), benchmark)


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    sized = docs.select("doc_id", "source", mixing.count_words(F.col("text")).alias("size"))
    mixed = mixing.mix(write_table(sized, "sized"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "virtual_finish")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    judged = quality_rules.judge(quality_rules.statistics(docs), rules)
    return judged.select("doc_id", *quality_rules.COUNTS[:5], "base_failed", "kept", "rule")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_counts(documents(spark, sf_dir))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select(
        "doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op7_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = page_diff.extract(table(spark, sf_dir, "pages"))
    n_chars = F.length("text").cast("bigint").alias("n_chars")
    return found.select("page_id", "url", "text", n_chars, "n_shared")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = notices.scan(documents(spark, sf_dir))
    both = F.concat("base_labels", F.transform("notices", lambda n: n.getField("label")))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(both)), ",").alias("labels"),
        "score",
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.token_counts(documents(spark, sf_dir), path)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found_now = merkle.leaf_digest(
        changed={"text": merkle.without_breaks(F.col("doc_id"), F.col("text"))}
    )
    made = merkle.build(docs, keep={"doc_id": F.col("doc_id"), "found": found_now})
    return merkle.verify(made, "found").select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.resample(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.round_trip(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


def queries() -> dict[str, Query]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_decontaminate": op2_decontaminate,
        "op3_source_mix": op3_source_mix,
        "op4_quality_rules": op4_quality_rules,
        "op5_line_dedup": op5_line_dedup,
        "op6_simhash": op6_simhash,
        "op7_page_text": op7_page_text,
        "op8_license_scan": op8_license_scan,
        "op9_toxicity": op9_toxicity,
        "op10_token_counts": op10_token_counts,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_resample": op12_resample,
        "op13_byte_bpe": op13_byte_bpe,
    }


OP3_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS shuffled
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS place
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
         2.0::DOUBLE * source_size AS cap
  FROM sources
), filled AS (
  SELECT *, cap / weight AS fill FROM weighted
), levelled AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()::BIGINT
             - coalesce(sum(cap) OVER (ORDER BY fill, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY fill, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM filled
), water AS (
  SELECT arg_min(level, fill * 1e6 + place) FILTER (level < fill) AS level FROM levelled
), targets AS (
  SELECT source, source_size, coalesce(least(cap, weight * water.level), cap) AS target
  FROM levelled, water
), queued AS (
  SELECT s.*, t.source_size, t.target,
         sum(size) OVER (PARTITION BY s.source ORDER BY shuffled, doc_id, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS done
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(floor(target)::BIGINT - (done - size), size))
        + greatest(0, least(floor(target)::BIGINT - source_size - (done - size), size)))::BIGINT AS taken,
       CASE WHEN target = 0 THEN NULL ELSE done / target END AS virtual_finish
FROM queued
"""


_ENCODED = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(map(_ENCODED.format, ("doc_id", "source", "lang", "n_chars", "{text}"))) + ")"

OP11_SQL = (
    r'''
WITH RECURSIVE marked AS (
  -- the CRC-32 of the id, a bit at a time: each byte followed by seven zeros
  SELECT *, list_reduce(
    flatten([[ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0] for c in string_split(doc_id::VARCHAR, '')]),
    lambda acc, x: xor(xor(acc, x) >> 1, (xor(acc, x) & 1) * 3988292384), 4294967295::BIGINT) AS crc
  FROM documents
), changed AS (
  SELECT *, CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS found
  FROM marked
), leaves AS (
  SELECT doc_id, source, '''
    + _LEAF.format(text="text")
    + " AS leaf, "
    + _LEAF.format(text="found")
    + r''' AS found_leaf FROM changed
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY source) AS n
  FROM leaves
), nodes AS (
  SELECT source, 0 AS level, idx, n, leaf AS hash FROM placed
  UNION ALL
  SELECT source, level + 1, idx // 3, (any_value(n) + 2) // 3, sha256(string_agg(hash, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY source, level, idx // 3
), subroots AS (
  SELECT source, level AS height, hash, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), top AS (
  SELECT 0 AS level, idx, n, hash FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, (any_value(n) + 2) // 3, sha256(string_agg(hash, '' ORDER BY idx))
  FROM top WHERE n > 1 GROUP BY level, idx // 3
), everything AS (
  -- one numbering of levels per source: the last tree stands on the subroot
  SELECT source, level, idx, n, hash FROM nodes WHERE n > 1
  UNION ALL
  SELECT s.source, s.height + t.level, t.idx, t.n, t.hash FROM subroots s, top t
), folding AS (
  SELECT p.doc_id, p.leaf, p.found_leaf AS folded, p.source, s.height, s.idx AS place, 0 AS level,
         CASE WHEN s.height = 0 THEN s.idx ELSE p.idx END AS idx, '' AS siblings
  FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT f.doc_id, f.leaf, sha256(string_agg(CASE WHEN e.idx = f.idx THEN f.folded ELSE e.hash END, '' ORDER BY e.idx)),
         f.source, any_value(f.height), any_value(f.place), f.level + 1,
         CASE WHEN f.level + 1 = any_value(f.height) THEN any_value(f.place) ELSE any_value(f.idx) // 3 END,
         any_value(f.siblings) || coalesce(string_agg(e.hash, '' ORDER BY e.idx) FILTER (e.idx <> f.idx), '')
  FROM folding f JOIN everything e
    ON f.source IS NOT DISTINCT FROM e.source AND f.level = e.level AND f.idx // 3 = e.idx // 3 AND e.n > 1
  GROUP BY f.doc_id, f.leaf, f.source, f.level
), ends AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, leaf ORDER BY level DESC) AS last FROM folding
)
SELECT e.doc_id, e.leaf, s.hash AS subroot, t.hash AS root, sha256(e.siblings) AS proof_sha256,
       e.folded AS folded_root, e.folded = t.hash AS verified
FROM ends e JOIN subroots s ON e.source IS NOT DISTINCT FROM s.source JOIN top t ON t.n = 1
WHERE e.last = 1
'''
)


def _crc_step(acc: str, byte: str) -> str:
    """SQL for one byte of a CRC-32: what its bits add, each a constant of the polynomial."""
    low, sum_ = f"xor({acc}, {byte})", f"{acc} >> 8"
    for bit in range(8):
        added = 1 << bit
        for _ in range(8):
            added = added >> 1 ^ (added & 1) * 0xEDB88320
        sum_ = f"xor({sum_}, ({low} >> {bit} & 1) * {added})"
    return sum_


_SAID = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words"""
_RUNS = """unnest(words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])
  || list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) AS f"""

OP12_SQL = f"""
WITH said AS (
  SELECT doc_id, row_number() OVER () AS row, {_SAID} FROM documents
), wanted AS (
  SELECT {_SAID} FROM benchmark
), here AS (
  SELECT row, {_RUNS} FROM said
), there AS (
  SELECT {_RUNS} FROM wanted
), counted AS (
  SELECT f, sum(s)::BIGINT AS s, sum(t)::BIGINT AS t, hex(encode(f)) AS digits
  FROM (SELECT f, 1 AS s, 0 AS t FROM here UNION ALL SELECT f, 0, 1 FROM there) GROUP BY f
), hashed AS (
  SELECT f, s, t, xor(list_reduce(
    list_transform(range(0, len(digits) // 2), lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT),
    lambda acc, x: {_crc_step("acc", "x")}, 4294967295::BIGINT), 4294967295) % 10000 AS bucket
  FROM counted
), buckets AS (
  SELECT bucket, sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM hashed GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000)) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain
  FROM buckets
), weighed AS (
  SELECT row, count(*) AS n_features, sum(gain)::BIGINT AS weight
  FROM here JOIN hashed USING (f) JOIN gains USING (bucket) GROUP BY row
), scored AS (
  SELECT doc_id, row, len(words) >= 20 AS fit, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM said LEFT JOIN weighed USING (row)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id NULLS LAST, row) AS place,
         5 * count(*) OVER (PARTITION BY fit) // 100 AS drawn
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= drawn THEN place END AS rank FROM ranked
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_source_mix": OP3_SQL,
        "op11_merkle_manifest": OP11_SQL,
        "op12_resample": OP12_SQL,
    }
