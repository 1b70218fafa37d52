"""Substring dedup against brute force over all windows."""

import hashlib
import random
import re

import pytest

from salesight.llm import substring_dedup
from salesight.llm.queries import op1_substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, words in split:
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            if i is not None and i < first.get(key, float("inf")):
                first[key] = i
    found = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - window + 1):
            if i is not None and first[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        found.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(found, key=str)


def run(docs, window):
    found = substring_dedup.drop_repeats(docs, window).collect()
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return sorted(((r.doc_id, r.n_words, r.n_removed, digest(r.kept)) for r in found), key=str)


@pytest.mark.parametrize("window", [4, 7, 50])
def test_matches_brute_force(spark, window):
    rng = random.Random(window)
    vocab = ["a", "b", "é", "dd", "x,"] if window < 10 else [f"w{i}" for i in range(40)]
    words = lambda n: [rng.choice(vocab) for _ in range(n)]
    passages = [words(rng.randrange(window, 3 * window)) for _ in range(6)]
    rows = []
    for i in range(120):
        text = words(rng.randrange(0, 2 * window))
        for _ in range(rng.randrange(4)):
            text += list(rng.choice(passages))
            if rng.random() < 0.4:
                text[rng.randrange(len(text))] = "edit"
            text += words(rng.randrange(0, window))
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(text)))
    long = rows[40][1]
    rows += [(500 + i, long) for i in range(30)] + [(3, long), (3, long), (2, rows[7][1]), (0, rows[8][1])]
    rows += [(None, long), (700, None), (701, ""), (702, " \n "), (703, " ".join(words(5000))), (704, "a " * 500)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert run(docs, window) == brute(rows, window)


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, anchor string, start int")
    assert substring_dedup.drop_repeats(empty).count() == 0
    text = " ".join(map(str, range(60)))
    docs = spark.createDataFrame([(1, text, "x", 1), (2, text, "y", 2)], empty.schema)
    assert [r.n_removed for r in substring_dedup.drop_repeats(docs).orderBy("doc_id").collect()] == [0, 60]


def test_query_on_the_documents_table(spark, small_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted((tuple(r) for r in op1_substring_dedup(spark, small_dir).collect()), key=str)
    assert found == brute(rows, 50)
