"""Importance resampling against a plain computation with zlib and dictionaries."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from salesight.llm import resample as R
from salesight.llm import text as T

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id bigint, text string, bucket int, `a.b` int, _slice int, n bigint, rank string"


def grams(text, width=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + n]) for n in range(1, width + 1) for i in range(len(words) - n + 1)]
    return len(words), [g.encode() for g in runs]


def brute(rows, target, buckets=10_000, percent=5, least=20, width=3):
    own = [grams(t, width) for _, t in rows]
    s = Counter(zlib.crc32(g) % buckets for _, found in own for g in found)
    t = Counter(zlib.crc32(g) % buckets for text in target for g in grams(text, width)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000.0 * math.log(((t[b] + 1.0) * (all_s + float(buckets))) / ((s[b] + 1.0) * (all_t + float(buckets)))))
        for b in range(buckets)
    ]
    out = []
    for (i, _), (n_words, found) in zip(rows, own, strict=True):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[zlib.crc32(g) % buckets] for g in found)
        score = weight + math.floor(-1000.0 * math.log(-math.log((h + 0.5) / 4294967296.0)))
        out.append([i, n_words, len(found), weight, score, None])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, row in enumerate(fit[: percent * len(fit) // 100], 1):
        row[5] = place
    return [tuple(r) for r in out]


def odd_rows():
    rng = random.Random(8)
    vocab = ["the", "Of", "that's", "é", "x́", "日本", "##", "12", "don't", "A", "ÀB", "zebra", "q_r"]
    texts = [None, "", " \n\t ", "one", "two words", "a-b a-b a b", "\x00\x01 z", "x" * 5000 + " y"]
    for n in [25] * 120 + [400, 3000]:
        texts.append("".join(rng.choice(vocab) + rng.choice([" ", "\n", ", ", "-"]) for _ in range(n)))
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(None, texts[-1]), (50, texts[50]), (50, texts[50]), (None, None)]


def table(spark, rows):
    return spark.createDataFrame([r + (1, 2, 3, 4, "x") for r in rows], SCHEMA).repartition(4)


def figures(frame):
    return sorted(str((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"])) for r in frame.collect())


@pytest.mark.parametrize("settings", [{}, {"percent": 40, "buckets": 97, "width": 2, "least_words": 1}])
def test_equals_brute_force(spark, settings):
    rows, target = odd_rows(), ["the zebra of 日本", None, "", "don't A b " * 30]
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    found = R.resample(table(spark, rows), wanted, **settings)
    names = {"least_words": "least"}
    expected = brute(rows, target, **{names.get(k, k): v for k, v in settings.items()})
    assert figures(found) == sorted(map(str, expected))
    assert any(r[5] for r in expected)


def test_empty_tables(spark):
    rows = odd_rows()[:40]
    none = spark.createDataFrame([], "text string")
    assert R.resample(table(spark, rows).limit(0), none).count() == 0
    assert figures(R.resample(table(spark, rows), none)) == sorted(map(str, brute(rows, [])))


def test_crc_of_equal_lengths():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 20_000, dtype=np.uint8)
    starts = rng.integers(0, 15_000, 500)
    ends = starts + np.concatenate([rng.integers(0, 30, 480), rng.integers(100, 5000, 20)])
    found = R.crc_ranges(data, starts, ends)
    assert found.tolist() == [zlib.crc32(data[s:e]) for s, e in zip(starts, ends, strict=True)]
    assert R.crc_rows(np.zeros((3, 0), np.uint8)).tolist() == [0, 0, 0]


@pytest.mark.parametrize("limit", [16, 64, 1000])
def test_long_texts_in_pieces(monkeypatch, limit):
    texts = [t for _, t in odd_rows()] + ["--" * 500, "w" * 900, " lead " * 70, "a" + " " * 300 + "b c"]
    monkeypatch.setattr(T.pieces, "__defaults__", (limit,))
    monkeypatch.setattr(T.chunks, "__defaults__", (limit,))
    monkeypatch.setattr(T, "CHUNK_BYTES", limit)
    got, words = [Counter() for _ in texts], [0] * len(texts)
    for first, found in R.row_features(pa.array(texts, pa.string()), 3, 10_000):
        for bucket, row in zip(found.buckets.tolist(), found.rows.tolist(), strict=True):
            got[first + row][bucket] += 1
        for row, n in enumerate(found.n_words.tolist()):
            words[first + row] += n
    for text, buckets, n in zip(texts, got, words, strict=True):
        n_words, runs = grams(text)
        assert n == n_words and buckets == Counter(zlib.crc32(g) % 10_000 for g in runs)
