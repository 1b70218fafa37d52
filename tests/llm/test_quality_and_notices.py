"""Quality statistics, learned rules and license scans against plain Python."""

import random
import re

import numpy as np

from salesight.llm import notices as N
from salesight.llm import quality_rules as Q
from salesight.llm import text as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    lines = [line for line in text.split("\n") if WORD.search(line)]
    for line in lines:
        dup += line in seen
        seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(i, i + 3)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": dup, "n_repeat_words": len(repeated), "n_lines": len(lines),
        "n_upper": len(re.findall("[A-Z]", text)), "n_digits": len(re.findall("[0-9]", text)),
        "n_exclaim": text.count("!"), "n_distinct_words": len(set(words)),
    }


def texts():
    rng = random.Random(8)
    found = [None, "", "\n", " \n\n\t", "one", "a b c a b c", "é é é é", "x\r\nx\r\nx", "日本 | 語 # <b>", "\x0b a \x0c"]
    for n in (5, 30, 300, 900):
        found.append("".join(rng.choice(["a", "Bb", "é!", "12", "|", "c%"]) + rng.choice([" ", "\n", "\n\n", "  "]) for _ in range(n)))
    return found * 2


def test_statistics_match_plain_python(spark):
    rows = [(i, t, "z") for i, t in enumerate(texts())] + [(None, "a b", "z"), (0, "a b", "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_words string").repartition(3)
    found = sorted((tuple(r) for r in Q.statistics(docs).collect()), key=str)
    expected = [(i, *(brute_counts(t)[c] for c in Q.COUNTS)) for i, t, _ in rows]
    assert found == sorted(expected, key=str)
    assert Q.statistics(docs.limit(0)).count() == 0


def test_long_text_in_small_chunks():
    import pyarrow as pa

    some = [t for t in texts() if t is not None]
    whole = [Q.chunk_statistics(c) for c in T.chunks(pa.array(some))]
    parts = [Q.chunk_statistics(c) for c in T.chunks(pa.array(some), limit=50)]
    for name in Q.COUNTS:
        assert np.array_equal(np.concatenate([m[name] for m in whole]), np.concatenate([m[name] for m in parts]))


def test_rules_learn_and_prune():
    rng = np.random.default_rng(1)
    n = 3000
    figures = {name: rng.random(n) for name in Q.RATIOS}
    bad = (figures["symbols_per_word"] > 0.8) | ((figures["upper_share"] > 0.7) & (figures["digit_share"] <= 0.4))
    bad ^= rng.random(n) < 0.01
    rules = Q.learn(figures, bad)
    rejected = np.zeros(n, bool)
    for rule in rules:
        rejected[Q.covers(rule, figures, np.arange(n))] = True
    assert (rejected == bad).mean() > 0.95 and 2 <= len(rules) <= 16
    assert Q.learn(figures, np.zeros(n, bool)) == [] and Q.learn(figures, rng.random(n) < 0.05) == []


def test_held_out_precision(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    train = labels.filter("pmod(doc_id, 3) <> 0")
    judged = Q.judge(Q.statistics(docs), Q.fit(docs, train)).join(labels.filter("pmod(doc_id, 3) = 0"), "doc_id")
    rows = judged.select("quality", "kept", "base_failed").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) > 0.97 * len(good)
    assert sum(not r.kept for r in bad) > 0.8 * len(bad)


def test_fit_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b c " * 30), (2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(None, 0), (1, None)], "doc_id bigint, quality int")
    rules = Q.fit(docs, labels)
    rows = {r.doc_id: r for r in Q.judge(Q.statistics(docs), rules).collect()}
    assert rules == [] and rows[1].base_failed and not rows[1].kept and not rows[2].kept


def brute_scan(text):
    words = TOKEN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = []
    for phrase, label in N.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), sorted({x for _, x in places})


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_phrases_and_notices(spark):
    rng = random.Random(3)
    rows = [None, "", "MIT License", "The mit. LICENSE mit license", "cc-by CC BY-NC", "apache\nlicense é", "gnu general public"]
    expected = {}
    for i in range(150):
        words, label = rng.choice(list(N.NOTICES.items()))
        noisy = list(words)
        errors = N.notice(words, label).errors
        for _ in range(rng.randrange(errors + 1)):
            k = rng.randrange(len(noisy))
            noisy[k : k + 1] = rng.choice([[], ["q"], ["q", noisy[k]]])
        before = " ".join(rng.choice(["lorem", "the", "é", "x1"]) for _ in range(rng.randrange(30)))
        plain = " ".join("".join(noisy).split())
        if edit_distance(plain, words) <= errors:
            expected[len(rows)] = label
        rows.append(f"{before} {''.join(noisy)} and more {before}".upper() if i % 2 else f"{before}\n{''.join(noisy)}.")
    docs = spark.createDataFrame([(i, t, "q") for i, t in enumerate(rows)], "doc_id bigint, text string, labels string")
    for r in N.scan(docs.repartition(2)).collect():
        text = rows[r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_scan(text)
        assert 0 <= r.score <= 1
        if r.doc_id in expected:
            assert expected[r.doc_id] in [n.label for n in r.notices]
        words = TOKEN.findall((text or "").lower())
        for n in r.notices:
            phrase = next(p for p, label in N.NOTICES.items() if label == n.label)
            span = " ".join(words[n.start_word : n.end_word + 1])
            assert n.edits <= N.MOST_ERRORS
            assert abs(len(span) - len(phrase)) <= 12 and edit_distance(span, phrase) <= n.edits + 12
    assert N.scan(docs.limit(0)).count() == 0


def test_clean_text_has_no_notice(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    for r in N.scan(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_scan(r.text)
        if "licen" not in r.text.lower():
            assert r.notices == [] and r.score == 0
