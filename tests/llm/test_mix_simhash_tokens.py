"""Mixing, SimHash and token counts against brute force and on odd inputs."""

import random
import re

import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from salesight.llm import mixing, simhash, token_counts
from salesight.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def odd_texts():
    rng = random.Random(5)
    vocab = ["the", "Of", "that's", "é", "x́", "日本", "##", "12", "don't", "<|endoftext|>"]
    texts = [None, "", " \n\t ", "one", "two words", "a b c \x1c d\x85e", "\x00\x01 z"]
    texts += ["Café ÉCOLE İstanbul ΣΑΣ", "x<|startoftext|>y <|endoftext|>", "a" * 3000]
    for n in (3, 4, 10, 200, 3000):
        texts.append("".join(rng.choice(vocab) + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(n)))
    return texts


@pytest.fixture(scope="module")
def odd(spark):
    texts = odd_texts()
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    rows += [(None, texts[-1], None, None, None), (3, "one", "en", "s", 1), (900, texts[-1], "", "", 0)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def brute_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_match_brute_force(odd):
    for row in simhash.fingerprints(odd).join(odd.select("doc_id", "text"), "doc_id").collect():
        if row.doc_id != 3:
            assert row.fp % (1 << 64) == brute_fingerprint(row.text)


def test_every_close_pair_is_found_once(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(40)]
    near = {b ^ sum(1 << i for i in rng.sample(range(64), k)) for b in base for k in (1, 2, 3, 4, 5)}
    values = sorted({b - (1 << 63) for b in near | set(base) | {0, 7, (1 << 64) - 1}})
    frame = spark.createDataFrame([(v,) for v in values], "fp bigint")
    found = [(r.u, r.v) for r in simhash.close_pairs(frame).collect()]
    expected = {(a, b) for a in values for b in values if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert len(found) == len(set(found)) and set(found) == expected


def test_components_match_union_find(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)]
    links += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(50)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    frame = spark.createDataFrame(links, "u bigint, v bigint")
    found = {r.u: r.root for r in components(frame).collect()}
    assert found == {x: find(x) for x in list(root) if find(x) != x}


def test_near_duplicates_classes(spark, odd):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].component_id == by_id[1].component_id == by_id[2].component_id == 0
    assert by_id[900].component_id == by_id[14].component_id == 14
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_near_duplicates_match_brute_force(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    texts = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}
    group = {d: d for d in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            for b in texts:
                if group[a] < group[b] and (texts[a] ^ texts[b]).bit_count() <= 3:
                    group[b], changed = group[a], True
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()} == group


def test_token_counts_equal_the_library(odd, small_dir, spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    docs = odd.unionByName(spark.read.parquet(f"{small_dir}/documents.parquet").select(*odd.columns))
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    expected = sorted(
        (i if i is not None else -1, len(t.encode()), n := len(tokenizer.encode(t, add_special_tokens=False).ids), n > 2048)
        for i, t in texts
    )
    for size in (0, 50, 20_000):
        found = token_counts.token_counts(docs, path, entries=size).collect()
        assert sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in found) == expected
    assert token_counts.token_counts(odd.limit(0), path).count() == 0


def test_cache_of_a_worker_stays_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_ENTRIES", 10)
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        encoder = token_counts.Encoder(file.read())
    words = [f"w{i}".encode() for i in range(8)]
    assert encoder.lengths(words) == encoder.lengths(words)
    assert encoder.lengths([b"hello", b"a", b"b"]) == [1, 1, 1] and len(encoder.cache) == 3


def brute_targets(sizes, weights, share, epochs):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if epochs * sizes[s] <= weight[s] * unit]
        if not over:
            return target | {s: weight[s] * unit for s in open_}
        for s in over:
            target[s] = epochs * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


def test_mix_reaches_targets(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", "é", None]), rng.randrange(0, 400)) for i in range(500)]
    rows += [(7, "b", 10), (7, "b", 10), (None, "solo", 33), (501, "none", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint").withColumn("target", mixing.F.lit("x"))
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    expected = brute_targets(sizes, (3, 1, 2), 1.5, 2)
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    assert all(0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source] for r in found)
    for s, target in expected.items():
        taken = sum(r.taken for r in found if r.source == s)
        assert abs(taken - target) < 1 and all(abs(r.target - target) < 1e-6 for r in found if r.source == s)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    times = [r.virtual_finish for r in found if r.virtual_finish is not None]
    assert times == sorted(times)


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, source string, size bigint")
    assert mixing.mix(empty).count() == 0
    blank = spark.createDataFrame([(1, None, 0), (2, "a", 0)], empty.schema)
    assert [(r.taken, r.target) for r in mixing.mix(blank).collect()] == [(0, 0.0), (0, 0.0)]
