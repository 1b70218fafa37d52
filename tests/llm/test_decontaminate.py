"""Decontamination against token-by-token comparison of everything with everything."""

import random
import re
from itertools import combinations

import pytest

from salesight.llm import decontaminate as D

TOKEN = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def tokens(text):
    return TOKEN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    found = set()
    for i, text in docs:
        doc = tokens(text)
        for j, other in items:
            item = tokens(other)
            if len(item) < D.LEAST:
                continue
            width = min(D.SPAN, len(item))
            allowed = D.SUBSTITUTIONS if width == D.SPAN else 0
            for a in range(len(doc) - width + 1):
                for b in range(len(item) - width + 1):
                    if sum(x != y for x, y in zip(doc[a : a + width], item[b : b + width], strict=True)) <= allowed:
                        found.add((i, j))
    return found


def test_masks_fit_between_any_two_differing_tokens():
    for wrong in combinations(range(D.SPAN), D.SUBSTITUTIONS):
        assert any(
            not {start + place for place in mask} & set(wrong)
            for mask in D.MASKS
            for start in range(D.SPAN - mask[-1])
        )


@pytest.mark.parametrize("block_bytes", [1 << 20, 600])
def test_matches_brute_force(spark, block_bytes):
    rng = random.Random(4)
    vocab = ["the", "of", "and", *(f"w{i}" for i in range(60)), "é1"]
    words = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(j, " ".join(words(rng.choice([3, 5, 6, 9, 12, 13, 14, 25, 40])))) for j in range(30)]
    items += [(3, "other text of the same id " * 3), (40, None), (41, ""), (None, " ".join(words(20)))]
    docs = []
    for i in range(80):
        text = words(rng.randrange(0, 60))
        for _ in range(rng.randrange(3)):
            part = (rng.choice(items)[1] or "").split()
            part = part[rng.randrange(max(1, len(part) // 2)) :]
            for _ in range(rng.randrange(4)):
                if part:
                    part[rng.randrange(len(part))] = rng.choice(["x", "The", "OF"])
            text += part + words(rng.randrange(10))
        docs.append((i, "".join(w + rng.choice([" ", ", ", "\n", "-", "!! "]) for w in text)))
    docs += [(5, docs[0][1]), (None, docs[1][1]), (90, None), (91, ""), (92, " ".join(words(4000)) + " " + items[7][1])]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, item_id string").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = D.contaminated(frame, bench, block_bytes).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == brute(docs, items)
    by_id = {i: t for i, t in docs if i is not None and i != 5}
    texts = {j: t for j, t in items if j != 3}
    for r in rows:
        assert 0 <= r.start_word <= r.end_word
        if r.doc_id in by_id and r.item_id in texts:
            span = tokens(by_id[r.doc_id])[r.start_word : r.end_word + 1]
            assert len(span) == r.end_word - r.start_word + 1 and r.n_equal <= len(span)


def test_clean_documents_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, " ".join(f"q{i}" for i in range(20)))], "item_id bigint, text string")
    docs = spark.createDataFrame(
        [(1, " ".join(f"Q{i}," for i in range(2, 18))), (2, "clean"), (None, "clean"), (3, None)], "doc_id bigint, text string"
    )
    assert sorted(str(r.doc_id) for r in D.clean_documents(docs, bench).collect()) == ["2", "3", "None"]
    assert D.contaminated(docs, bench.limit(0)).count() == 0
    assert D.contaminated(docs.limit(0), bench).count() == 0
    assert D.clean_documents(docs, bench.limit(0)).count() == 4


def test_item_ids_are_reported_as_they_are(spark):
    words = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, words)], "doc_id bigint, text string")
    items = spark.createDataFrame([(-1, words), (None, words), (7, words), (8, None)], "item_id bigint, text string")
    found = D.contaminated(docs, items).collect()
    assert sorted((r.item_id is None, r.item_id or 0) for r in found) == [(False, -1), (False, 7), (True, 0)]
    assert {(r.doc_id, r.start_word, r.end_word, r.n_equal) for r in found} == {(1, 0, 19, 20)}
