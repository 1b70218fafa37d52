"""The recurrent network: gradients, windows, held-out accuracy and odd rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from salesight.llm import text as T
from salesight.llm import toxicity as X

LABELS = "doc_id bigint, quality int, toxic int"


def words_of(texts):
    return X.vocabulary([t.encode() for t in texts])


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    w = {k: v.astype(float) for k, v in X.initial().items()}
    w["word1"] = rng.normal(0, 0.3, w["word1"].shape)
    vocabulary, rows = words_of(["the idiot went home", "a b", "one two three four five six seven"])
    at, held = X.grid(rows[:-1], np.diff(rows))
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        x = X._read(vocabulary.embed(w) @ w["inputs"] + w["bias"], vocabulary.of[at])
        run = X.Run(w, x, held, keep=True)
        p = X._sigmoid(run.logit)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum(), x, run

    _, x, run = loss()
    found, _ = X.gradients(w, x, held, run, X._sigmoid(run.logit) - y)
    for name in ("out", "out_bias", "pick", "focus", "focus_bias", "state"):
        for _ in range(4):
            i = tuple(rng.integers(0, n) for n in w[name].shape)
            old, step = w[name][i], 1e-4
            w[name][i] = old + step
            up = loss()[0]
            w[name][i] = old - step
            down = loss()[0]
            w[name][i] = old
            assert (up - down) / (2 * step) == pytest.approx(float(found[name][i]), abs=1e-4)


def test_windows_cover_and_overlap():
    sizes = np.array([0, 1, 63, 64, 65, 112, 113, 5000])
    row, start, size = X.windows(sizes)
    for r, n in enumerate(sizes):
        own = [(int(s), int(k)) for s, k in zip(start[row == r], size[row == r], strict=True)]
        assert {i for s, k in own for i in range(s, s + k)} == set(range(n))
        assert all(b[0] - a[0] == X.STRIDE and a[1] == X.WINDOW for a, b in zip(own, own[1:], strict=False))
        assert len(own) == 1 or own[-1][1] > X.WINDOW - X.STRIDE


def test_scores_do_not_depend_on_company():
    rng = np.random.default_rng(3)
    w = X.initial()
    for name in ("word1", "word2", "char"):
        w[name] = rng.normal(0, 0.2, w[name].shape).astype(np.float32)
    model = {"weights": w, "scale": 1.0, "offset": 0.0}
    texts = ["", "one", "é ñ word " * 70, "some words here", "Some, WORDS here!"]
    alone = [X.score_texts(model, c)[0] for t in texts for c in T.chunks(pa.array([t]))]
    (chunk,) = T.chunks(pa.array(texts))
    assert np.allclose(X.score_texts(model, chunk), alone, atol=1e-5) and abs(alone[3] - alone[4]) < 1e-6


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    marks = {r.doc_id: r.toxic for r in labels.collect()}
    rows = X.score(docs, X.fit(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in marks]
    toxic = [r.predicted for r in held if marks[r.doc_id]]
    clean = [r.predicted for r in held if not marks[r.doc_id]]
    assert sum(toxic) > 0.88 * len(toxic) and sum(clean) < 0.04 * len(clean)


def test_odd_rows_and_missing_labels(spark):
    schema = "doc_id bigint, text string, score string, toxic int"
    docs = spark.createDataFrame([(1, None, "x", 1), (None, "", "y", 0), (1, "word", "z", 1), (2, "a" * 5000, "w", 0)], schema)
    none = X.fit(docs, spark.createDataFrame([], LABELS))
    assert [r.score for r in X.score(docs, none).collect()] == [0.0] * 4
    one = X.fit(docs, spark.createDataFrame([(1, 1, 1), (None, 1, 0), (2, None, None)], LABELS))
    assert {r.predicted for r in X.score(docs, one).collect()} == {1}
    both = X.fit(docs, spark.createDataFrame([(1, 1, 1), (2, 1, 0)], LABELS))
    assert X.score(docs, both).count() == 4 and X.score(docs.limit(0), both).count() == 0
