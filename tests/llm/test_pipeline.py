"""The pipeline's stages, each against brute force on what the one before kept."""

import sys

import pytest
from test_line_dedup import SPACE
from test_mix_simhash_tokens import brute_targets
from test_near_copies import brute_firsts
from test_quality_and_notices import brute_counts

import corpus_pipeline as C
from salesight.llm import decontaminate as D
from salesight.llm import line_dedup as L
from salesight.llm import near_copies as N
from salesight.llm import quality_rules as Q
from salesight.llm.tables import text_key, write_table

sys.setrecursionlimit(10_000)


def rows_of(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", text_key(docs.text)).collect()]


def brute_quality(rows, rules):
    kept = []
    for i, text, _ in rows:
        c = brute_counts(text)
        if c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]:
            continue
        ratio = {k: c[a] / c[b] if c[b] else float("nan") for k, (a, b) in Q.RATIOS.items()}
        hit = lambda x: ratio[x.figure] > x.threshold if x.above else ratio[x.figure] <= x.threshold  # noqa: B023, E731
        if not any(all(hit(x) for x in rule) for rule in rules):
            kept.append((i, text))
    return kept


def brute_lines(rows):
    first, by_length = {}, {}
    for i, text, tk in rows:
        for ln, line in enumerate(text.split("\n")):
            if len(line.strip(SPACE)) >= L.LEAST_CHARS:
                place = (i, tk, ln)
                first[line.strip(SPACE)] = min(first.get(line.strip(SPACE), place), place)
    for line in first:
        if len(line) >= L.NEAR_CHARS:
            by_length.setdefault(len(line), []).append(line)
    known = {}

    def earliest(line):
        if line not in known:
            lengths = range(len(line) - L.DISTANCE, len(line) + L.DISTANCE + 1) if len(line) >= L.NEAR_CHARS else ()
            other = [b for n in lengths for b in by_length.get(n, ())]
            near = [first[b] for b in other if L.banded_distance(line, b, L.DISTANCE) <= L.DISTANCE]
            known[line] = min([first[line], *near])
        return known[line]

    kept = []
    for i, text, tk in rows:
        left = [
            line
            for ln, line in enumerate(text.split("\n"))
            if len(line.strip(SPACE)) < L.LEAST_CHARS or earliest(line.strip(SPACE)) >= (i, tk, ln)
        ]
        if len(left) == len(text.split("\n")) or "\n".join(left).strip(SPACE):
            kept.append((i, "\n".join(left)))
    return kept


def test_stages_against_brute_force(spark, small_dir):
    from test_decontaminate import tokens

    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    whole = {r.doc_id: r.text for r in docs.collect()}
    columns = docs.columns
    items = [tokens(r.text) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]

    def leaks(text):
        doc = tokens(text)
        places = {}
        for a in range(len(doc)):
            places.setdefault(doc[a], []).append(a)
        for item in items:
            shifts = {a - b for b, x in enumerate(item) for a in places.get(x, ())}
            for d in shifts:
                same = [0 <= b + d < len(doc) and doc[b + d] == x for b, x in enumerate(item)]
                if any(
                    sum(same[k : k + D.SPAN]) >= D.SPAN - D.SUBSTITUTIONS and 0 <= k + d and k + d + D.SPAN <= len(doc)
                    for k in range(len(item) - D.SPAN + 1)
                ):
                    return True
        return False

    for name, stage in C.STAGES:
        before = rows_of(docs)
        docs = write_table(stage(spark, docs, small_dir), "stage")
        after = sorted((r.doc_id, r.text) for r in docs.collect())
        if name == "quality rules":
            labels = spark.read.parquet(f"{small_dir}/labels.parquet")
            rules = Q.fit(spark.read.parquet(f"{small_dir}/documents.parquet"), labels)
            assert after == sorted(brute_quality(before, rules))
        elif name == "line dedup":
            assert after == sorted(brute_lines(before))
        elif name == "SimHash near-dedup":
            stay, pairs = brute_firsts({i: whole[i] for i, _, _ in before})
            assert after == sorted((i, t) for i, t, _ in before if i in stay)
        elif name == "benchmark decontamination":
            assert after == sorted((i, t) for i, t, _ in before if not leaks(t))
            assert len(after) < len(before)
        else:
            sizes = {}
            for r in docs.collect():
                sizes[r.source] = r.source_size
                assert 0 < r.taken <= 2 * r.size and r.size == len(r.text.split())
            total = {s: sum(r.taken for r in docs.collect() if r.source == s) for s in sizes}
            targets = brute_targets(sizes, (3, 1, 2), 1.5, 2)
            assert all(abs(total[s] - targets[s]) < 1 for s in sizes)
        if name != C.STAGES[-1][0]:
            assert docs.columns == columns and all(r.n_chars == len(r.text) for r in docs.collect())
    mixed = C.run(spark, small_dir)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, docs.collect()))


ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint, tk string, size int, kept string, _n int, _d int, _t int, _nth int, _order int, _removed int, `a.b` int"


@pytest.mark.parametrize("name,stage", C.STAGES)
def test_stages_with_odd_rows(spark, small_dir, name, stage):
    good = " ".join(f"word{i} and more" for i in range(40))
    rows = [
        (1, good, "en", "s", len(good), "x", 1, "k", 1), (1, good, "en", "s", len(good), "x", 1, "k", 1),
        (1, good + " tail", None, None, None, None, None, None, None), (None, good, "en", None, 5, "y", 2, "l", 2),
        (None, None, None, None, None, None, None, None, None), (2, "", "en", "s", 0, "z", 3, "m", 3),
        (3, "short", "", "", 5, "", 0, "", 0), (4, "w " * 5000, "en", "t", 10000, "w", 4, "n", 4),
    ]
    docs = spark.createDataFrame([r + (7, 8, 9, 10, 11, 12) for r in rows], ODD).repartition(3)
    kept = write_table(stage(spark, docs, small_dir), "odd")
    if name != C.STAGES[-1][0]:
        assert kept.schema == docs.schema
    else:
        assert set(docs.columns) <= set(kept.columns)
    assert {(r._d, r._t, r._nth, r._order, r._removed, r["a.b"]) for r in kept.collect()} <= {(7, 8, 9, 10, 11, 12)}
    found = [r.doc_id for r in kept.collect()]
    expected = {
        "quality rules": [1, 1, 1, None], "line dedup": None, "SimHash near-dedup": None,
        "benchmark decontamination": [r[0] for r in rows], "mixing sources": None,
    }[name]
    if expected is not None:
        assert sorted(map(str, found)) == sorted(map(str, expected))
    if name == "SimHash near-dedup":
        assert found.count(1) <= 2 and found.count(2) + found.count(None) <= 2
    assert stage(spark, docs.limit(0), small_dir).count() == 0


NEAR = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_near_copies_planted_before_the_pipeline(spark, tmp_path, small_dir):
    """Of each group with one word in forty replaced, one document is left after all stages."""
    import random
    import shutil

    rng = random.Random(6)
    words = [f"{a}{b}" for a in ("lo", "mi", "ka", "te", "su") for b in ("ran", "del", "fix", "gor", "hal", "tum", "pek")]
    rows, group = [], {}
    for base in range(12):
        text = [f"{rng.choice(words)}{rng.randrange(90)}" for _ in range(200)]
        for copy in range(4):
            changed = list(text)
            for at in range(copy * 7, 200, 80) if copy else ():
                changed[at] = f"new{base}x{copy}x{at}"
            lines = "\n".join(" ".join(changed[i : i + 20]) for i in range(0, 200, 20))
            group[len(rows)] = base
            rows.append((len(rows), lines, "en", f"s{copy}", len(lines)))
    spark.createDataFrame(rows, NEAR).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        shutil.copy(f"{small_dir}/{name}.parquet", f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    held = write_table(C.lines(spark, docs, str(tmp_path)), "held")
    assert held.count() == len(rows)  # lines alone leave a part of every copy
    kept = [r.doc_id for r in C.copies(spark, held, str(tmp_path)).collect()]
    assert sorted(kept) == [4 * base for base in range(12)]
    assert sorted(group[r.doc_id] for r in C.run(spark, str(tmp_path)).collect()) == list(range(12))


def lined(rng, n, of="word"):
    return "\n".join(" ".join(f"{of}{rng.randrange(10**6)}" for _ in range(20)) for _ in range(n))


def test_copies_in_the_texts_handed_on(spark, tmp_path):
    """Documents that differed in removed lines only are compared as op6 does it."""
    import random

    rng = random.Random(4)
    body, other = lined(rng, 10), lined(rng, 10)
    whole = [(0, body + "\n" + lined(rng, 9)), (1, lined(rng, 9) + "\n" + body.upper()), (2, other + "\n" + lined(rng, 3))]
    cut = [(0, body), (1, body.upper()), (2, other)]
    spark.createDataFrame(whole, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    kept = C.copies(spark, write_table(spark.createDataFrame(cut, "doc_id bigint, text string"), "cut"), str(tmp_path))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [cut[0], cut[2]]


def test_null_and_repeated_ids_are_compared_as_they_were(spark, tmp_path):
    import random

    rng = random.Random(5)
    texts = [lined(rng, 12) for _ in range(4)]
    lines = [t.split("\n") for t in texts]
    near = [t.replace(t.split()[-1], f"new{i}") for i, t in enumerate(texts)]  # the last word of the last line
    ids = [None, 7, 8, None]
    before = [(i, t) for i, t in zip(ids, texts, strict=True)] + [(i and 7, t) for i, t in zip(ids, near, strict=True)]
    before += [(8, texts[2]), (9, texts[0] + " "), (9, texts[0] + " ")]
    docs = [(i, t) for i, t in zip(ids, texts, strict=True)]
    docs += [(i and 7, t.split("\n")[-1]) for i, t in zip(ids, near, strict=True)] + [(9, lines[0][3])]
    columns = "doc_id bigint, text string"
    was = spark.createDataFrame(before, columns)
    found = N.earlier_texts(spark.createDataFrame(docs, columns), was).collect()
    expected = before[:8] + [(9, texts[0] + " ")]
    assert sorted(map(str, ((r.doc_id, r.text) for r in found))) == sorted(map(str, expected))
    was.write.parquet(f"{tmp_path}/documents.parquet")
    kept = C.copies(spark, write_table(spark.createDataFrame(docs, columns), "cut"), str(tmp_path))
    assert len({t.split()[0] for _, t in docs[:4]}) == 4 == kept.count()
