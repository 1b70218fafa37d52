"""Line dedup against all pairs of lines."""

import random

import pytest

from salesight.llm import line_dedup as L

SPACE = " \t\n\v\f\r"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        k = rng.randrange(len(text) + 1)
        text[k : k + rng.randrange(2)] = rng.choice([[], [rng.choice("abé日")]])
    return "".join(text)


def test_banded_distance():
    rng = random.Random(1)
    for _ in range(4000):
        a = "".join(rng.choice("abcé") for _ in range(rng.choice([0, 1, 2, 5, 30, 90])))
        b = edited(rng, a, rng.randrange(9)) if rng.random() < 0.8 else a[::-1]
        for most in (0, 1, 2, 3, 7):
            assert L.banded_distance(a, b, most) == min(distance(a, b), most + 1), (a, b, most)


def brute(rows, most, least):
    place = lambda i, tk, ln: (i is None, i or 0, tk, ln)
    lines = {}
    for i, tk, t in rows:
        for ln, line in enumerate((t or "").split("\n")):
            if len(line.strip(SPACE)) >= least:
                lines.setdefault(line.strip(SPACE), []).append(place(i, tk, ln))
    found = []
    near = {a: [b for b in lines if a != b and abs(len(a) - len(b)) <= most and distance(a, b) <= most] for a in lines}
    for i, tk, t in rows:
        gone, exact = [], 0
        for ln, line in enumerate((t or "").split("\n")):
            line, here = line.strip(SPACE), place(i, tk, ln)
            if line in lines:
                equal = min(lines[line]) < here
                if equal or any(min(lines[b]) < here for b in near[line]):
                    gone.append(ln)
                    exact += equal
        found.append((i, len((t or "").split("\n")), exact, len(gone) - exact, gone))
    return sorted(found, key=str)


@pytest.mark.parametrize("most,least", [(1, 6), (2, 9), (3, 20)])
def test_matches_all_pairs(spark, most, least):
    rng = random.Random(most)
    base = ["".join(rng.choice("abé 日c") for _ in range(rng.randrange(4, 60))) for _ in range(25)]
    rows = []
    for i in range(70):
        text = [edited(rng, rng.choice(base), rng.randrange(most + 2)) for _ in range(rng.randrange(5))]
        rows.append((i, "\n".join(text + rng.choice([[], ["", "  \t"], [" " + rng.choice(base) + "\r"]]))))
    rows += [(5, rows[1][1]), (5, rows[1][1]), (None, rows[2][1]), (None, "q" * 40), (100, None), (101, ""), (102, "é" * 5000)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, line string").repartition(3)
    keyed = [tuple(r) for r in docs.select("doc_id", L.text_key(docs.text), "text").collect()]
    found = sorted(((r.doc_id, r.n_lines, r.n_exact, r.n_near, r.removed) for r in L.line_counts(docs, most, least).collect()), key=str)
    assert found == brute(keyed, most, least)


def test_documents_without_their_repeated_lines(spark):
    schema = "doc_id bigint, text string, n_chars bigint, tk string, removed int"
    long = "a line that is long enough to count"
    docs = spark.createDataFrame(
        [(1, f"{long}\nshort\nother", 0, "x", 1), (2, long, 0, "y", 2), (3, f"mine\n {long}!", 0, "z", 3), (4, None, 7, "n", 4), (5, "", 0, "e", 5)],
        schema,
    )
    kept = {r.doc_id: r for r in L.drop_repeated_lines(docs).collect()}
    assert sorted(kept) == [1, 3, 4, 5] and kept[3].text == "mine" and kept[3].n_chars == 4
    assert kept[1].text == f"{long}\nshort\nother" and kept[4].text is None and kept[4].n_chars == 7 and kept[5].text == ""
    assert L.drop_repeated_lines(docs.limit(0)).count() == 0


def test_equal_lines_go_at_any_length(spark):
    texts = ["Ietzte.\nx\n\nmine", "Ietzte.\n \ny\n x", "Ietzte!\n\né", "é\nX", "Ietzte."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    found = {r.doc_id: (r.n_exact, r.n_near, r.removed) for r in L.line_counts(docs).collect()}
    assert found == {0: (0, 0, []), 1: (2, 0, [0, 3]), 2: (0, 0, []), 3: (1, 0, [0]), 4: (1, 0, [0])}
    kept = {r.doc_id: r.text for r in L.drop_repeated_lines(docs).collect()}
    assert kept == {0: texts[0], 1: " \ny", 2: texts[2], 3: "X"}
