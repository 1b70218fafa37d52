"""The Merkle manifest against a plain recursive one, at several arities and on odd rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from salesight.llm import merkle as M

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, `a.b` int, _slice int, copy string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(row, text):
    return sha(*[encoded(v) for v in (row.doc_id, row.source, row.lang, row.n_chars, text)])


def climb(hashes, arity):
    """The last node, and for every leaf its siblings as (left, right) per level."""
    proofs, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        runs = [hashes[i : i + arity] for i in range(0, len(hashes), arity)]
        for leaf, i in enumerate(at):
            run, slot = runs[i // arity], i % arity
            proofs[leaf].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
        hashes, at = [sha(*run) for run in runs], [i // arity for i in at]
    return hashes[0], proofs


def brute(rows, arity):
    groups = {}
    for row in rows:
        groups.setdefault(row.source, []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        own = sorted(groups[name], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
        trees.append((own, *climb([leaf_of(r, r.text) for r in own], arity)))
    root, above = climb([t[1] for t in trees], arity)
    found = []
    for (own, subroot, proofs), top in zip(trees, above, strict=True):
        for row, proof in zip(own, proofs, strict=True):
            path, text = proof + top, row.text
            if row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            folded = leaf_of(row, text)
            for left, right in path:
                folded = sha(left, folded, right)
            siblings = sha(*[left + right for left, right in path])
            found.append((row.doc_id, leaf_of(row, row.text), subroot, root, siblings, folded, folded == root))
    return found


def ours(docs, arity):
    now = M.leaf_digest(changed={"text": M.without_breaks(F.col("doc_id"), F.col("text"))})
    made = M.build(docs, arity=arity, keep={"doc_id": F.col("doc_id"), "found": now})
    return M.verify(made, "found").select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


def odd_rows():
    rng = random.Random(3)
    rows = [
        (None, None, None, None, None), (None, None, None, None, ""), (None, None, None, None, "-"),
        (0, "", "", 0, ""), (-5, "a", "é", 7, "x\ny"), (4, "lone", "en", 1, "one\n"),
        (7, "a", "en", 3, "big\n" * 300_000), (7, "a", "en", 3, "same id"), (7, "a", "en", 3, "same id"),
    ]
    rows += [(i, "hot", "en", i % 9, f"text {i}\n" * rng.randrange(3)) for i in range(100, 141)]
    rows += [(i, "日本", None, None, None) for i in range(200, 209)] + [(300, "\U0001f600", "en", 1, "z")]
    extra = [(f"t{i}", i, i, None) for i in range(len(rows))]
    return [r + e for r, e in zip(rows, extra, strict=True)]


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_equals_a_plain_manifest(spark, arity):
    docs = spark.createDataFrame(odd_rows(), SCHEMA).repartition(5)
    found = [tuple(r) for r in ours(docs, arity).collect()]
    assert sorted(map(str, found)) == sorted(map(str, brute(docs.collect(), arity)))
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("rows", [0, 1, 2, 4, 9, 10])
def test_small_trees(spark, rows):
    docs = spark.createDataFrame(odd_rows(), SCHEMA).filter("source = 'hot'").limit(rows)
    found = [tuple(r) for r in ours(docs, 3).collect()]
    assert len(found) == rows
    assert not rows or sorted(found) == sorted(brute(docs.collect(), 3))


def test_many_equal_rows_are_leaves_of_their_own(spark):
    docs = spark.range(3000).select(
        F.lit(1).cast("bigint").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"),
        F.lit(1).cast("bigint").alias("n_chars"), F.lit("t").alias("text"),
    )
    found = ours(docs, 3).collect()
    assert len(found) == 3000 and all(r.verified for r in found)
    assert {(r.subroot, r.root) for r in found} == {(r[2], r[3]) for r in brute(docs.collect(), 3)}


@pytest.mark.parametrize("column,value", [("lang", "'fr'"), ("n_chars", "null"), ("text", "text || ' '"), ("source", "''")])
def test_any_change_of_a_leaf_is_seen(spark, column, value):
    docs = spark.createDataFrame(odd_rows(), SCHEMA).filter("doc_id >= 100").withColumn("doc_id", F.col("doc_id"))
    changed = M.leaf_digest(changed={column: F.when(F.col("doc_id") == 120, F.expr(value)).otherwise(F.col(column))})
    made = M.build(docs, keep={"doc_id": F.col("doc_id"), "found": changed})
    assert [r.doc_id for r in M.verify(made, "found").filter("not verified").collect()] == [120]


def test_nodes_of_the_manifest(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA).filter("source in ('hot', 'lone')")
    counts = {(r.tree, r.level): r["count"] for r in M.nodes(M.build(docs)).groupBy("tree", "level").count().collect()}
    assert counts == {
        ("=hot", 0): 41, ("=hot", 1): 14, ("=hot", 2): 5, ("=hot", 3): 2, ("=hot", 4): 1,
        ("=lone", 0): 1, (None, 0): 2, (None, 1): 1,
    }


def test_levels_are_equijoins(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    made = M.build(docs)
    plan = M.with_siblings(made.levels[0].select("tree", "idx", "n", "hash"), 3)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
