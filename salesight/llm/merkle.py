"""A Merkle manifest of a dataset: digests of rows, of subtrees by group, and one root.

Every row is a leaf, the SHA-256 of its columns in a form that tells nulls, empty values
and neighbouring values apart. The leaves of a group (``tree``) stand in order and every
run of ``arity`` nodes becomes one node of the next level, until one is left, the group's
subroot. The subroots, in the order of the groups, are the leaves of a last tree of the
same kind, whose end is the root of the dataset.

Method: nodes carry their index, so each level is a self-join on computed indices - a
node's siblings stand at its index with the last bit turned (two to a run) or at the other
slots of its run - and the nodes in slot zero emit the parents. Going down again, each
level joins its parents' proofs and puts its own siblings in front. Keys of these joins
are unique, so a group that holds most rows is spread like any other; the number of levels
is the logarithm of the largest group.

Rows: a null column has a mark of its own; null, empty and very long texts are digested
like any other, in the JVM; leaves of one id are ordered by their digest, a null id
comes first, and rows equal in all columns are leaves of their own; a null group comes
first; an empty table has no leaves and no root. Other columns, of whatever name, are not
read unless asked for by ``keep``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesight.llm.tables import column, write_table
from salesight.operators.ordering import running_before

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3

_STEP = "array<struct<left:string,right:string>>"


class Manifest(NamedTuple):
    """Written levels, leaves first, of the groups' trees and of the tree over their subroots.

    A level has tree, idx, n (nodes of its tree on this level), hash, and the joined
    digests of the siblings to the left and right; leaves have ``kept`` columns as well.
    """

    levels: list[DataFrame]
    top: list[DataFrame]
    kept: list[str]
    arity: int


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(
    columns: Sequence[str] = COLUMNS, changed: Mapping[str, Column] | None = None
) -> Column:
    """The leaf of a row; ``changed`` gives other values for some of its columns."""
    values = [(changed or {}).get(c, column(c)) for c in columns]
    return digest(*[encoded(v) for v in values])


def sibling_index(index: Column, shift: int, arity: int) -> Column:
    """Where a node's sibling stands that is ``shift`` slots further, around its run."""
    if arity == 2:
        return index.bitwiseXOR(F.lit(1).cast("bigint"))
    slot = index % arity
    return index - slot + (slot + shift) % arity


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` and what stands left and right of each in its run, one equijoin a shift."""
    joined, found = nodes, []
    for shift in range(1, arity):
        at, there = f"at_{shift}", f"hash_{shift}"
        other = nodes.select("tree", F.col("idx").alias(at), F.col("hash").alias(there))
        joined = joined.withColumn(at, sibling_index(F.col("idx"), shift, arity))
        joined = joined.join(other, ["tree", at], "left")
        found.append(F.struct(F.col(at).alias("at"), F.col(there).alias("hash")))
    siblings = F.array_sort(F.filter(F.array(*found), lambda s: s.getField("hash").isNotNull()))

    def side(keep) -> Column:
        hashes = F.transform(F.filter(siblings, keep), lambda s: s.getField("hash"))
        return F.array_join(hashes, "")

    return joined.select(
        *nodes.columns,
        side(lambda s: s.getField("at") < F.col("idx")).alias("left"),
        side(lambda s: s.getField("at") > F.col("idx")).alias("right"),
    )


def grow(nodes: DataFrame, arity: int, name: str) -> list[DataFrame]:
    """All levels over written ``nodes`` (tree, idx, n, hash), up to each tree's last node."""
    largest = nodes.agg(F.max("n")).first()[0] or 0
    levels: list[DataFrame] = []
    while True:
        level = write_table(with_siblings(nodes, arity), f"{name}-{len(levels)}")
        levels.append(level)
        if largest <= 1:
            return levels
        largest = -(-largest // arity)
        first = level.filter((F.col("n") > 1) & (F.col("idx") % arity == 0))
        nodes = first.select(
            "tree",
            F.expr(f"idx div {arity}").alias("idx"),
            F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            digest(F.col("hash"), F.col("right")).alias("hash"),
        )


def build(
    docs: DataFrame,
    columns: Sequence[str] = COLUMNS,
    tree: str = "source",
    order: str = "doc_id",
    arity: int = ARITY,
    keep: Mapping[str, Column] | None = None,
) -> Manifest:
    """The manifest of ``docs``: a tree for each value of ``tree``, its leaves by ``order``.

    ``keep`` names columns that the leaves carry along; ``tree``, ``idx``, ``n``, ``hash``,
    ``left``, ``right``, ``copy`` and ``path`` are not free.
    """
    carried = dict(keep or {})
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), column(tree).cast("string")), F.lit("")).alias("tree"),
        column(order).alias("place"),
        leaf_digest(columns).alias("hash"),
        *[c.alias(name) for name, c in carried.items()],
        # written: parts equal rows of any number
        F.monotonically_increasing_id().alias("copy"),
    )
    by = [F.col("place").asc_nulls_first(), F.col("hash"), F.col("copy")]
    placed = running_before(
        write_table(leaves, "merkle-leaves"), by, F.lit(1).cast("bigint"), "idx", ["tree"], total="n"
    )
    levels = grow(
        write_table(placed.select("tree", "idx", "n", "hash", *carried), "merkle-placed"),
        arity,
        "merkle",
    )
    ends = [level.filter("n = 1").select("tree", "hash") for level in levels]
    subroots = write_table(reduce(DataFrame.unionByName, ends), "merkle-subroots")
    ranked = running_before(subroots, [F.col("tree")], F.lit(1).cast("bigint"), "idx", total="n")
    over = ranked.select(F.lit("").alias("tree"), "idx", "n", "hash", F.col("tree").alias("name"))
    top = grow(write_table(over, "merkle-named"), arity, "merkle-top")
    return Manifest(levels, top, list(carried), arity)


def nodes(made: Manifest) -> DataFrame:
    """The manifest as a table: tree (null for the last one), level, idx, hash."""
    tables = [
        level.select(
            (F.col("tree") if below else F.lit(None).cast("string")).alias("tree"),
            F.lit(i).alias("level"),
            "idx",
            "hash",
        )
        for below, levels in ((True, made.levels), (False, made.top))
        for i, level in enumerate(levels)
    ]
    return reduce(DataFrame.unionByName, tables)


def _descend(levels: list[DataFrame], ends: DataFrame, arity: int) -> DataFrame:
    """The lowest level with ``path``, its siblings from there up through ``ends`` to the root.

    ``ends`` has a row for each tree: tree, path (what follows after its last node) and
    columns that all its nodes are given.
    """
    given = [c for c in ends.columns if c not in ("tree", "path")]
    at_end = ends.select("tree", F.lit(-1).cast("bigint").alias("parent"), *given, "path")
    above = at_end
    for i, level in reversed(list(enumerate(levels))):
        parent = F.when(F.col("n") == 1, F.lit(-1)).otherwise(F.expr(f"idx div {arity}"))
        rows = level.withColumn("parent", parent.cast("bigint")).join(above, ["tree", "parent"])
        own = F.array(F.struct("left", "right")).cast(_STEP)
        path = F.when(F.col("n") == 1, F.col("path")).otherwise(F.concat(own, F.col("path")))
        found = rows.withColumn("path", path)
        if i:
            below = found.select("tree", F.col("idx").alias("parent"), *given, "path")
            above = below.unionByName(at_end)
    return found


def proofs(made: Manifest) -> DataFrame:
    """Every leaf with its subroot, the root and ``path``: the siblings to the left and right
    of it and of its ancestors, from its own run to the last one."""
    root = made.top[-1].filter("n = 1")
    none = F.array().cast(_STEP)
    ends = root.select("tree", F.col("hash").alias("root"), none.alias("path"))
    trees = _descend(made.top, ends, made.arity)
    trees = trees.select(F.col("name").alias("tree"), F.col("hash").alias("subroot"), "root", "path")
    leaves = _descend(made.levels, write_table(trees, "merkle-paths"), made.arity)
    return leaves.select(
        "tree", "idx", F.col("hash").alias("leaf"), *made.kept, "subroot", "root", "path"
    )


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(
        path, leaf, lambda below, p: digest(p.getField("left"), below, p.getField("right"))
    )


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a proof, level by level, left to right."""
    steps = F.transform(path, lambda p: F.concat(p.getField("left"), p.getField("right")))
    return digest(F.array_join(steps, ""))


def without_breaks(key: Column, text: Column) -> Column:
    r"""A text with its \n deleted in the rows where 2 divides the CRC-32 of the key."""
    return F.when(F.crc32(key.cast("string")) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def verify(made: Manifest, leaf: str) -> DataFrame:
    """Every leaf's proof, folded from the kept column ``leaf`` (its digest as found now).

    ``verified`` says whether that leads to the root of the manifest.
    """
    found = proofs(made).withColumns(
        {"proof_sha256": proof_digest(F.col("path")), "folded_root": fold(F.col(leaf), F.col("path"))}
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root")).drop("path")
