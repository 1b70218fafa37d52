"""Clusters, silhouettes and principal components from sums over fixed-point features.

Standardised features are rounded to whole millionths. Their sums are then exact, so every
layout, cluster size and retry gives the same centres, and another engine can state them.
Each pass over the rows is one scan and one aggregate of a few rows; only those reach the
driver. The points are written once (``fixed_points`` on a staged table) and read again by
every pass, so a lost executor costs a re-read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = 1_000_000
STEPS = 20
#: Sums of millionths and of their products, exact beyond what a bigint holds. The steps sum in
#: bigint: n z-scores are at most n in sum, sign or not, so it holds up to 9e12 rows.
_SUM, _PRODUCT = "decimal(20,0)", "decimal(28,0)"

Centres = dict[int, list[tuple[float, ...]]]


def fixed_points(df: DataFrame, cols: Sequence[str], out: str = "z") -> DataFrame:
    """Add the columns' z-scores (sample deviation) as an array of millionths.

    A column without spread is 0 everywhere; rows with a null in one of them must be
    gone. An empty table stays empty.
    """
    figures = [f(F.col(c).cast("double")) for c in cols for f in (F.avg, F.stddev_samp)]
    found = df.agg(*figures).first()
    scores = []
    for i, c in enumerate(cols):
        mean, spread = found[2 * i], found[2 * i + 1]
        score = (F.col(c).cast("double") - F.lit(mean)) / F.lit(spread or None)
        scores.append(F.coalesce(F.round(score * UNIT), F.lit(0.0)).cast("bigint"))
    return df.withColumn(out, F.array(*scores))


def start_centres(points: DataFrame, most: int) -> list[tuple[float, ...]]:
    """The first ``most`` distinct points in the order of a hash of their values."""
    order = F.md5(F.concat_ws("|", F.col("z").cast("array<string>")))
    first = points.select("z").distinct().orderBy(order).limit(most)
    return [tuple(map(float, r.z)) for r in first.collect()]


def with_nearest(
    points: DataFrame, centres: Mapping[int, Sequence[Sequence[float]]], k: str, cluster: str, d: str
) -> DataFrame:
    """Each point once for every entry of ``centres``, with its number of clusters, nearest
    centre (ties to the lower number) and squared distance.

    The coordinates come as columns of a small constant table next to the point, with
    infinity for centres that a fit lacks: one short expression serves all fits, and
    stays in compiled code.
    """
    most = max(map(len, centres.values()))
    width = len(next(iter(centres.values()))[0])

    def entry(n: int, held: Sequence[Sequence[float]]) -> str:
        held = [*held, *[(float("inf"),) * width] * (most - len(held))]
        fields = [f"'_c{j}_{i}', {_literal(x)}" for j, c in enumerate(held) for i, x in enumerate(c)]
        return f"named_struct('{k}', {n}, {', '.join(fields)})"

    def squared(j: int) -> str:
        return " + ".join(f"(_z{i} - _c{j}_{i}) * (_z{i} - _c{j}_{i})" for i in range(width)) + f" AS _d{j}"

    table = ", ".join(entry(n, c) for n, c in centres.items())
    numbers = [f"cast(coalesce(z[{i}], 0) AS double) AS _z{i}" for i in range(width)]
    measured = (
        points.selectExpr("*", *numbers)
        .selectExpr("*", f"inline(array({table}))")
        .selectExpr(*points.columns, k, *map(squared, range(most)))
    )
    distances = ", ".join(f"_d{j}" for j in range(most))
    found = measured.selectExpr("*", f"least({distances}) AS {d}" if most > 1 else f"_d0 AS {d}")
    which = " ".join(f"WHEN _d{j} = {d} THEN {j}" for j in range(most))
    return found.selectExpr(*points.columns, k, f"CASE {which} ELSE 0 END AS {cluster}", d)


def _literal(x: float) -> str:
    return "double('Infinity')" if x == float("inf") else f"{float(x)!r}D"


def step_sums(points: DataFrame, centres: Mapping[int, Sequence[Sequence[float]]]) -> DataFrame:
    """k, cluster, n, the sums s0, s1, ... of the points at each centre, and their cost.

    One scan serves all numbers of clusters: a row names its centre for each of them, and
    the sums combine before they are shuffled.
    """
    width = len(next(iter(centres.values()))[0])
    placed = with_nearest(points.select("z"), centres, "k", "cluster", "d")
    sums = [F.sum(F.col("z")[i]).alias(f"s{i}") for i in range(width)]
    return placed.groupBy("k", "cluster").agg(F.count(F.lit(1)).alias("n"), *sums, F.sum("d").alias("cost"))


def fit(points: DataFrame, ks: Sequence[int], steps: int = STEPS) -> tuple[Centres, dict[int, float]]:
    """Centres and within-cluster sum of squares for every number of clusters in ``ks``.

    ``points`` has ``z`` (see ``fixed_points``). All fits start from the first points by
    hash and move together, ``steps`` times or until no centre moves; a fit that has come to
    rest is not measured again; a centre without points stays where it is. Fewer distinct points than clusters give that many clusters;
    no points give no centres.
    """
    start = start_centres(points, max(ks))
    if not start:
        return {k: [] for k in ks}, dict.fromkeys(ks, 0.0)
    centres: Centres = {k: start[:k] for k in ks}
    moving, cost = centres, dict.fromkeys(ks, 0.0)
    for step in range(steps + 1):
        found = step_sums(points, moving).collect()  # a row for each centre
        moved = {k: list(c) for k, c in moving.items()}
        cost |= dict.fromkeys(moving, 0.0)
        for r in found:
            moved[r.k][r.cluster] = tuple(float(r[f"s{i}"]) / float(r.n) for i in range(len(start[0])))
            cost[r.k] += r.cost / UNIT**2
        if step == steps:
            break
        moving = {k: c for k, c in moved.items() if c != moving[k]}
        centres |= moving
        if not moving:
            break
    return centres, cost


def assign(points: DataFrame, centres: Sequence[Sequence[float]], out: str = "prediction") -> DataFrame:
    """Add the number of the nearest centre."""
    if not centres:
        return points.withColumn(out, F.lit(0))
    return with_nearest(points, {len(centres): centres}, "_k", out, "_d").drop("_k", "_d")


def silhouette(placed: DataFrame, cluster: str = "prediction") -> DataFrame:
    """One row: the mean silhouette (squared Euclidean) of rows with ``z`` and a cluster.

    A cluster's count, sum and sum of squares give every row's mean distance to it, so the
    rows are read twice and never paired. A cluster of one row counts 0; a single cluster
    or no rows give null.
    """
    z = F.transform("z", lambda x: x / F.lit(float(UNIT)))
    rows = placed.select(F.col(cluster).alias("c"), z.alias("z"))
    own = F.aggregate("z", F.lit(0.0), lambda total, x: total + x * x)
    width = F.max(F.size("z")).alias("width")
    squares = rows.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.sum(own).alias("q"), width).collect()
    if len(squares) < 2:
        return placed.sparkSession.createDataFrame([(None,)], "silhouette double")
    wide = squares[0].width
    sums = {
        r.c: r for r in placed.groupBy(F.col(cluster).alias("c")).agg(
            *[F.sum(F.col("z")[i].cast(_SUM)).alias(f"s{i}") for i in range(wide)]
        ).collect()
    }

    def distance(r, self_: bool) -> Column:
        dot = F.lit(0.0)
        for i in range(wide):
            dot = dot + F.col("z")[i] * F.lit(float(sums[r.c][f"s{i}"]) / UNIT / r.n)
        mean = own - 2 * dot + F.lit(r.q / r.n)
        return mean * F.lit(r.n / (r.n - 1)) if self_ else mean

    inside = F.coalesce(*[F.when(F.col("c") == r.c, distance(r, True)) for r in squares if r.n > 1], F.lit(None).cast("double"))
    outside = F.array_min(F.array(*[F.when(F.col("c") != r.c, distance(r, False)) for r in squares]))
    value = (F.col("b") - F.col("a")) / F.greatest("a", "b")
    scored = rows.select(inside.alias("a"), outside.alias("b"))
    return scored.agg(F.avg(F.coalesce(value, F.lit(0.0))).alias("silhouette"))


def covariance(points: DataFrame) -> np.ndarray:
    """The sample covariance of ``z`` in units of one, from one aggregate of exact sums."""
    width = points.agg(F.max(F.size("z"))).first()[0] or 0
    z = [F.col("z")[i].cast(_SUM) for i in range(width)]
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    products = [F.sum((F.col("z")[i].cast("decimal(14,0)") * F.col("z")[j].cast("decimal(14,0)")).cast(_PRODUCT)) for i, j in pairs]
    found = points.agg(F.count(F.lit(1)), *map(F.sum, z), *products).first()
    n, sums = found[0], found[1 : 1 + width]
    made = np.zeros((width, width))
    for (i, j), product in zip(pairs, found[1 + width :], strict=True):
        exact = (n * int(product) - int(sums[i]) * int(sums[j])) if n > 1 else 0
        made[i, j] = made[j, i] = exact / (n * (n - 1) * UNIT**2) if n > 1 else 0.0
    return made


def principal(points: DataFrame, k: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` components (rows of loadings) and their shares of the variance.

    The sign is fixed: the loading of largest size, the first of them, is positive.
    """
    values, vectors = np.linalg.eigh(covariance(points))
    order = np.argsort(values)[::-1][:k]
    loadings = vectors[:, order].T
    for row in loadings:
        if row[np.argmax(np.abs(row) > np.abs(row).max() - 1e-9)] < 0:
            row *= -1
    total = values.sum()
    return loadings, values[order] / total if total else np.zeros(len(order))


def project(points: DataFrame, loadings: np.ndarray, names: Sequence[str]) -> DataFrame:
    """Add the scores of the components."""
    made = {}
    for name, row in zip(names, loadings.tolist(), strict=True):
        score = F.lit(0.0)
        for i, weight in enumerate(row):
            score = score + F.col("z")[i].cast("double") * F.lit(weight / UNIT)
        made[name] = score
    return points.withColumns(made)
