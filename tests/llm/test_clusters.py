from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tickloom.llm import centroids

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, dims, number=16, rounds=3, scale=64):
    kept = [
        (i, [int(x) * scale if abs(x) >= 2**53 else math.floor(x * scale) for x in v])
        for i, v in rows
        if i is not None and v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    at = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:number]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(at))

    for _ in range(rounds):
        groups = [[] for _ in at]
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        at = [[sum(c) // len(g) for c in zip(*g, strict=True)] if g else old for g, old in zip(groups, at, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    most = 2**63 - 1
    cut = [(i, c, min(d, most)) for i, d, c in found]
    by = {c: min(sum(d for _, b, d in cut if b == c), most) for c in range(len(at))}
    total = min(sum(d for _, _, d in cut), most)
    return sorted((i, c, d, by[c], total, hashlib.sha256(",".join(map(str, at[c])).encode()).hexdigest()) for i, c, d in cut)


def found(spark, rows, dims, schema=SCHEMA, **kw):
    result = centroids.cluster(spark.createDataFrame(rows, schema), dimensions=dims, **kw)
    return sorted(tuple(r) for r in centroids.with_inertia(*result).collect())


@pytest.mark.parametrize("dims", [1, 3, 64])
def test_equals_plain_clusters(spark, dims):
    rng = np.random.default_rng(dims)
    rows = [(i, rng.normal(size=dims).round(2).tolist()) for i in range(500)]
    rows += [(600 + i, [0.25] * dims) for i in range(40)] + [(5, [0.5] * dims), (5, [0.5] * dims)]
    rows += [(900, None), (901, [None] * dims), (902, [float("nan")] * dims), (None, [0.1] * dims), (903, [1.0] * (dims + 1)), (904, []), (905, [float("-inf")] * dims)]
    assert found(spark, rows, dims) == plain(rows, dims)


def test_ties_go_to_the_smaller_number_and_empty_centroids_stay(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(40)]
    assert found(spark, rows, 2, number=6) == plain(rows, 2, number=6)


def test_huge_components_stay_exact(spark):
    rows = [(i, [(-1.0) ** i * 10.0**p, float(i)]) for i, p in enumerate([0, 4, 5, 6, 7, 12, 20, 30, 38, 300] * 3)]
    assert found(spark, rows, 2, number=4) == plain(rows, 2, number=4)


def test_fewer_vectors_than_centroids_empty_and_clashing_columns(spark):
    rows = [(1, [0.5, 0.25]), (2, [1.0, -1.0])]
    assert found(spark, rows, 2) == plain(rows, 2)
    assert found(spark, [], 2) == []
    wide = [(i, v, 7, "x", 1.0) for i, v in rows]
    assert found(spark, wide, 2, SCHEMA + ", cluster int, centroid_sha256 string, distance double") == plain(rows, 2)


def test_search_skips_but_never_the_nearest():
    rng = np.random.default_rng(9)
    points = rng.integers(-40, 40, (300, 5))
    search = centroids.Search(points.tolist())
    x = rng.integers(-60, 60, (2000, 5))
    chosen, best = search.assign(x)
    full = ((x[:, None] - points[None]) ** 2).sum(axis=2)
    assert (best == full.min(axis=1)).all()
    assert (chosen == full.argmin(axis=1)).all()
