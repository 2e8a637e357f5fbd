from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import search

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k):
    whole = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [float(np.float32(x)) for x in v]
        whole[i] = min(whole.get(i, v), v)
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in whole.items()}
    out = []
    for q in sorted(whole):
        if q % 100 == 0:
            scores = {i: sum(a * b for a, b in zip(whole[q], v, strict=True)) for i, v in whole.items() if i != q and len(v) == len(whole[q])}
            found = [(-max(-(2**63), min(2**63 - 1, s)), i) for i, s in scores.items()]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return out


def found(spark, rows, k=10, **sizes):
    df = search.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, k, **sizes)
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("sizes", [{}, {"query_tile": 2, "shard_rows": 7}, {"query_tile": 1, "shard_rows": 3}])
def test_equals_plain_search(spark, sizes):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
    rows += [(1000 + i, [0.5] * 8) for i in range(60)] + [(1100, [0.5] * 8), (1100, [0.5] * 8), (1200, [1.0] * 8), (1200, [0.0] * 8)]
    rows += [(1300, None), (1400, [float("nan")] * 8), (1401, [None] * 8), (None, [1.0] * 8), (1500, [float("inf")] * 8), (1600, [1.0, 2.0]), (1601, [3.0, 4.0]), (1700, [])]
    assert found(spark, rows, **sizes) == plain(rows, 10)


def test_huge_components_stay_exact(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, 2.0]), (2, [-1e30, 3.0]), (100, [3e6, 3e6]), (101, [4e6, 1.0]), (102, [4e6, 1.0])]
    assert found(spark, rows) == plain(rows, 10)


def test_fewer_than_k_and_empty(spark):
    assert found(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 2048 * 1024)]
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, []) == []


def test_clashing_columns(spark):
    rows = [(0, [1.0], 1, 2, True), (1, [2.0], 1, 2, True)]
    df = spark.createDataFrame(rows, SCHEMA + ", shard int, rank int, is_query boolean")
    assert [tuple(r) for r in search.top_k(df, F.col("vec_id") % 100 == 0).collect()] == [(0, 1, 1, 2048 * 1024)]
