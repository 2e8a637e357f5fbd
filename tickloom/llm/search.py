"""Exact top-k search by inner product: tiles of queries times shards of candidates, top lists merged as a tree.

Components x become floor(1024 * x), computed in double precision; scores are integer inner products.

Cases: vectors that are null or hold null or non-finite components, and rows with a null id, take no part; an id that
occurs more than once stands for its smallest vector; vectors of different lengths are not compared; ties go to the
smaller id; scores beyond 64 bits count as the nearest 64-bit value; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import stored
from tickloom.session import ship

ship(__name__)

#: Rows of a query tile and of a candidate shard on average; a task holds one of each.
QUERY_TILE, SHARD = 2048, 8192
#: Queries of one matrix product, so that its scores stay near 16 MB.
PRODUCT_ROWS = 256
#: Top lists merged at once.
FAN_IN = 16
SCALE = 1024
LIST = "query_id long, shard long, vec_id long, score long"


def whole_vectors(rows: DataFrame) -> DataFrame:
    """One row (vec_id, embedding) per id, without unusable vectors."""
    good = F.col("vec_id").isNotNull() & F.coalesce(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False)
    )
    return rows.filter(good).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def whole_numbers(column: pa.Array) -> np.ndarray:
    """floor(1024 x) as doubles, which hold them exactly up to 2**53; larger ones as Python integers."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = np.floor(flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE).reshape(len(flat), -1)
    return x if not x.size or np.abs(x).max() < 2.0**53 else np.array([[int(v) for v in r] for r in x.tolist()], object)


def best_of(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's k highest finite scores, ties to the left."""
    width = scores.shape[1]
    if width > k:
        kth = np.partition(scores, width - k, axis=1)[:, width - k]
        above = scores > kth[:, None]
        level = scores == kth[:, None]
        room = k - above.sum(axis=1)
        chosen = above | (level & (np.cumsum(level, axis=1) <= room[:, None]))
    else:
        chosen = np.ones(scores.shape, bool)
    rows, cols = np.nonzero(chosen)
    real = scores[rows, cols] > -np.inf
    return rows[real], cols[real]


def tile_search(k: int) -> Callable[[pa.Table], pa.Table]:
    def search(group: pa.Table) -> pa.Table:
        asks = group.filter(group["asks"])
        shard = group.filter(pa.compute.invert(group["asks"])).sort_by("vec_id")
        out: list[list[np.ndarray]] = [[], [], []]
        if len(asks) and len(shard):
            q, c = whole_numbers(asks["embedding"]), whole_numbers(shard["embedding"])
            q_ids, c_ids = asks["vec_id"].to_numpy(), shard["vec_id"].to_numpy()
            exact = object not in (q.dtype, c.dtype) and (
                not q.size or np.abs(q).max() * np.abs(c).max() * q.shape[1] < 2.0**53
            )
            if not exact:
                q, c = (np.array([[int(v) for v in r] for r in m.tolist()], object).reshape(m.shape) for m in (q, c))
            for i in range(0, len(q), PRODUCT_ROWS):
                scores = q[i : i + PRODUCT_ROWS] @ c.T
                if not exact:
                    scores = np.clip(scores, -(2**63), 2**63 - 1)
                scores[q_ids[i : i + PRODUCT_ROWS, None] == c_ids[None]] = -np.inf
                rows, cols = best_of(scores, k)
                out[0].append(q_ids[i + rows])
                out[1].append(c_ids[cols])
                out[2].append(scores[rows, cols].astype(np.int64))
        ids, found, values = (np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in out)
        number = group["shard"][0].as_py() if len(group) else 0
        return pa.table({"query_id": ids, "shard": np.full(len(ids), number, np.int64), "vec_id": found, "score": values})

    return search


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, query_tile: int = QUERY_TILE, shard_rows: int = SHARD
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` marks, its k best other rows.

    Each row goes to one shard, each query to one tile, and every tile meets every shard in a task of its own, so a
    task's memory is bounded whatever the table's size or the vectors' likeness. A task returns at most k rows a query.
    """
    whole = stored(whole_vectors(vectors).withColumn("is_query", is_query), "vectors")
    counts = whole.groupBy(F.size("embedding").alias("dim")).agg(
        F.count("*").alias("n"), F.count_if("is_query").alias("asked")
    )
    # One row per vector length; lengths are a property of the embedding model, not of the number of rows.
    most = counts.agg(F.max("n"), F.max("asked")).first()
    shards, tiles = (max(1, -(-(x or 0) // y)) for x, y in zip(most, (shard_rows, query_tile), strict=True))
    dealt = whole.withColumns(
        {
            "dim": F.size("embedding"),
            "shard": F.pmod(F.xxhash64("vec_id"), F.lit(shards)),
            "tile": F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(tiles)),
        }
    )
    def everywhere(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    columns = ["dim", "tile", "shard", "vec_id", "embedding", "asks"]
    asks = dealt.filter("is_query").withColumns({"shard": everywhere(shards), "asks": F.lit(True)}).select(columns)
    held = dealt.withColumns({"tile": everywhere(tiles), "asks": F.lit(False)}).select(columns)
    top = asks.union(held).groupBy("dim", "tile", "shard").applyInArrow(tile_search(k), LIST)
    width = shards
    while True:
        width = -(-width // FAN_IN)
        best = Window.partitionBy("query_id", "shard").orderBy(F.desc("score"), "vec_id")
        top = (
            top.withColumn("shard", F.floor(F.col("shard") / FAN_IN))
            .withColumn("rank", F.row_number().over(best))
            .filter(F.col("rank") <= k)
        )
        if width == 1:
            return top.select("query_id", "rank", "vec_id", "score")
