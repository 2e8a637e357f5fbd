"""Clusters of integer vectors around centroids, found by equal-average equal-variance search.

A vector of k components x with sum S and k * sum(x * x) - S * S = W, and a centroid with S' and W', are at a squared
distance d with k * d >= (S - S')**2 + (sqrt(W) - sqrt(W'))**2. Centroids stand in order of their sums; a vector starts at
its own place among them and goes outward, nearer sum first. Once the first square is above k * best, nothing further out
can win; a centroid whose two squares are above it is skipped; what is left is measured. All is in integers, roots are
rounded towards a smaller bound, and only what is above the best is left out, so ties are found and go to the smaller number.

Cases: components x become floor(scale * x), x as double. Vectors that are null, have another number of components or
hold null or non-finite ones, and rows with a null id, are left out. Each row is a vector of its own, also where ids
repeat; of equal hashes the smaller vector is the earlier centroid. With fewer vectors than centroids all are centroids.
Components of any size are exact (beyond 2**24 in Python integers); distances beyond 64 bits are given as the largest one.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored
from tickloom.session import ship

ship(__name__)

SCALE, DIMENSIONS, CENTROIDS, ROUNDS = 64, 64, 16, 3
#: Components below this keep k * d within 62 bits for up to 1024 components.
SMALL = 2**24
#: Partial sums travel as limbs of this many bits, so that any sum fits Spark's decimals.
LIMB = 60
MOST = 2**63 - 1


def components(column: pa.Array, dimensions: int, scale: int) -> np.ndarray:
    """floor(scale * x) by row, as int64 or, if any is large, as Python integers."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)
    if not flat.size or np.abs(flat).max() * scale < SMALL:
        return np.floor(flat * scale).astype(np.int64)
    whole = [[int(v) * scale if abs(v) >= 2.0**53 else math.floor(v * scale) for v in row] for row in flat.tolist()]
    return np.array(whole, object).reshape(flat.shape)


def spread(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums, and roots of k * sum(x * x) - S * S, at most 1 off."""
    sums = x.sum(axis=1)
    rest = x.shape[1] * (x * x).sum(axis=1) - sums * sums
    if x.dtype == object:
        return sums, np.array([math.isqrt(v) for v in rest], object)
    return sums, np.sqrt(rest.astype(np.float64)).astype(np.int64)


@dataclass
class Search:
    """Centroids (rows of integers, by number) ready for vectors to be assigned to them."""

    centroids: list[list[int]]

    def __post_init__(self) -> None:
        large = any(abs(v) >= SMALL for c in self.centroids for v in c)
        points = np.array(self.centroids, object if large else np.int64)
        self.numbers = np.array(sorted(range(len(points)), key=lambda i: (sum(self.centroids[i]), i)))
        self.points = points[self.numbers]
        self.sums, self.roots = spread(self.points)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each row's nearest centroid and the squared distance."""
        points, sums, roots = self.points, self.sums, self.roots
        if x.dtype == object or points.dtype == object:
            x, points, sums, roots = (a.astype(object) for a in (x, points, sums, roots))
        n, k = x.shape
        own, root = spread(x)
        right = np.searchsorted(sums, own)
        left = right - 1
        best = np.zeros(n, x.dtype)
        chosen = np.full(n, -1)
        live = np.arange(n)
        for _ in range(len(points)):
            has_left, has_right = left[live] >= 0, right[live] < len(points)
            to_left = np.abs(own[live] - sums[np.maximum(left[live], 0)])
            to_right = np.abs(sums[np.minimum(right[live], len(points) - 1)] - own[live])
            go_left = has_left & (~has_right | (to_left <= to_right).astype(bool))
            at = np.where(go_left, left[live], right[live])
            apart = np.where(go_left, to_left, to_right)
            first = chosen[live] < 0
            near = first | (apart * apart <= k * best[live]).astype(bool)
            live, at, apart, first, go_left = live[near], at[near], apart[near], first[near], go_left[near]
            if not len(live):
                break
            left[live[go_left]] -= 1
            right[live[~go_left]] += 1
            wide = np.maximum(np.abs(root[live] - roots[at]) - 2, 0)
            hold = first | (apart * apart + wide * wide <= k * best[live]).astype(bool)
            rows, at, first = live[hold], at[hold], first[hold]
            gap = x[rows] - points[at]
            distance = (gap * gap).sum(axis=1)
            number = self.numbers[at]
            nearer = (distance < best[rows]).astype(bool) | ((distance == best[rows]).astype(bool) & (number < chosen[rows]))
            won = first | nearer
            best[rows[won]], chosen[rows[won]] = distance[won], number[won]
        return chosen, best


def partial_sums(search: Search, dimensions: int, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row for each centroid, component and limb of a batch: the sum of its vectors, and their number as component -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = components(batch.column("embedding"), dimensions, scale)
            if not len(x):
                continue
            chosen, _ = search.assign(x)
            out = []
            for number in np.unique(chosen).tolist():
                members = x[chosen == number]
                out.append((number, -1, 0, len(members)))
                for place, total in enumerate(members.sum(axis=0).tolist()):
                    limb = 0
                    while not -(2**LIMB) < total < 2**LIMB:
                        total, low = divmod(total, 2**LIMB)
                        out.append((number, place, limb, low))
                        limb += 1
                    out.append((number, place, limb, total))
            names = ("cluster", "place", "limb", "part")
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return run


def assigned(search: Search, dimensions: int, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen, best = search.assign(components(batch.column("embedding"), dimensions, scale))
            distance = pa.array([min(v, MOST) for v in best.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(chosen, pa.int32()), distance], ["vec_id", "cluster", "distance"])

    return run


def usable(vectors: DataFrame, dimensions: int) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = F.col("vec_id").isNotNull() & (F.size("embedding") == dimensions) & finite
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(F.coalesce(good, F.lit(False)))


def first_centroids(kept: DataFrame, number: int, scale: int) -> list[list[int]]:
    """The vectors with the smallest hashes of their ids: ``number`` rows, whatever the table's size."""
    chance = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(chance, "embedding").limit(number).collect()
    if not rows:
        return []
    return components(pa.array([list(r.embedding) for r in rows], pa.list_(pa.float64())), len(rows[0].embedding), scale).tolist()


def moved(kept: DataFrame, centroids: list[list[int]], scale: int) -> list[list[int]]:
    """Centroids at the floor of their vectors' means; one without vectors stays. What comes to the driver is one row
    for each centroid, component and limb."""
    dimensions = len(centroids[0])
    sums = kept.select("embedding").mapInArrow(
        partial_sums(Search(centroids), dimensions, scale), "cluster int, place int, limb int, part long"
    )
    found: dict[tuple[int, int], int] = {}
    for r in sums.groupBy("cluster", "place", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part")).collect():
        key = (r.cluster, r.place)
        found[key] = found.get(key, 0) + (int(r.part) << (LIMB * r.limb))
    return [
        [found[(i, p)] // found[(i, -1)] for p in range(dimensions)] if (i, -1) in found else old
        for i, old in enumerate(centroids)
    ]


def cluster(
    vectors: DataFrame, number: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE
) -> tuple[DataFrame, list[list[int]]]:
    """((vec_id, cluster, distance) of every usable vector, the final centroids).

    A round is one pass without a shuffle of vectors: tasks return partial sums of their batches only.
    """
    kept = stored(usable(vectors, dimensions), "vectors")
    centroids = first_centroids(kept, number, scale)
    if not centroids:
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        centroids = moved(kept, centroids, scale)
    return kept.mapInArrow(assigned(Search(centroids), dimensions, scale), "vec_id long, cluster int, distance long"), centroids


def with_inertia(found: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Adds the summed distance of a vector's cluster and of all, and the digest of its centroid."""
    found = stored(found, "clusters")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = dict(found.groupBy("cluster").agg(total.alias("s")).collect())  # one row for each centroid
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    rows = [(i, min(int(sums.get(i, 0)), MOST), min(int(sum(sums.values())), MOST), d) for i, d in enumerate(digests)]
    facts = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
