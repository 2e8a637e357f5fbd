"""Near copies of vectors: p-stable hashing proposes, exact cosines decide.

Vectors are normalised. In each of several tables a vector's bucket is floor((a . v + b) / width) for a few Gaussian
directions a. Buckets are compared in square blocks by matrix products in double precision; a pair that meets in
several tables counts in the first alone, so links can be counted without a list of pairs. A block returns for each
vector its number of links there, and links that join what it connects (fewer than vectors).

The number of directions grows with the logarithm of the rows, so that a bucket holds about MATES unlike vectors, and
the number of tables with it, so that a pair at the threshold is missed with probability MISS at most.

Equal vectors are one class, compared once: its members are all linked to each other.

A cosine within CLOSE of the threshold, where the order of summing could decide, is taken again from the components as they
are given: three sums without rounding on the way, two roots, a division.

Cases: vectors that are null, empty or zero, or hold null or non-finite components, and rows with a null id, link
with nothing; vectors of different lengths are not linked; an id that occurs more than once stands for its smallest
usable vector, and gives one row; a null id gives a row without component that is kept; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import stored
from tickloom.llm.components import components
from tickloom.llm.nearcopies import grouped, mixed
from tickloom.session import ship

ship(__name__)

COSINE = 0.9
MISS = 1e-3
#: Unlike vectors that a bucket holds on average; a block has as many rows.
MATES = BLOCK = 1024
#: Bucket width over the distance of two vectors at the threshold.
WIDTH = 4.0
SEED = 20240603
#: So near the threshold a matrix product's rounding may decide.
CLOSE = 1e-9

HASHED = "id long, weight long, keys array<long>, vector binary"
FOUND = "a long, b long, links long"


def meeting(ratio: float) -> float:
    """Probability that two vectors share one quantised projection, by bucket width over their distance."""
    tail = math.erfc(ratio / math.sqrt(2))
    return 1 - tail - math.sqrt(2 / math.pi) / ratio * (1 - math.exp(-(ratio**2) / 2))


def plan(n: int, cosine: float = COSINE) -> tuple[int, int, float]:
    """Directions a table, tables, and bucket width for n vectors."""
    near, far = math.sqrt(2 - 2 * cosine), math.sqrt(2)
    width = WIDTH * near
    directions = max(1, math.ceil(math.log(max(n / MATES, 1.001)) / -math.log(meeting(width / far))))
    tables = math.ceil(math.log(MISS) / math.log(1 - meeting(WIDTH) ** directions))
    return directions, tables, width


def units(given: np.ndarray) -> np.ndarray:
    x = given.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    """The cosine of two vectors from sums that are rounded once."""
    x, y = ((v * 2.0 ** -np.frexp(np.abs(v).max())[1]) for v in (a.astype(np.float64), b.astype(np.float64)))
    return math.fsum((x * y).tolist()) / (math.sqrt(math.fsum((x * x).tolist())) * math.sqrt(math.fsum((y * y).tolist())))


def hasher(directions: int, tables: int, width: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = mixed(np.random.default_rng(SEED).integers(0, 2**63, directions, np.uint64)) | np.uint64(1)
        for batch in batches:
            vectors = batch.column("embedding")
            lengths = pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths).tolist():
                rows = batch.filter(pa.array(lengths == dim))
                given = rows.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                x = units(given)
                rng = np.random.default_rng([SEED, dim])
                lines = rng.standard_normal((dim, tables * directions))
                shift = rng.uniform(0, width, tables * directions)
                cells = np.floor((x @ lines + shift) / width).astype(np.int64).view(np.uint64).reshape(-1, tables, directions)
                keys = mixed((cells * weight).sum(axis=2, dtype=np.uint64) + np.arange(tables, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(dim))
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": rows.column("vec_id").cast(pa.int64()),
                        "weight": rows.column("weight"),
                        "keys": pa.array(list(keys.view(np.int64)), pa.list_(pa.int64())),
                        "vector": pa.array([v.tobytes() for v in given], pa.binary()),
                    }
                )

    return hash_rows


def compare(cosine: float, kind: str = "f4") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links in one pair of blocks of a bucket; ``kind`` is the type of the vectors' components."""

    def block(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, weight, side = (rows[c].to_numpy() for c in ("id", "weight", "block"))
        table, i, j = (rows[c][0].as_py() for c in ("table", "i", "j"))
        vectors = rows["vector"].to_pylist()
        same = np.array([len(v) for v in vectors]) == len(vectors[0])  # lengths differ only if two buckets' keys collide
        keep = np.flatnonzero(same)
        given = np.frombuffer(b"".join(vectors[k] for k in keep), kind).reshape(len(keep), -1)
        x = units(given)
        keys = np.stack([np.asarray(k) for k in rows["keys"].to_numpy()])[keep]
        ids, weight, side = ids[keep], weight[keep], side[keep]
        left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
        cosines = x[left] @ x[right].T
        p, q = np.nonzero(cosines >= cosine - CLOSE)
        unsure = np.flatnonzero(cosines[p, q] < cosine + CLOSE)
        p, q = left[p], right[q]
        sure = np.ones(len(p), bool)
        sure[unsure] = [exact_cosine(given[a], given[b]) >= cosine for a, b in zip(p[unsure].tolist(), q[unsure].tolist(), strict=True)]
        p, q = p[sure], q[sure]
        good = p < q if i == j else np.ones(len(p), bool)
        p, q = p[good], q[good]
        if table:
            fresh = np.empty(len(p), bool)
            for s in range(0, len(p), 100_000):
                fresh[s : s + 100_000] = (keys[p[s : s + 100_000], :table] != keys[q[s : s + 100_000], :table]).all(axis=1)
            p, q = p[fresh], q[fresh]
        links = np.bincount(p, weight[q], len(ids)) + np.bincount(q, weight[p], len(ids))
        part = np.arange(len(ids))
        while True:  # smallest row that links reach in this block
            before = part.copy()
            low = np.minimum(part[p], part[q])
            np.minimum.at(part, p, low)
            np.minimum.at(part, q, low)
            part = part[part]
            if (part == before).all():
                break
        some = np.flatnonzero(links)
        return ids[some], ids[part[some]], links[some].astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, ["table", "key", "i", "j"]):
            a, b, links = block(rows)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b), "links": pa.array(links)})

    return run


def classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (vec_id, rep, weight) of classes of equal vectors, and their representatives (vec_id, weight, embedding)."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("embedding", lambda x: x != 0)
    one = vectors.filter(F.col("vec_id").isNotNull() & F.coalesce(usable, F.lit(False))).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    one = stored(one, "vectors")
    same = one.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
    members = stored(one.join(same, "embedding").select("vec_id", "rep", "weight"), "members")
    reps = one.join(members.filter("vec_id = rep").select("vec_id", "weight"), "vec_id")
    return members, reps


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row an id."""
    members, reps = classes(vectors)
    kind = "f8" if vectors.schema["embedding"].dataType.elementType == T.DoubleType() else "f4"
    n = members.filter("vec_id = rep").count()
    directions, tables, width = plan(n, cosine)
    hashed = stored(reps.mapInArrow(hasher(directions, tables, width), HASHED), "hashed")
    rows = hashed.select("id", F.posexplode("keys").alias("table", "key"))
    sizes = rows.groupBy("table", "key").agg(F.count("*").alias("size")).filter("size > 1")
    rows = rows.join(sizes, ["table", "key"])
    rows = rows.withColumn("blocks", F.ceil(F.col("size") / BLOCK))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("long"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other"), "table": F.col("table").cast("long")})
    rows = rows.select("id", "table", "key", "i", "j", "block").join(hashed, "id")
    shares = ["table", "key", "i", "j"]
    found = stored(rows.repartition(*shares).sortWithinPartitions(*shares).mapInArrow(compare(cosine, kind), FOUND), "found")

    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    parts = components(found.select("a", "b")).withColumnRenamed("id", "rep")
    out = members.join(links, "rep", "left").join(parts, "rep", "left").select(
        "vec_id",
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    every = vectors.select("vec_id").filter("vec_id is not null").distinct().unionByName(vectors.select("vec_id").filter("vec_id is null"))
    out = every.join(out, "vec_id", "left")
    out = out.withColumns({"n_links": F.coalesce("n_links", F.lit(0)).cast("long"), "component_id": F.coalesce("component_id", "vec_id")})
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
