"""Sequences of neighbouring documents: sort by a space-filling curve through document vectors, then pack along it.

Each document's ids are counted in a vector of hashed ids, normalised, and projected to a few dimensions by a fixed
matrix; the place on the Hilbert curve through that space, then the id, is the order. Packing fills sequences to the
last token, cutting documents at their ends. The tokens that don't fill a last sequence become sequences whose lengths
are falling powers of two, so nothing is padded.

Cases: a null text is empty; every document has its end id, so none vanishes; a null ``doc_id`` sorts first; repeated
rows are documents of their own; a very long text runs over many sequences; other columns are ignored; an empty table
gives no sequences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored, text_slices
from tickloom.llm.tokens import tokenizer_json, worker_encoder
from tickloom.session import ship

ship(__name__)

SEQUENCE = 2048
END_ID = 1
#: Hashed ids of a document vector, dimensions and bits a dimension of the curve.
BINS, DIMENSIONS, BITS = 256, 4, 8
SEED = 20240601

ENCODED = "doc_id long, n_tokens long, curve long, ids binary"
ORDERED = "doc_id long, n_tokens long, shard int, before long, ids binary"
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of points with integer coordinates below 2**bits, one row each (Skilling's transform)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def curve_places(documents: list[np.ndarray]) -> np.ndarray:
    """Hilbert keys of documents given as arrays of ids."""
    rng = np.random.default_rng(SEED)
    plane = np.linalg.qr(rng.standard_normal((BINS, DIMENSIONS)))[0]
    lengths = np.array([len(d) for d in documents], np.int64)
    flat = np.concatenate(documents).astype(np.uint32)
    # The bin and sign of each id, looked up for ids from 0 to the largest.
    mixed = np.arange(int(flat.max(initial=0)) + 1, dtype=np.uint32) * np.uint32(2654435761)
    sign, bin_of = 1.0 - 2.0 * ((mixed >> np.uint32(15)) & np.uint32(1)), (mixed >> np.uint32(24)).astype(np.int64)
    cells = np.repeat(np.arange(len(documents)) * BINS, lengths)
    cells += bin_of[flat]
    vectors = np.bincount(cells, sign[flat], len(documents) * BINS).reshape(-1, BINS)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    spread = np.tanh(vectors @ plane * np.sqrt(BINS) / 2) / 2 + 0.5
    return hilbert_key(np.minimum((spread * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))


def encoder(shared: Broadcast, end: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        words, press = worker_encoder(shared.value), zstandard.ZstdCompressor(level=1)
        for batch in text_slices(batches):
            raw = words.encode(batch.column("text").to_pylist(), end)
            ids = [np.frombuffer(x, "<u4") for x in raw]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                    "curve": pa.array(curve_places(ids), pa.int64()),
                    "ids": pa.array([press.compress(x) for x in raw], pa.binary()),
                }
            )

    return encode


def add_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shard of an ordered row, and the tokens before it in the shard."""
    shard, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column("n_tokens").to_numpy()
        ends = before + np.cumsum(n)
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "n_tokens": batch.column("n_tokens"),
                "shard": pa.array(np.full(len(n), shard, np.int32)),
                "before": pa.array(ends - n),
                "ids": batch.column("ids"),
            }
        )
        before = int(ends[-1]) if len(n) else before


def sequence_ends(total: int, most: int) -> list[int]:
    """Ends of the sequences after the last full one: falling powers of two that add up to the rest."""
    ends, at = [], total - total % most
    for bit in range(most.bit_length() - 1, -1, -1):
        if (total % most) >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return ends


def cutter(starts: dict[int, int], total: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    full = total - total % most
    short = sequence_ends(total, most)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for lines in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                out = []
                for r in lines.to_pylist():
                    ids, n = press.decompress(r["ids"]), r["n_tokens"]
                    first = starts[r["shard"]] + r["before"]
                    at = first
                    while at < first + n:
                        if at < full:
                            number, begin = divmod(at, most)
                            begin, stop = at - begin, at - begin + most
                        else:
                            k = next(k for k, e in enumerate(short) if e > at)
                            number, stop = full // most + k, short[k]
                            begin = short[k - 1] if k else full
                        stop = min(stop, first + n)
                        out.append((r["doc_id"], at - first, stop - at, n, number, at - begin, ids[4 * (at - first) : 4 * (stop - first)]))
                        at = stop
                columns = list(zip(*out, strict=True)) or [()] * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.binary())],
                    names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )

    return cut


def pack(docs: DataFrame, most: int = SEQUENCE, tokenizer_path: str | None = None, end: int = END_ID, shards: int | None = None) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) of all documents; ``most`` is a power of two.

    ``ids`` are little-endian unsigned 32-bit. Documents are encoded once, moved once into curve order and cut there;
    the driver sees one sum a partition.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(tokenizer_json(tokenizer_path))
    encoded = stored(docs.select("doc_id", "text").mapInArrow(encoder(shared, end), ENCODED), "encoded")
    order = ["curve", "doc_id", "tie"]
    ordered = encoded.withColumn("tie", F.xxhash64("ids")).repartitionByRange(shards, *order).sortWithinPartitions(*order)
    placed = stored(ordered.drop("tie", "curve").mapInArrow(add_places, ORDERED), "ordered", "none")
    sums = placed.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()
    starts, total = {}, 0
    for r in sorted(sums):
        starts[r.shard], total = total, total + r.n
    return placed.mapInArrow(cutter(starts, total, most), PIECES)
