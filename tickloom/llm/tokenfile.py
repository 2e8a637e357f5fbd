"""Token files: each document's ids as a frame of its own, compressed with one dictionary shared by all.

A file is a Parquet table of blocks. A block holds consecutive documents in id order:

    shard, block      which part of the order the block is, and which of the part
    before            ids in the shard's earlier blocks
    first, last       smallest and largest doc_id, so that a lookup skips other blocks
    doc_ids, n_tokens the documents
    offsets           where each frame starts in ``frames``, and the end of the last
    dict_hash         SHA-256 of the dictionary the frames need
    frames            zstandard frames, one a document, of little-endian unsigned 32-bit ids

Beside it lie the dictionary and one row a shard with the ids of all shards before it.

Cases: a null text is empty and, as every document, ends with the end id; a null ``doc_id`` sorts first; repeated
rows are documents of their own, ordered by a hash of their text; a very long text is a block of its own; other
columns are ignored; an empty table gives a file without blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import text_slices
from tickloom.llm.tokens import tokenizer_json, worker_encoder
from tickloom.session import ship

ship(__name__)

#: The dictionary is trained on the starts of so many documents (those with the lowest hash of their id), so many
#: characters of each. It changes sizes only: any dictionary gives the ids back.
SAMPLE_DOCUMENTS, SAMPLE_CHARS = 1000, 8000
DICTIONARY_BYTES = 64 * 1024
#: A block closes at so many bytes of ids, or documents.
BLOCK_BYTES, BLOCK_DOCUMENTS = 4_000_000, 1024
LEVEL = 3
END_ID = 0

BLOCKS = (
    "shard int, block int, before long, first long, last long, doc_ids array<long>, n_tokens array<long>, "
    "offsets array<long>, dict_hash string, frames binary"
)
DOCUMENTS = "doc_id long, start long, n_tokens long, ids binary"


def train_dictionary(docs: DataFrame, tokenizer: str) -> bytes:
    """A dictionary from a bounded sample; empty if the sample is too small for one."""
    import zstandard

    marked = docs.withColumn("h", F.xxhash64("doc_id"))
    last = marked.select("h").orderBy("h").limit(SAMPLE_DOCUMENTS).agg(F.max("h")).first()[0]
    low = marked.filter(F.col("h") <= F.lit(last)).select(F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    sample = sorted(low.limit(2 * SAMPLE_DOCUMENTS).collect(), key=lambda r: r.text or "")
    try:
        ids = worker_encoder(tokenizer).encode([r.text for r in sample], END_ID)
        return zstandard.train_dictionary(DICTIONARY_BYTES, ids).as_bytes()
    except zstandard.ZstdError:
        return b""


def compressor(dictionary: bytes):
    import zstandard

    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def decompressor(dictionary: bytes):
    import zstandard

    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def block_writer(shared: Broadcast, end: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents of one shard, in order, to blocks."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, dictionary, schema = shared.value
        encoder, press = worker_encoder(tokenizer), compressor(dictionary)
        name = hashlib.sha256(dictionary).hexdigest()
        shard, number, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[int | None, int, bytes]] = []
        size = 0

        def block() -> pa.RecordBatch:
            ids = [x[0] for x in held]
            known = [x for x in ids if x is not None]
            row = {
                "shard": shard, "block": number, "before": before, "first": min(known, default=None), "last": max(known, default=None),
                "doc_ids": ids, "n_tokens": [x[1] for x in held], "offsets": np.cumsum([0, *(len(x[2]) for x in held)]).tolist(),
                "dict_hash": name, "frames": b"".join(x[2] for x in held),
            }
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in text_slices(batches):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text").to_pylist(), end), strict=True):
                held.append((doc_id, len(ids) // 4, press.compress(ids)))
                size += len(ids)
                if size >= BLOCK_BYTES or len(held) >= BLOCK_DOCUMENTS:
                    yield block()
                    number, before = number + 1, before + sum(x[1] for x in held)
                    held, size = [], 0
        if held:
            yield block()

    return write


BLOCK_SCHEMA = pa.schema(
    [
        ("shard", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("first", pa.int64()), ("last", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())),
        ("dict_hash", pa.string()), ("frames", pa.binary()),
    ]
)


def write_tokens(docs: DataFrame, path: str, shards: int | None = None, tokenizer_path: str | None = None, end: int = END_ID) -> None:
    """Encode ``docs`` (doc_id, text) and write the token file at ``path``, in ascending doc_id order."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tokenizer = tokenizer_json(tokenizer_path)
    dictionary = train_dictionary(docs, tokenizer)
    spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary))], "dict_hash string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    ordered = docs.withColumn("tie", F.xxhash64("text")).repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    shared = spark.sparkContext.broadcast((tokenizer, dictionary, BLOCK_SCHEMA))
    ordered.mapInArrow(block_writer(shared, end), BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    counts = blocks.groupBy("shard").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    # One row a shard: as many as the writer had partitions.
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")).coalesce(1).write.parquet(f"{path}/index")


def reader(dictionary: bytes, only: frozenset[int] | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    name = hashlib.sha256(dictionary).hexdigest()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = decompressor(dictionary)
        for row in (r for b in batches for r in b.to_pylist()):
            if row["dict_hash"] != name:
                raise ValueError(f"block {row['shard']}.{row['block']} needs the dictionary {row['dict_hash']}")
            starts = row["start"] + row["before"] + np.cumsum([0, *row["n_tokens"]])
            wanted = [i for i, d in enumerate(row["doc_ids"]) if only is None or d in only]
            frames, offsets = memoryview(row["frames"]), row["offsets"]
            ids = [press.decompress(frames[offsets[i] : offsets[i + 1]]) for i in wanted]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([row["doc_ids"][i] for i in wanted], pa.int64()),
                    "start": pa.array(starts[wanted] if wanted else [], pa.int64()),
                    "n_tokens": pa.array([row["n_tokens"][i] for i in wanted], pa.int64()),
                    "ids": pa.array(ids, pa.binary()),
                }
            )

    return read


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the file at ``path``; with ``doc_ids``, only their blocks and frames are read."""
    found = spark.read.parquet(f"{path}/dictionary").first()
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    if doc_ids is not None:
        near = F.lit(False)
        for d in doc_ids:
            near |= (F.col("first") <= d) & (F.col("last") >= d)
        blocks = blocks.filter(near)
    starts = spark.read.parquet(f"{path}/index")
    only = None if doc_ids is None else frozenset(doc_ids)
    return blocks.join(F.broadcast(starts), "shard").mapInArrow(reader(bytes(found.dictionary), only), DOCUMENTS)
