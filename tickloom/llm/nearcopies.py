"""Near copies of texts: MinHash bands propose, odd sketches estimate, full shingle sets decide.

Words are what lies between ASCII white space in the text with A-Z lower-cased; a text's set holds its distinct
shingles of five words, or all its words as one if they are fewer, as 64-bit hashes. Two texts are linked if
100 * common >= 75 * all of their sets.

1. Each text gives the size and a 128-bit digest of its set, MinHash band keys and an odd sketch: the samples (number,
   minimum) fold into a bitmap where each flips one bit, so common samples cancel in the XOR of two sketches and the
   population count of the rest estimates the similarity.
2. Texts of equal digest are one class, stood for by its smallest id. Only these go on.
3. In each band bucket all members are paired with the smallest; sketches drop the hopeless, full sets decide.
4. Buckets whose members are not all connected by now are compared again, in square blocks that hold their members'
   sketches and full sets: every pair still apart that its sketches allow, likeliest first, is decided in the block,
   which returns only links that connect something. So no pair is left out, and no list of pairs is made.

Cases: texts that are null, empty or without words have an empty set and no links; a null ``doc_id`` has none either,
a null component and is kept; rows that repeat a ``doc_id`` are one document, with the smallest (size, digest) of
them; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import give_back, stored, text_slices, with_ids
from tickloom.llm.components import components
from tickloom.session import ship

ship(__name__)

WORDS = 5
PERCENT = 75
#: A link of exactly the least similarity is missed by all bands with probability (1 - 0.75**4)**32, 5 in a million.
BANDS, ROWS = 32, 4
#: Samples and bits of a sketch. The estimate's deviation near the threshold is about 0.03; pairs are dropped only
#: SLACK below it, four deviations.
SAMPLES, SKETCH_BITS, SLACK = 256, 1024, 0.13
#: Members of a block of a bucket; two meet in a task.
BLOCK = 512
SEED = 20240602
#: Bytes of a long text whose words are found at once.
PIECE = 1_000_000
#: Bytes of text whose sets are made at once.
SLICE = 1_000_000
SPACE = re.compile(rb"[\x20\x09-\x0d]")

SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sketch binary"
SETS = "id long, n long, d1 long, d2 long, shingles binary"
PAIRS = "a long, b long"


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, salt: int) -> np.ndarray:
    rng = np.random.default_rng(SEED + salt)
    return rng.integers(0, 2**64, n, np.uint64, endpoint=False) | np.uint64(1)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 2**64)


def word_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts one after the other, and where each text's words begin, the end included."""
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    code = odd_numbers(256, 0)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(code[data] * powers(BASE, len(data)), out=sums[1:])
    words = mixed((sums[ends] - sums[starts]) * powers(INVERSE, len(data))[starts] + (ends - starts).astype(np.uint64))
    return words, np.searchsorted(starts, np.cumsum([0, *(len(r) + 1 for r in raw)]))


def pieces(raw: bytes) -> Iterator[bytes]:
    """A text cut at white space, so that only hashes of a very long one are held at once."""
    at = 0
    while at < len(raw):
        found = SPACE.search(raw, at + PIECE)
        end = found.start() if found else len(raw)
        yield raw[at:end]
        at = end


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    raw = [(t or "").encode("utf-8", "replace").lower() for t in texts]
    if len(raw) == 1:
        words = np.concatenate([np.empty(0, np.uint64), *(word_hashes([p])[0] for p in pieces(raw[0]))])
        firsts = np.array([0, len(words)])
    else:
        words, firsts = word_hashes(raw)
    weight = odd_numbers(WORDS, 1)
    n = max(0, len(words) - WORDS + 1)
    rolling = np.zeros(n, np.uint64)
    for k in range(WORDS):
        rolling += words[k : k + n] * weight[k]
    rolling = mixed(rolling)
    out = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        if b - a >= WORDS:
            out.append(np.unique(rolling[a : b - WORDS + 1]))
        elif b > a:
            out.append(mixed((words[a:b] * weight[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def minima(shingles: np.ndarray, times: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """The MinHash samples of a set."""
    out = np.full(len(times), 2**64 - 1, np.uint64)
    for i in range(0, len(shingles), 2048):
        part = (shingles[i : i + 2048, None] ^ salts[None]) * times[None]
        part ^= part >> np.uint64(32)
        np.minimum(out, (part * times[None]).min(axis=0), out=out)
    return out


def sketches(samples: np.ndarray) -> np.ndarray:
    """Odd sketches of rows of samples, as rows of bytes."""
    place = mixed(samples + np.arange(samples.shape[1], dtype=np.uint64) * np.uint64(BASE)) % np.uint64(SKETCH_BITS)
    cells = np.arange(len(samples))[:, None] * SKETCH_BITS + place.astype(np.int64)
    counts = np.bincount(cells.ravel(), minlength=len(samples) * SKETCH_BITS)
    return np.packbits((counts & 1).astype(np.uint8).reshape(-1, SKETCH_BITS), axis=1)


def similarity(differing: np.ndarray) -> np.ndarray:
    """Estimated similarity of two sets whose sketches differ in so many bits."""
    share = np.minimum(2.0 * differing / SKETCH_BITS, 1 - 1e-9)
    return 1 + SKETCH_BITS / (4 * SAMPLES) * np.log(1 - share)


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, digest, band keys and sketch of each text's set."""
    times, salts = odd_numbers(SAMPLES, 2), odd_numbers(SAMPLES, 3)
    weight = odd_numbers(ROWS, 4)
    for batch in text_slices(batches, most=SLICE):
        sets = shingle_sets(batch.column("text").to_pylist())
        samples = np.stack([minima(s, times, salts) for s in sets])
        rows = samples[:, : BANDS * ROWS].reshape(len(sets), BANDS, ROWS)
        keys = mixed((rows * weight).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * np.uint64(BASE))
        d1, d2 = digests(sets)
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id").cast(pa.int64()),
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "d1": d1,
                "d2": d2,
                "bands": pa.array(list(keys.view(np.int64)), pa.list_(pa.int64())),
                "sketch": pa.array([x.tobytes() for x in sketches(samples)], pa.binary()),
            }
        )


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, most=SLICE):
        sets = shingle_sets(batch.column("text").to_pylist())
        d1, d2 = digests(sets)
        yield pa.RecordBatch.from_pydict(
            {
                "id": batch.column("doc_id").cast(pa.int64()),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "d1": d1,
                "d2": d2,
                "shingles": pa.array([s.tobytes() for s in sets], pa.binary()),
            }
        )


def digests(sets: list[np.ndarray]) -> list[pa.Array]:
    """Two 64-bit digests of each set."""
    sums = ([mixed(s ^ np.uint64(salt)).sum(dtype=np.uint64) for s in sets] for salt in (11, 22))
    return [pa.array(np.array(x, np.uint64).view(np.int64)) for x in sums]


def sets_of(texts: DataFrame, wanted: DataFrame, repeated: bool) -> DataFrame:
    """(id, shingles) of the wanted documents: of rows with one id, of the one that ``signatures`` chose."""
    made = with_ids(texts, wanted).mapInArrow(full_sets, SETS)
    chosen = F.min_by("shingles", F.struct("n", "d1", "d2")).alias("shingles")
    return stored(made.groupBy("id").agg(chosen) if repeated else made.select("id", "shingles"), "sets")


def bits(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, SKETCH_BITS // 64)


def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that sizes and sketches allow to be linked."""
    for batch in batches:
        differing = np.bitwise_count(bits(batch.column("sa")) ^ bits(batch.column("sb"))).sum(axis=1)
        na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
        good = (similarity(differing) >= PERCENT / 100 - SLACK) & (100 * np.minimum(na, nb) >= PERCENT * np.maximum(na, nb))
        yield batch.select(["a", "b"]).filter(pa.array(good))


def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets are similar enough."""
    for batch in batches:
        good = []
        for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
            a, b = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
            common = len(np.intersect1d(a, b, assume_unique=True))
            good.append(100 * common >= PERCENT * (len(a) + len(b) - common))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


class Block:
    """Members of one block pair of a bucket, and which of them may be linked though they are apart."""

    def __init__(self, rows: pa.Table):
        self.ids, self.n, self.band = (rows[c].to_numpy() for c in ("id", "n", "band"))
        self.label = np.unique(rows["component"].to_numpy(), return_inverse=True)[1]
        self.sketch = bits(rows["sketch"])
        self.bands = np.stack([np.asarray(x) for x in rows["bands"].to_numpy()])
        side = rows["block"].to_numpy()
        i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
        self.left, self.right, self.same = np.flatnonzero(side == i), np.flatnonzero(side == j), i == j

    def candidates(self, at: int) -> np.ndarray:
        """Members that row ``at`` may be linked to, likeliest first; a pair is left to the first band it shares."""
        n, band = self.n, self.band[at]
        other = self.right[(self.ids[self.right] > self.ids[at]) if self.same else slice(None)]
        sizes = 100 * np.minimum(n[other], n[at]) >= PERCENT * np.maximum(n[other], n[at])
        other = other[(self.label[other] != self.label[at]) & sizes]
        if not len(other):
            return other
        about = similarity(np.bitwise_count(self.sketch[other] ^ self.sketch[at]).sum(axis=1))
        good = about >= PERCENT / 100 - SLACK
        good[good] = (self.bands[other[good], :band] != self.bands[at, :band]).all(axis=1)
        return other[good][np.argsort(-about[good], kind="stable")]


def undecided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of block pairs that take part in a pair which only full sets can decide."""
    for rows in grouped(batches, ["key", "i", "j"]):
        block, needed = Block(rows), np.zeros(len(rows), bool)
        for at in block.left.tolist():
            other = block.candidates(at)
            needed[other] = True
            needed[at] |= len(other) > 0
        yield from rows.filter(pa.array(needed)).combine_chunks().to_batches()


def apart(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Links between members of one block pair that are not connected yet: enough to connect all that belong together.

    Members that a link found here connects need no further pairs.
    """
    block, sets = Block(rows), [np.frombuffer(x.as_buffer(), np.uint64) for x in rows["shingles"]]
    label, links = block.label, []
    for at in block.left.tolist():
        other = block.candidates(at)
        while len(other):
            some, other = other[:64], other[64:]
            sizes = [len(sets[k]) for k in some.tolist()]
            flat = np.concatenate([sets[k] for k in some.tolist()])
            place = np.minimum(np.searchsorted(sets[at], flat), len(sets[at]) - 1)
            common = np.add.reduceat((sets[at][place] == flat).astype(np.int64), np.cumsum([0, *sizes[:-1]]))
            for k in some[100 * common >= PERCENT * (len(sets[at]) + np.array(sizes) - common)].tolist():
                if label[k] != label[at]:
                    links.append((at, k))
                    label[label == label[k]] = label[at]
            other = other[label[other] != label[at]]
    x, y = (np.array(c, np.int64) for c in zip(*links, strict=True)) if links else (np.empty(0, np.int64),) * 2
    return block.ids[x], block.ids[y]


def compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in grouped(batches, ["key", "i", "j"]):
        x, y = apart(rows)
        yield pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(x, y), pa.int64()), "b": pa.array(np.maximum(x, y), pa.int64())})


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows with equal keys, of batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch.column(k).to_numpy() for k in keys])
        cuts = [0, *(np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            here = tuple(columns[:, a].tolist())
            if held and here != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = here
    if held:
        yield pa.Table.from_batches(held)
    give_back()


def repeats_ids(docs: DataFrame) -> bool:
    counts = docs.agg(F.count("doc_id"), F.count_distinct("doc_id")).first()
    return counts[0] != counts[1]


def signatures(docs: DataFrame) -> tuple[DataFrame, bool]:
    """One row a document (SIGNED), written once, and whether ids repeat."""
    signed = stored(docs.select("doc_id", "text").mapInArrow(sign, SIGNED), "signed")
    if not repeats_ids(signed):
        return signed, False
    one = signed.filter("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("n_shingles", "d1", "d2", "bands", "sketch")).alias("s"))
    return stored(one.select("doc_id", "s.*").unionByName(signed.filter("doc_id is null")), "signed"), True


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row a document."""
    signed, repeated = signatures(docs)
    usable = signed.filter("n_shingles > 0 and doc_id is not null")
    digest = ["n_shingles", "d1", "d2"]
    classes = usable.groupBy(*digest).agg(F.min("doc_id").alias("rep"))
    first = F.col("doc_id") == F.col("rep")
    members = stored(
        usable.join(classes, digest).select("doc_id", "rep", "n_shingles", F.when(first, F.col("bands")).alias("bands"), F.when(first, F.col("sketch")).alias("sketch")),
        "members",
    )
    reps = members.filter("bands is not null").select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "bands", "sketch")
    banded = reps.select("id", F.posexplode("bands").alias("band", "key"))
    buckets = banded.groupBy("key").agg(F.min("id").alias("pivot"), F.count("*").alias("size")).filter("size > 1")
    shared = stored(banded.join(buckets, "key"), "buckets")
    texts = docs.select("doc_id", "text")
    light = reps.select("id", "n", "sketch")

    stars = shared.filter("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    links = linked(sketch_filter(stars, light), texts, repeated)
    parts = components(links)
    open_ = open_buckets(shared, parts)
    if not open_.isEmpty():
        more = stored(block_links(open_, reps, texts, repeated).distinct(), "links")
        if not more.isEmpty():
            parts = components(links.unionByName(more))

    found = members.select("doc_id", "rep").join(parts.withColumnRenamed("id", "rep"), "rep", "left")
    found = found.select("doc_id", F.coalesce("component", "rep").alias("component_id"))
    out = signed.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def sketch_filter(pairs: DataFrame, light: DataFrame) -> DataFrame:
    """Pairs that may be linked by their sketches."""
    a = light.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    b = light.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    return stored(pairs.join(a, "a").join(b, "b").mapInArrow(likely, PAIRS), "likely")


def linked(pairs: DataFrame, texts: DataFrame, repeated: bool) -> DataFrame:
    """The pairs whose full sets are similar enough; sets are made anew from the texts of these documents alone."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = sets_of(texts, wanted, repeated)
    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    return stored(pairs.join(a, "a").join(b, "b").mapInArrow(decide, PAIRS), "links")


def open_buckets(shared: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows (key, band, id, component, size) of buckets of three or more whose members are not all connected."""
    rows = shared.filter("size > 2").join(parts, "id", "left")
    rows = rows.select("key", "band", "id", "size", F.coalesce("component", "id").alias("component"))
    several = rows.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("key")
    return stored(rows.join(several, "key"), "open")


def block_links(rows: DataFrame, reps: DataFrame, texts: DataFrame, repeated: bool) -> DataFrame:
    """Links (a, b) between what is apart, found in square blocks of each open bucket.

    Sketches come first; full sets go only to the rows that are in a pair left undecided by them.
    """
    blocks = F.ceil(F.col("size") / BLOCK)
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("long"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    shares = ["key", "i", "j"]
    light = rows.select(*shares, "block", "band", "id", "component").join(reps, "id")
    dealt = light.repartition(*shares).sortWithinPartitions(*shares)
    left = stored(dealt.mapInArrow(undecided, light.schema), "undecided")
    wanted = left.select(F.col("id").alias("doc_id")).distinct()
    sets = sets_of(texts, wanted, repeated)
    return left.join(sets, "id").repartition(*shares).sortWithinPartitions(*shares).mapInArrow(compare_blocks, PAIRS)
