"""Ranked lexical search: the highest inner products of item and document vectors, by buckets of like length.

A document is a vector of impacts over the terms of the items, an item one of its terms' weights times their repeats; the
score is their product. Documents are dealt into buckets by the class of their length, longest first. A bucket is left out
for an item whose length times the bucket's greatest one stays below the item's k-th best score so far (Cauchy-Schwarz).
Inside, an item's heaviest coordinates are multiplied first; a document stays if that and the most that the rest of the two
vectors can give reach the k-th best. Those that stay are scored in 64-bit integers. Bounds are rounded up, and only what
is strictly below is left out, so equal scores are all found and go to the smaller doc_id.

Impact of a term that occurs tf times in a document of n terms: (10**9 tf) div (1000 tf + 8 m), m = 25 + (75 n N) div L,
with N documents that have a term and L terms in all. Weight: floor(1000 ln((2 N + 2) / (2 df + 1))), in doubles.

Cases: null text has no terms. A document without a term counts nowhere. One with a null id counts in N, L and df but isn't
ranked; rows with equal ids are documents of their own. Of an item_id that repeats, the smallest text stands; items with
a null id or without a term have no rows. Empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tickloom.llm.common import stored, text_slices
from tickloom.session import ship

ship(__name__)

#: Text of the items of one pass over the documents; more items take more passes.
BLOCK_BYTES = 2_000_000
#: Terms with their impacts that a bucket holds on average; a task holds one bucket.
BUCKET_TERMS = 1_000_000
#: Lengths of a class lie within this ratio.
RATIO = 1.25
#: Buckets of the first round, and how much the number of buckets searched grows with each round.
FIRST, GROWTH = 4, 64
#: Share of an item's squared length that its coordinates multiplied first have.
HEAVY = 0.7

#: Letters, digits and all beyond ASCII make terms; only A-Z are lower-cased.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


@dataclass
class Item:
    """Term numbers, heaviest first, with weight times repeats; ``heavy`` of them are multiplied first."""

    item_id: int
    terms: list[int]
    weights: list[int]
    heavy: int = 0
    length: float = 0.0
    rest: float = 0.0
    best: int = 0

    @staticmethod
    def of(item_id: int, counts: dict[int, int], weight: dict[int, int]) -> Item:
        heavy_first = sorted(((weight[t] * n, t) for t, n in counts.items() if weight.get(t)), reverse=True)
        item = Item(item_id, [t for _, t in heavy_first], [w for w, _ in heavy_first])
        squares = [float(w) * w for w in item.weights]
        item.length = math.sqrt(sum(squares))
        done = 0.0
        while item.heavy < len(squares) and done < HEAVY * sum(squares):
            done += squares[item.heavy]
            item.heavy += 1
        item.rest = math.sqrt(sum(squares[item.heavy :]))
        return item


@dataclass
class Block:
    """Items whose terms fit one pass, with numbers for their terms."""

    numbers: dict[bytes, int] = field(default_factory=dict)
    items: list[tuple[int, dict[int, int]]] = field(default_factory=list)

    def add(self, item_id: int, text: str) -> None:
        counted = Counter(terms_of(text))
        self.items.append((item_id, {self.numbers.setdefault(t, len(self.numbers)): n for t, n in counted.items()}))


def blocks(items: DataFrame, most: int) -> Iterator[Block]:
    """Items in blocks of about ``most`` bytes of text, read one partition at a time."""
    block, size = Block(), 0
    for row in items.toLocalIterator():
        block.add(row.item_id, row.text)
        size += len(row.text)
        if size >= most:
            yield block
            block, size = Block(), 0
    if block.items:
        yield block


def term_vectors(numbers: dict[bytes, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each text with terms: how many it has, and the numbers and counts of the items' terms among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.get
        for batch in text_slices(batches):
            out: tuple[list, ...] = ([], [], [], [])
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = terms_of(text.as_py())
                if not words:
                    continue
                found = Counter(map(known, words))
                found.pop(None, None)
                for column, value in zip(out, (doc_id, len(words), list(found), list(found.values())), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["doc_id", "n", "terms", "counts"])

    return run


def with_impacts(vectors: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """(doc_id, terms, impacts, length) of the documents that can be ranked."""
    m = F.expr(f"25 + ((cast(75 * n as decimal(19,0)) * cast({n_docs} as decimal(19,0))) div cast({max(n_terms, 1)} as decimal(19,0)))")
    impacts = F.expr("transform(counts, c -> (1000000000 * c) div (1000 * c + 8 * m))")
    squares = F.aggregate("impacts", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    ranked = vectors.filter("doc_id is not null and size(terms) > 0").withColumn("m", m)
    return ranked.select("doc_id", "terms", impacts.alias("impacts")).withColumn("length", F.sqrt(squares))


def length_class() -> Column:
    """Classes of like length, longer ones first."""
    return (-F.floor(F.log(F.greatest("length", F.lit(1e-9))) / math.log(RATIO))).cast("int")


def numbered(vectors: DataFrame, classes: list[Row]) -> DataFrame:
    """Adds the bucket: the buckets of a class follow those of longer ones, rows are dealt among them by hash."""
    first, of_class = 0, []
    for r in classes:
        of_class.append((r.c, first, r.buckets))
        first += r.buckets
    place = F.create_map(*[F.lit(v) for c, at, n in of_class for v in (c, at)])[length_class()]
    width = F.create_map(*[F.lit(v) for c, at, n in of_class for v in (c, n)])[length_class()]
    return vectors.withColumn("bucket", (place + F.pmod(F.xxhash64("doc_id", "terms", "impacts"), width)).cast("int"))


def bucket_search(items: list[Item], k: int) -> Callable[[pa.Table], pa.Table]:
    def search(bucket: pa.Table) -> pa.Table:
        ids = bucket["doc_id"].to_numpy()
        terms, impacts = (bucket[c].combine_chunks() for c in ("terms", "impacts"))
        rows = np.repeat(np.arange(len(ids), dtype=np.int32), terms.value_lengths().to_numpy())
        terms, impacts = terms.flatten().to_numpy(), impacts.flatten().to_numpy()
        squares = np.bincount(rows, impacts.astype(np.float64) ** 2, len(ids))
        order = np.argsort(terms, kind="stable")
        terms, rows, impacts = terms[order], rows[order], impacts[order]
        longest = math.sqrt(squares.max(initial=0.0))
        out: tuple[list, list, list] = ([], [], [])
        for item in items:
            # Bounds are a little more than they need be, since they are in doubles.
            if item.length * longest * (1 + 1e-9) + 1 < item.best:
                continue
            starts, ends = np.searchsorted(terms, item.terms), np.searchsorted(terms, item.terms, side="right")
            scores, met = np.zeros(len(ids), np.int64), np.zeros(len(ids))
            for i in range(item.heavy):
                at = slice(starts[i], ends[i])
                scores[rows[at]] += item.weights[i] * impacts[at]
                met[rows[at]] += impacts[at].astype(np.float64) ** 2
            left = item.rest * np.sqrt(np.maximum(squares - met, 0.0) + 1.0)
            alive = (scores + left) * (1 + 1e-9) + 1 >= item.best
            for i in range(item.heavy, len(item.terms)):
                at = slice(starts[i], ends[i])
                stay = alive[rows[at]]
                scores[rows[at][stay]] += item.weights[i] * impacts[at][stay]
            hits = np.nonzero(alive & (scores > 0) & (scores >= item.best))[0]
            if len(hits) > k:
                kth = np.partition(scores[hits], len(hits) - k)[len(hits) - k]
                hits = hits[scores[hits] >= kth]
            hits = hits[np.lexsort((ids[hits], -scores[hits]))][:k]
            out[0].append(np.full(len(hits), item.item_id, np.int64))
            out[1].append(ids[hits])
            out[2].append(scores[hits])
        columns = [np.concatenate(c).astype(np.int64) if c else np.empty(0, np.int64) for c in out]
        return pa.table(dict(zip(("item_id", "doc_id", "score"), columns, strict=True)))

    return search


def best_of(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k)


def rank_block(texts: DataFrame, block: Block, k: int, bucket_terms: int, first: int, growth: int) -> DataFrame | None:
    """The best documents of a block's items; rounds take ever more buckets, each with the bests of the rounds before."""
    vectors = stored(texts.mapInArrow(term_vectors(block.numbers), "doc_id long, n long, terms array<int>, counts array<long>"), "terms")
    n_docs, n_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One row for each term of the block's items.
    df = dict(vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    items = [i for i in (Item.of(i, counts, weight) for i, counts in block.items) if i.terms]
    sized = with_impacts(vectors, n_docs, n_terms)
    # One row for each class of length, at most some hundred.
    buckets = F.ceil(F.sum(F.size("terms")) / bucket_terms).cast("int").alias("buckets")
    classes = sized.groupBy(length_class().alias("c")).agg(buckets).orderBy("c").collect()
    if not items or not classes:
        return None
    dealt, total = numbered(sized, classes), sum(r.buckets for r in classes)
    top, start, width = None, 0, first
    while start < total:
        part = dealt.filter(F.col("bucket").between(start, start + width - 1)).select("bucket", "doc_id", "terms", "impacts")
        found = part.groupBy("bucket").applyInArrow(bucket_search(items, k), "item_id long, doc_id long, score long")
        top = stored(best_of(found if top is None else found.union(top.drop("rank")), k), "ranked")
        # One row for each item of the block.
        best = dict(top.filter(F.col("rank") == k).select("item_id", "score").collect())
        for item in items:
            item.best = best.get(item.item_id, 0)
        start, width = start + width, width * growth
    return top


def rank(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    block_bytes: int = BLOCK_BYTES,
    bucket_terms: int = BUCKET_TERMS,
    first: int = FIRST,
    growth: int = GROWTH,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above 0 for each item."""
    spark = docs.sparkSession
    asked = items.filter("item_id is not null and text is not null").groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.min("text").alias("text"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in blocks(asked, block_bytes):
        top = rank_block(texts, block, k, bucket_terms, first, growth)
        if top is not None:
            found = found.union(top.select("item_id", "rank", "doc_id", "score"))
    return found
