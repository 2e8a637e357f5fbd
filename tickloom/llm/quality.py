"""Quality of texts by an interpolated modified Kneser-Ney model of bytes, trained on trusted text.

An n-gram is the last ORDER bytes up to a position, as one integer: its context is the integer shifted by a byte, its
shorter n-gram the lower bytes. Tasks count n-grams a slice of text at a time, and the counts add up in a table that
stays distributed. Continuation counts, context sums and discounts are aggregates of that table.

Scoring: texts are written as blocks. Each block's distinct n-grams (few against its bytes) meet the count tables in
joins sharded by n-gram, and their logarithms come back to the block, which adds them up for each text. Nothing that
grows with the corpus is broadcast, and no row is made for each occurrence.

A text is judged by bits a byte, drawn towards its language's median as if PRIOR_BYTES more bytes of that were read,
so that a few odd bytes don't condemn a short text. The limit is the HIGH quantile of trusted texts that the model has
not seen (one in CALIBRATION), by language. A text above it is rejected. There is no lower limit on bits: texts that the
model has learned, and their copies, are low and good. Repetition, which is cheap too, shows in the text alone, learned or
not: the share of its n-grams that stand at most NEAR bytes before as well may not be above the MOST quantile of the same
trusted texts.

A language's limits are its own at every size. Those of few texts are drawn towards the distance from the median that
trusted texts of all languages have, and moved up by what the median of so few may be wrong. A language whose trusted
texts are all learned takes the quantiles of all its documents. One of which nothing trusted was learned has no limits:
its documents are accepted.

Cases: a null or empty text has no bytes, the median for its bits, and is accepted; a null language is ``und``; repeated
rows are judged each on its own; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import keep, shared_path, stored, text_slices, working_tables
from tickloom.session import ship

ship(__name__)

ORDER = 5
#: Bytes of text of a block, of one whose rows are taken out again, and of a slice whose n-grams are sorted at once.
#: Larger blocks share more n-grams; a block's rows are held by one worker.
BLOCK_BYTES, ROW_BLOCK_BYTES, SLICE = 32_000_000, 12_000_000, 2_000_000
CALIBRATION = 4
#: Of so many texts, a distance from the median counts half; the distances taken where no text tells them, by kind.
FEW, WIDE = 50, (1.0, 0.2)
HIGH = 0.99
#: An n-gram within so many bytes of its like is a repeat, at any length of text; the quantile of trusted texts' repeats.
NEAR, MOST = 256, 0.995
PRIOR_BYTES = 60
#: Quantiles are those of bits rounded to this many parts.
BINS = 1000
#: Discounts where counts of counts are too few to estimate them.
PLAIN_DISCOUNTS = (0.5, 1.0, 1.5)

BLOCKS = "block long, doc_ids array<long>, langs array<string>, sizes array<long>, texts binary, rest binary"
COUNTED = "gram long, n long"
SCORED = "doc_id long, lang string, n_bytes long, nll double, repeats long, block long, place int"


def grams(text: bytes) -> np.ndarray:
    """The n-gram that ends at each byte; four zero bytes stand before the text."""
    data = np.frombuffer(bytes(ORDER - 1) + text, np.uint8).astype(np.int64)
    out = np.zeros(len(text), np.int64)
    for k in range(ORDER):
        out = (out << 8) | data[k : k + len(text)]
    return out


def slices(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """N-grams of texts, and the text of each, at most SLICE at a time."""
    held: list[tuple[np.ndarray, int]] = []
    size = 0
    for i, text in enumerate(texts):
        for at in range(0, len(text), SLICE):
            start = max(0, at - ORDER + 1)
            part = grams(text[start : at + SLICE])[at - start :]
            held.append((part, i))
            size += len(part)
            if size >= SLICE:
                yield np.concatenate([p for p, _ in held]), np.repeat([i for _, i in held], [len(p) for p, _ in held])
                held, size = [], 0
    if held:
        yield np.concatenate([p for p, _ in held]), np.repeat([i for _, i in held], [len(p) for p, _ in held])


def repeats(text: bytes) -> int:
    """How many n-grams of a text also end at most NEAR bytes before."""
    found = 0
    for at in range(0, len(text), SLICE):
        first = max(0, at - NEAR)
        start = max(0, first - ORDER + 1)
        keys = grams(text[start : at + SLICE])[first - start :]
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        later, gap = order[1:][same], np.diff(order)[same]
        found += int(((gap <= NEAR) & (later >= at - first)).sum())
    return found


def as_bytes(texts: list[str | None]) -> list[bytes]:
    return [(t or "").encode("utf-8", "replace") for t in texts]


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, most=BLOCK_BYTES):
        for keys, _ in slices(as_bytes(batch.column("text").to_pylist())):
            gram, n = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_pydict({"gram": pa.array(gram), "n": pa.array(n.astype(np.int64))})


def blocker(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return to_blocks(batches, most)

    return run


def to_blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows as blocks: texts compressed together, and all other columns as they are, in ``rest``."""
    import zstandard

    press = zstandard.ZstdCompressor(level=3)
    partition, number = TaskContext.get().partitionId(), 0
    held: list[tuple[pa.RecordBatch, list[bytes]]] = []
    size = 0

    def block() -> pa.RecordBatch:
        rows = pa.Table.from_batches([b for b, _ in held])
        texts = [t for _, some in held for t in some]
        # The text's place is taken by whether it is null.
        rest = rows.set_column(rows.schema.get_field_index("text"), "text", rows["text"].is_null())
        columns = [
            pa.array([(partition << 32) | number], pa.int64()),
            pa.array([rows["doc_id"].to_pylist()], pa.list_(pa.int64())),
            pa.array([rows["lang"].to_pylist()], pa.list_(pa.string())),
            pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
            pa.array([press.compress(b"".join(texts))], pa.binary()),
            pa.array([press.compress(ipc_bytes(rest))], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["block", "doc_ids", "langs", "sizes", "texts", "rest"])

    for batch in text_slices(batches):
        texts, first = as_bytes(batch.column("text").to_pylist()), 0
        for at, text in enumerate(texts, 1):
            size += len(text)
            if size >= most:
                held.append((batch.slice(first, at - first), texts[first:at]))
                yield block()
                number, held, size, first = number + 1, [], 0, at
        if first < len(texts):
            held.append((batch.slice(first), texts[first:]))
    if held:
        yield block()


def ipc_bytes(rows: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema) as writer:
        writer.write_table(rows)
    return out.getvalue().to_pybytes()


def rebuild(block: pa.Table, places: pa.Table) -> pa.Table:
    """The rows at ``places`` of a block, as they were."""
    import zstandard

    row = block.to_pylist()[0]
    rest = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(row["rest"])).read_all()
    wanted = pa.array(sorted(places["place"].to_pylist()), pa.int64())
    texts, missing = block_texts(row["sizes"], row["texts"]), rest["text"].to_pylist()
    whole = pa.array([None if missing[i] else texts[i].decode() for i in wanted.to_pylist()], pa.string())
    return rest.take(wanted).set_column(rest.schema.get_field_index("text"), "text", whole)


def block_table(docs: DataFrame, most: int | None = None) -> DataFrame:
    """The rows as blocks, written once and dealt by block, so that meeting them by block moves no text again."""
    spark = docs.sparkSession
    name, path = f"blocks_{uuid.uuid4().hex}", shared_path(spark, "blocks")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs.mapInArrow(blocker(most or BLOCK_BYTES), BLOCKS).write.bucketBy(parts, "block").option("path", path).option("compression", "none").saveAsTable(name)
    blocks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the catalog's entry; the files stay for those who read them
    return blocks


def count_trusted(block: pa.Table, places: pa.Table) -> pa.Table:
    """N-gram counts of the texts at ``places`` of a block."""
    wanted = sorted(set(places["place"].to_pylist()))
    grams_, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for row in block.to_pylist() if wanted else []:
        texts = block_texts(row["sizes"], row["texts"])
        for keys, _ in slices([texts[i] for i in wanted]):
            some, n = np.unique(keys, return_counts=True)
            both, place = np.unique(np.concatenate([grams_, some]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, n]), len(both)).astype(np.int64)
            grams_ = both
    return pa.table({"gram": grams_, "n": counts})


def block_texts(sizes: list[int], packed: bytes) -> list[bytes]:
    import zstandard

    joined, at, out = zstandard.ZstdDecompressor().decompress(packed), 0, []
    for n in sizes:
        out.append(joined[at : at + n])
        at += n
    return out


def block_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of each block."""
    for row in (r for b in batches for r in b.select(["block", "sizes", "texts"]).to_pylist()):
        known = np.empty(0, np.int64)
        for keys, _ in slices(block_texts(row["sizes"], row["texts"])):
            known = np.union1d(known, keys)
        for i in range(0, len(known), 50_000):
            part = known[i : i + 50_000]
            yield pa.RecordBatch.from_pydict({"block": pa.array(np.full(len(part), row["block"])), "gram": pa.array(part)})


def add_up(block: pa.Table, table: pa.Table) -> pa.Table:
    """Negative log-likelihood of each text of a block, by the block's table of n-grams."""
    order = np.argsort(table["gram"].to_numpy())
    known, cost = table["gram"].to_numpy()[order], table["cost"].to_numpy()[order]
    ids, langs, sizes, total, again, of, places = [], [], [], [], [], [], []
    for row in block.select(["block", "doc_ids", "langs", "sizes", "texts"]).to_pylist():
        of += [row["block"]] * len(row["sizes"])
        places += range(len(row["sizes"]))
        sums = np.zeros(len(row["sizes"]))
        texts = block_texts(row["sizes"], row["texts"])
        again += map(repeats, texts)
        for keys, owner in slices(texts):
            place = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
            if len(known) == 0 or (known[place] != keys).any():
                raise ValueError(f"block {row['block']} lacks n-grams")
            sums += np.bincount(owner, cost[place], len(sums))
        ids += row["doc_ids"]
        langs += row["langs"]
        sizes += row["sizes"]
        total += sums.tolist()
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "lang": pa.array(langs, pa.string()), "n_bytes": pa.array(sizes, pa.int64()), "nll": pa.array(total, pa.float64()), "repeats": pa.array(again, pa.int64()), "block": pa.array(of, pa.int64()), "place": pa.array(places, pa.int32())})


@dataclass
class Model:
    """By order from 1: n-grams with counts, contexts with sums, discounts."""

    counts: list[DataFrame]
    contexts: list[DataFrame]
    discounts: list[tuple[float, float, float]]


def lower(gram: str, order: int) -> Column:
    """The last ``order`` bytes of an n-gram."""
    return F.col(gram).bitwiseAND(F.lit((1 << 8 * order) - 1).cast("long"))


def train(trusted: DataFrame) -> Model:
    """Count tables of the texts in ``trusted``; all of them count."""
    return model_of(trusted.select("text").mapInArrow(count_grams, COUNTED))


def model_of(raw: DataFrame) -> Model:
    """Count tables from counts (gram, n) of parts of the trusted texts."""
    counts = [stored(raw.groupBy("gram").agg(F.sum("n").alias("n")), "grams")]
    for order in range(ORDER - 1, 0, -1):
        counts.insert(0, stored(counts[0].groupBy(lower("gram", order).alias("gram")).agg(F.count("*").alias("n")), "grams"))
    discounts, contexts = [], []
    for table in counts:
        seen = table.agg(*[F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]).first()
        discounts.append(discounts_of(*seen))
        d = discounts[-1]
        held = F.sum(F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2]))
        sums = table.groupBy(F.shiftright("gram", 8).alias("context")).agg(F.sum("n").alias("total"), held.alias("held"))
        contexts.append(stored(sums, "contexts"))
    return Model(counts, contexts, discounts)


def discounts_of(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    if not (n1 and n2 and n3 and n4):
        return PLAIN_DISCOUNTS
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(d if 0 < d <= k else p for k, d, p in zip((1, 2, 3), found, PLAIN_DISCOUNTS, strict=True))


def costs(wanted: DataFrame, model: Model) -> DataFrame:
    """(gram, cost): the negative log probability of each n-gram's last byte after the others."""
    rows = wanted.select("gram", F.lit(1 / 256).alias("p"))
    for order, (counts, contexts, d) in enumerate(zip(model.counts, model.contexts, model.discounts, strict=True), 1):
        rows = rows.withColumns({"part": lower("gram", order), "context": F.shiftright(lower("gram", order), 8)})
        rows = rows.join(contexts, "context", "left").join(counts.withColumnRenamed("gram", "part"), "part", "left")
        off = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        here = F.coalesce(F.col("n") - off, F.lit(0.0))
        p = F.when(F.col("total").isNull(), F.col("p")).otherwise((here + F.col("held") * F.col("p")) / F.col("total"))
        rows = rows.select("gram", p.alias("p"))
    return rows.select("gram", (-F.log("p")).alias("cost"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang, n_bytes, nll, repeats) of each row of ``docs``: nll sums its bytes' negative log probabilities."""
    return score_blocks(block_table(docs.select("doc_id", "lang", "text")), model).drop("block", "place")


def score_blocks(blocks: DataFrame, model: Model) -> DataFrame:
    found = stored(blocks.mapInArrow(block_grams, "block long, gram long"), "found")
    table = found.join(costs(found.select("gram").distinct(), model), "gram")
    empty = blocks.select("block", F.lit(-1).cast("long").alias("gram"), F.lit(0.0).alias("cost"))  # blocks of empty texts
    table = table.select("block", "gram", "cost").unionByName(empty)
    return blocks.groupBy("block").cogroup(table.groupBy("block")).applyInArrow(add_up, SCORED)


def measures(scored: DataFrame, ids: DataFrame) -> DataFrame:
    """Counts (of, held, kind, bin, k) of non-empty texts by language: kind 0 is bits a byte, 1 the share of repeats.

    ``held`` is whether a trusted text is kept from the model, null for other texts.
    """
    bits = F.col("nll") / F.col("n_bytes") / F.log(F.lit(2.0))
    bins = F.transform(F.array(bits, F.col("repeats") / F.col("n_bytes")), lambda x: F.floor(x * BINS))
    rows = scored.filter("n_bytes > 0").join(ids.select("doc_id", calibrating().alias("held")), "doc_id", "left")
    rows = rows.select(F.coalesce("lang", F.lit("und")).alias("of"), "held", F.posexplode(bins).alias("kind", "bin"))
    return rows.groupBy("of", "held", "kind", "bin").agg(F.count("*").alias("k"))


def spread(counts: DataFrame, *by: str) -> DataFrame:
    """(by, kind, texts, median, own) of counted measures; ``own`` is the distance of the high quantile."""
    high = F.when(F.col("kind") == 0, F.percentile("bin", HIGH, F.col("k"))).otherwise(F.percentile("bin", MOST, F.col("k")))
    found = counts.groupBy(*by, "kind").agg(F.sum("k").alias("texts"), F.percentile("bin", 0.5, F.col("k")).alias("median"), high.alias("high"))
    return found.select(*by, "kind", "texts", ((F.col("median") + 0.5) / BINS).alias("median"), ((F.col("high") - F.col("median")) / BINS).alias("own"))


def limits(scored: DataFrame, ids: DataFrame) -> DataFrame:
    """(of, median, high, most) by language; no limits where nothing trusted was learned."""
    counts = stored(measures(scored, ids), "measures")
    every, trusted = spread(counts, "of"), spread(counts.filter("held"), "of")
    away = counts.filter("held").join(trusted.select("of", "kind", "median"), ["of", "kind"])
    away = spread(away.withColumn("bin", F.col("bin") + 0.5 - F.col("median") * BINS))
    wide = [F.lit(x) for x in WIDE]
    pooled = {r.kind: (r.texts, r.own) for r in away.collect()}
    for kind, (texts, own) in pooled.items():
        wide[kind] = F.lit((texts * own + FEW * WIDE[kind]) / (texts + FEW))
    learned = counts.filter("not held").select("of").distinct().withColumn("learned", F.lit(True))
    rows = every.join(trusted.select("of", "kind", *[F.col(c).alias(f"its_{c}") for c in ("texts", "median", "own")]), ["of", "kind"], "left").join(learned, "of", "left")
    rows = rows.select("of", "kind", "learned", *[F.coalesce(f"its_{c}", c).alias(c) for c in ("texts", "median", "own")])
    usual = F.when(F.col("kind") == 0, wide[0]).otherwise(wide[1])
    drawn = F.greatest(F.lit(0.0), usual - F.col("own")) * FEW / (F.col("texts") + FEW)
    limit = F.when(F.col("learned"), F.col("median") + F.col("own") + drawn + usual / F.sqrt("texts"))
    rows = rows.withColumn("limit", limit)
    bits, again = F.col("kind") == 0, F.col("kind") == 1
    return rows.groupBy("of").agg(F.max(F.when(bits, F.col("median"))).alias("median"), F.max(F.when(bits, F.col("limit"))).alias("high"), F.max(F.when(again, F.col("limit"))).alias("most"))


def calibrating(doc_id: str = "doc_id") -> Column:
    """Marks the trusted texts that are kept from the model to set limits."""
    return F.pmod(F.xxhash64(doc_id), F.lit(CALIBRATION)) == 0


def judge(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """(doc_id, lang, n_bytes, perplexity, bits, high, repeated, most, accepted) of each row of ``docs``.

    ``trusted_ids`` has the ``doc_id`` of trusted texts among them.
    """
    return judge_blocks(block_table(docs.select("doc_id", "lang", "text")), trusted_ids).drop("block", "place")


def accepted(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge`` accepts, each judged by itself, taken out of the blocks that they lie in."""
    with working_tables(docs.sparkSession):
        blocks = block_table(docs, ROW_BLOCK_BYTES)
        good = stored(judge_blocks(blocks, trusted_ids).filter("accepted").select(F.col("block").alias("of_block"), "place"), "accepted")
        pairs = blocks.groupBy("block").cogroup(good.groupBy("of_block"))
        return keep(stored(pairs.applyInArrow(rebuild_any(docs.columns), docs.schema), "accepted"))


def rebuild_any(columns: list[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def rows(block: pa.Table, places: pa.Table) -> pa.Table:
        return rebuild(block, places).select(columns)

    return rows


def judge_blocks(blocks: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    ids = trusted_ids.select("doc_id").filter("doc_id is not null").distinct()
    places = blocks.select(F.col("block").alias("of_block"), F.posexplode("doc_ids").alias("place", "doc_id"))
    places = places.join(ids.filter(~calibrating()), "doc_id", "left_semi").select("of_block", "place")
    trusted = blocks.select("block", "sizes", "texts").groupBy("block").cogroup(places.groupBy("of_block"))
    scored = stored(score_blocks(blocks, model_of(trusted.applyInArrow(count_trusted, COUNTED))), "scored")
    # One row a language.
    sets = stored(limits(scored, ids), "limits")
    rows = scored.withColumn("of", F.coalesce("lang", F.lit("und"))).join(sets, "of", "left")
    per_byte = F.col("nll") / F.log(F.lit(2.0))
    bits = (per_byte + PRIOR_BYTES * F.col("median")) / (F.col("n_bytes") + PRIOR_BYTES)
    rows = rows.withColumns({"bits": bits, "repeated": F.coalesce(F.try_divide("repeats", "n_bytes"), F.lit(0.0))})
    return rows.select(
        "doc_id", "lang", "n_bytes",
        F.exp(F.try_divide("nll", "n_bytes")).alias("perplexity"), "bits", "high", "repeated", "most",
        F.coalesce((F.col("bits") <= F.col("high")) & (F.col("repeated") <= F.col("most")), F.lit(True)).alias("accepted"),
        "block", "place",
    )
