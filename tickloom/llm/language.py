"""Language of texts by a convolutional network over bytes, trained here in numpy.

A text is lower-cased and cut into windows of a fixed number of bytes, overlapping by a filter's width, so that every
byte is read. Filters of several widths run over embedded bytes; their maxima over a window go to a softmax. A text's
probabilities are the mean over its windows, weighted by their bytes.

Cases: the language of a text that is null or has no letter is ``und`` with score 0, as is every text's where nothing
could be learned; a column already named ``lang_pred`` or ``score`` is replaced; repeated rows and ties are judged
each on its own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import text_slices
from tickloom.session import ship

ship(__name__)

#: Bytes of a window; widest filter first, so that each offset's table covers a prefix of the filters.
WINDOW, WIDTHS, FILTERS, EMBEDDING = 256, (4, 3, 2), 16, 8
STEP = WINDOW - max(WIDTHS) + 1
#: The bounded training sample: labelled texts of each language (lowest hash of their id), characters of each, and
#: languages (the most frequent).
TEXTS_PER_LANGUAGE, TEXT_CHARS, LANGUAGES = 400, 3000, 200
STEPS, BATCH, RATE, SEED = 500, 64, 0.01, 7
UNKNOWN = "und"
#: Windows scored at once: their activations take 25 MB.
AT_ONCE = 512


@dataclass
class Model:
    languages: list[str]
    tables: list[np.ndarray]  # for each offset: byte to its share of the filters' sums
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts as rows of bytes, the text of each, and its number of bytes."""
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    counts = np.array([max(1, -(-len(r) // STEP)) for r in raw], np.int64)
    rows = np.zeros((int(counts.sum()), WINDOW), np.uint8)
    owner = np.repeat(np.arange(len(raw)), counts)
    sizes = np.zeros(len(rows), np.int64)
    at = 0
    for r, n in zip(raw, counts.tolist(), strict=True):
        padded = np.frombuffer(r + bytes((n - 1) * STEP + WINDOW - len(r)), np.uint8)
        rows[at : at + n] = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STEP]
        sizes[at : at + n] = np.minimum(STEP, len(r) - STEP * np.arange(n))
        at += n
    return rows, owner, np.maximum(sizes, 1)


def learn(texts: list[str], languages: list[str]) -> Model | None:
    """Train on texts and their languages; None if there is nothing to learn from."""
    names = sorted(set(languages))
    if not names:
        return None
    rng = np.random.default_rng(SEED)
    rows, owner, sizes = windows(texts)
    label = np.array([names.index(x) for x in languages])[owner]
    by_label = [np.flatnonzero(label == i) for i in range(len(names))]
    width = len(WIDTHS) * FILTERS
    p = {"embed": rng.normal(0, 0.5, (256, EMBEDDING)), "bias": np.zeros(width), "out": rng.normal(0, 0.1, (width, len(names))), "out_bias": np.zeros(len(names))}
    p |= {f"w{w}": rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w * EMBEDDING, FILTERS)) for w in WIDTHS}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    mean, square = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(1, STEPS + 1):
        kinds = rng.integers(0, len(names), BATCH)
        picked = np.array([rng.choice(by_label[i]) for i in kinds])
        x = rows[picked].copy()
        for i in np.flatnonzero(rng.random(BATCH) < 0.4):  # short texts must be known too
            n = int(rng.integers(12, WINDOW // 2))
            x[i, n:] = 0
        embedded = p["embed"][x]
        best, patches = [], []
        for j, w in enumerate(WIDTHS):
            view = np.lib.stride_tricks.sliding_window_view(embedded, w, axis=1)[:, :STEP].transpose(0, 1, 3, 2).reshape(BATCH, STEP, w * EMBEDDING)
            z = view @ p[f"w{w}"]
            at = z.argmax(axis=1)
            best.append(np.take_along_axis(z, at[:, None], 1)[:, 0] + p["bias"][j * FILTERS : (j + 1) * FILTERS])
            patches.append((view, at))
        h = np.maximum(np.concatenate(best, axis=1), 0)
        logits = h @ p["out"] + p["out_bias"]
        prob = np.exp(logits - logits.max(axis=1, keepdims=True))
        prob /= prob.sum(axis=1, keepdims=True)
        prob[np.arange(BATCH), kinds] -= 1
        d = prob / BATCH
        g = {"out": h.T @ d, "out_bias": d.sum(axis=0), "embed": np.zeros_like(p["embed"])}
        dh = (d @ p["out"].T) * (h > 0)
        g["bias"] = dh.sum(axis=0)
        for j, (w, (view, at)) in enumerate(zip(WIDTHS, patches, strict=True)):
            part = dh[:, j * FILTERS : (j + 1) * FILTERS]
            used = view[np.arange(BATCH)[:, None], at]  # the patch that won, by text and filter
            g[f"w{w}"] = np.einsum("bfd,bf->df", used, part)
            back = (part[:, :, None] * p[f"w{w}"].T[None]).reshape(BATCH, FILTERS, w, EMBEDDING)
            for k in range(w):
                np.add.at(g["embed"], x[np.arange(BATCH)[:, None], at + k], back[:, :, k])
        for k in p:
            mean[k] = 0.9 * mean[k] + 0.1 * g[k]
            square[k] = 0.99 * square[k] + 0.01 * g[k] ** 2
            rate = RATE * (1 - 0.9 * step / STEPS)
            p[k] -= (rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    tables = [
        np.concatenate([p["embed"] @ p[f"w{w}"][k * EMBEDDING : (k + 1) * EMBEDDING] for w in WIDTHS if w > k], axis=1)
        for k in range(max(WIDTHS))
    ]
    return Model(names, tables, p["bias"], p["out"], p["out_bias"])


def window_probabilities(model: Model, rows: np.ndarray) -> np.ndarray:
    out = np.empty((len(rows), len(model.languages)))
    for i in range(0, len(rows), AT_ONCE):
        x = rows[i : i + AT_ONCE]
        z = model.tables[0][x[:, :STEP]]
        for k, table in enumerate(model.tables[1:], 1):
            z[:, :, : table.shape[1]] += table[x[:, k : k + STEP]]
        logits = np.maximum(z.max(axis=1) + model.bias, 0) @ model.out + model.out_bias
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        out[i : i + AT_ONCE] = e / e.sum(axis=1, keepdims=True)
    return out


def judge(model: Model | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    usable = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if model else []
    if usable:
        rows, owner, sizes = windows([texts[i] for i in usable])
        prob = window_probabilities(model, rows)
        total = np.zeros((len(usable), prob.shape[1]))
        np.add.at(total, owner, prob * sizes[:, None])
        total /= total.sum(axis=1, keepdims=True)
        for i, k, s in zip(usable, total.argmax(axis=1).tolist(), total.max(axis=1).tolist(), strict=True):
            names[i], scores[i] = model.languages[k], s
    return names, np.clip(scores, 0, 1)


def train(labelled: DataFrame) -> Model | None:
    """A model from rows (doc_id, text, lang): a bounded sample of the labelled texts is collected and learned."""
    rows = labelled.select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).filter("lang is not null and doc_id is not null")
    common = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang")
    few = (
        rows.join(F.broadcast(common), "lang")
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id")))
        .filter(F.col("place") <= TEXTS_PER_LANGUAGE)
        .select("doc_id")
    )
    sample = (
        labelled.filter("lang is not null and text is not null")
        .join(F.broadcast(few.distinct()), "doc_id", "left_semi")
        .select("doc_id", "lang", F.substring("text", 1, TEXT_CHARS).alias("text"))
        .limit(2 * TEXTS_PER_LANGUAGE * LANGUAGES)
        .collect()
    )
    sample = sorted(r for r in sample if any(map(str.isalpha, r.text)))
    return learn([r.text for r in sample], [r.lang for r in sample])


def scorer(shared: Broadcast, called: tuple[str, str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value and Model(*shared.value)
        for batch in text_slices(batches):
            names, scores = judge(model, batch.column("text").to_pylist())
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *called])

    return score


def predict(docs: DataFrame, model: Model | None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the language and score of each text, as columns ``names``; only ``text`` is looked at."""
    docs = docs.drop(*names)
    # Plain values: workers need no copy of this package to read them. Their size is the network's, some 40 kB.
    parts = model and (model.languages, model.tables, model.bias, model.out, model.out_bias)
    shared = docs.sparkSession.sparkContext.broadcast(parts)
    fields = [*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    return docs.mapInArrow(scorer(shared, names), T.StructType(fields))
