"""SentencePiece encoding and decoding: the best segmentation by Viterbi over a double-array trie of scored pieces.

White space: a text gets one space in front, and each space becomes the marker U+2581, which no piece has behind
another character. So the best segmentation of a text is that of its parts, each from a marker on; a batch's distinct
parts are segmented together, position by position, in numpy. Characters that no piece covers become their UTF-8
bytes (byte fallback), as does the marker itself where a text has it, so decoding gives every text back.

Scores: the public model file ranks pieces by merge order, and that rank stands in for a frequency rank: by Zipf's
law a piece's log score is -log(rank + 1) - log(sum of 1 / rank). Ties go to the longest last piece.

Cases: null and empty texts have no ids; very long texts and parts are segmented whole; repeated rows and clashing
columns are passed through, columns named ``ids`` or ``n_ids`` replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickloom.llm.common import text_slices
from tickloom.session import ship

ship(__name__)

MARK = "▁"
#: A character without a piece costs this much more than the least likely piece.
UNKNOWN_PENALTY = 10.0
#: Parts that a worker keeps between slices; results don't depend on it.
REMEMBERED = 300_000
#: Bytes of distinct parts that are segmented together: each takes some hundred bytes of arrays. A longer part is alone.
LOT = 262_144
#: Bytes of text, and of ids, that a worker handles at once.
SLICE = 1_000_000
#: In a text, the marker is replaced by this byte, which UTF-8 never has, so that it isn't taken for a space.
FOREIGN_MARK = b"\xff"
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


@dataclass
class Trie:
    """Double array: from a state s, byte b leads to base[s] + b if check there is s; value is a piece's id or -1."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray
    pieces: list[bytes]

    def parts(self) -> tuple:
        """Plain values: workers need no copy of this package to read them."""
        return self.base, self.check, self.value, self.scores, self.byte_ids, self.pieces

    @cached_property
    def spoken(self) -> list[bytes]:
        """What each piece is in a text: the marker is a space, but not where bytes stand for themselves."""
        fallback = set(self.byte_ids.tolist())
        return [p if i in fallback else p.replace(MARK.encode(), b" ") for i, p in enumerate(self.pieces)]

    @property
    def unknown(self) -> float:
        return float(self.scores.min()) - UNKNOWN_PENALTY


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_pieces(path: str) -> tuple[list[str], list[float], list[bool]]:
    """Texts, log scores and kinds (an ordinary piece or not) of a public model file's pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=Path(path).read_bytes())
    n = model.get_piece_size()
    texts = [model.id_to_piece(i) for i in range(n)]
    plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(n)]
    order = sorted((i for i in range(n) if plain[i]), key=lambda i: (-model.get_score(i), i))
    total = np.log(sum(1 / (r + 1) for r in range(len(order))))
    scores = [0.0] * n
    for rank, i in enumerate(order):
        scores[i] = float(-np.log(rank + 1) - total)
    return texts, scores, plain


def build_trie(texts: list[str], scores: list[float], plain: list[bool]) -> Trie:
    """The double array of the ordinary pieces."""
    keys = {t.encode(): i for i, t in enumerate(texts) if plain[i]}
    if any(MARK in t.lstrip(MARK) for t, p in zip(texts, plain, strict=True) if p):
        raise ValueError("pieces must have the white-space marker in front only")
    children: dict[bytes, list[int]] = {b"": []}
    for key in keys:
        for k in range(len(key)):
            if key[: k + 1] in children:
                continue
            children[key[: k + 1]] = []
            children[key[:k]].append(key[k])
    base: dict[int, int] = {}
    check: dict[int, int] = {}
    value: dict[int, int] = {}
    used = bytearray(4 * len(children) + 1024)  # cells taken; it grows with them
    used[0] = 1
    place = {b"": 0}
    free = last = 1
    for prefix in sorted(children, key=lambda p: (len(p), p)):
        state, codes = place[prefix], children[prefix]
        value[state] = keys.get(prefix, -1)
        if not codes:
            continue
        if len(used) < last + 2048:
            used.extend(bytes(len(used)))
        if len(codes) == 1:  # an only child takes the first free place that its byte can reach
            free = used.index(0, free)
            at = max(1, used.index(0, max(free, codes[0] + 1)) - codes[0])
        else:  # several go where the array is still sparse
            at = max(1, last - 256)
            while any(used[at + c] for c in codes):
                at += 1
        base[state] = at
        for c in codes:
            used[at + c] = 1
            check[at + c] = state
            place[prefix + bytes([c])] = at + c
            last = max(last, at + c)
    top = max(place.values()) + 257
    cells = []
    for found, none in ((base, 0), (check, -1), (value, -1)):
        cells.append(np.full(top, none, np.int32))
        cells[-1][list(found)] = list(found.values())
    byte_ids = np.full(256, -1, np.int64)
    for i, t in enumerate(texts):
        m = BYTE_PIECE.fullmatch(t)
        if m and not plain[i]:
            byte_ids[int(m[1], 16)] = i
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte pieces")
    raw = [bytes([int(m[1], 16)]) if not p and (m := BYTE_PIECE.fullmatch(t)) else t.encode() if p else b"" for t, p in zip(texts, plain, strict=True)]
    kept = np.array([s if p else np.inf for s, p in zip(scores, plain, strict=True)])
    return Trie(*cells, np.where(np.isinf(kept), kept[np.isfinite(kept)].min(), kept), byte_ids, raw)


def load(path: str | None = None) -> Trie:
    return build_trie(*read_pieces(path or model_path()))


def lots(parts: list[bytes]) -> Iterator[list[bytes]]:
    """Parts in lots of about LOT bytes."""
    held: list[bytes] = []
    size = 0
    for part in parts:
        if held and size + len(part) > LOT:
            yield held
            held, size = [], 0
        held.append(part)
        size += len(part)
    if held:
        yield held


def segment(parts: list[bytes], trie: Trie) -> list[bytes]:
    """Ids of each part's best segmentation, as little-endian unsigned 32-bit bytes."""
    return [ids for lot in lots(parts) for ids in segment_lot(lot, trie)]


def segment_lot(parts: list[bytes], trie: Trie) -> list[bytes]:
    lengths = np.array([len(p) for p in parts], np.int64)
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.int32)
    offset = np.concatenate([[0], np.cumsum(lengths)])
    owner = np.repeat(np.arange(len(parts)), lengths)
    stop = offset[1:][owner]
    n = len(data)
    starts = np.flatnonzero((data & 0xC0) != 0x80)  # characters begin here
    ends = np.append(starts[1:], n)
    size_at = np.zeros(n, np.int64)
    size_at[starts] = ends - starts
    size_at = np.where(size_at > 0, size_at, 1)

    at, state = starts, np.zeros(len(starts), np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    single = np.zeros(n, bool)
    depth = 0
    while len(at):
        inside = at + depth < stop[at]
        at, state = at[inside], state[inside]
        step = trie.base[state] + data[at + depth]
        good = (trie.base[state] > 0) & (trie.check[step] == state)
        at, state = at[good], step[good].astype(np.int64)
        depth += 1
        ids = trie.value[state]
        hit = ids >= 0
        found.append((at[hit], np.full(int(hit.sum()), depth), ids[hit].astype(np.int64)))
        single[at[hit & (size_at[at] == depth)]] = True
    alone = starts[~single[starts]]
    found.append((alone, size_at[alone], np.full(len(alone), -1)))
    where, length, piece = (np.concatenate(c) for c in zip(*found, strict=True))
    gain = np.where(piece >= 0, trie.scores[piece], trie.unknown)

    begin = where - offset[owner[where]]
    order = np.lexsort((length, begin))
    where, length, piece, gain, begin = where[order], length[order], piece[order], gain[order], begin[order]
    cuts = np.flatnonzero(np.diff(begin)) + 1
    best = np.full(n + len(parts), -np.inf)  # by place in a part, its end included
    slot = where + owner[where]
    best[offset[:-1] + np.arange(len(parts))] = 0.0
    back_length, back_piece = np.zeros(len(best), np.int64), np.full(len(best), -1)
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(begin)], strict=True):
        source = slot[a:b]
        value = best[source] + gain[a:b]
        target = source + length[a:b]
        better = (value > best[target]) | ((value == best[target]) & (length[a:b] > back_length[target]))
        target = target[better]
        best[target] = value[better]
        back_length[target], back_piece[target] = length[a:b][better], piece[a:b][better]

    # Walk back from all ends at once; ids come out in reverse.
    here = offset[1:] + np.arange(len(parts))
    first = offset[:-1] + np.arange(len(parts))
    going = np.flatnonzero(here > first)
    taken: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(going):
        size = back_length[here[going]]
        taken.append((going, here[going] - size - going, back_piece[here[going]]))
        here[going] -= size
        going = going[here[going] > first[going]]
    part, start, ids = (np.concatenate(c) for c in zip(*taken, strict=True)) if taken else (np.empty(0, np.int64),) * 3
    order = np.argsort(start, kind="stable")  # starts rise with the part
    part, start, ids = part[order], start[order], ids[order]
    lost = np.flatnonzero(ids < 0)
    if len(lost):
        counts = np.ones(len(ids), np.int64)
        counts[lost] = size_at[start[lost]]
        spread = np.repeat(np.arange(len(ids)), counts)
        inner = np.arange(len(spread)) - np.repeat(np.cumsum(counts) - counts, counts)
        values = data[start[spread] + inner]
        values = np.where(values == FOREIGN_MARK[0], -1, values)
        ids = np.where(ids[spread] < 0, trie.byte_ids[values], ids[spread])
        foreign = np.flatnonzero(values < 0)
        part = part[spread]
        if len(foreign):
            mark = trie.byte_ids[np.frombuffer(MARK.encode(), np.uint8)]
            counts = np.ones(len(ids), np.int64)
            counts[foreign] = len(mark)
            spread = np.repeat(np.arange(len(ids)), counts)
            inner = np.arange(len(spread)) - np.repeat(np.cumsum(counts) - counts, counts)
            is_mark = np.isin(spread, foreign)
            ids, part = np.where(is_mark, mark[np.minimum(inner, len(mark) - 1)], ids[spread]), part[spread]
    raw = ids.astype("<u4").tobytes()
    edges = np.searchsorted(part, np.arange(len(parts) + 1)) * 4
    return [raw[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


class Encoder:
    def __init__(self, trie: Trie):
        self.trie = trie
        self.known: dict[bytes, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes."""
        mark = MARK.encode()
        split = [words_of(t.encode("utf-8", "replace").replace(mark, FOREIGN_MARK)) if t else [] for t in texts]
        new = list({w for words in split for w in words if w not in self.known})
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = list({w for words in split for w in words})
        self.known.update(zip(new, segment([mark + w for w in new], self.trie), strict=True))
        known = self.known
        return [b"".join([known[w] for w in words]) for words in split]


def words_of(text: bytes) -> list[bytes]:
    """What follows the first marker in each part of a text: further markers where spaces are repeated, then a word."""
    words = text.split(b" ")
    if b"" not in words:
        return words
    out, marks = [], b""
    for w in words:
        if w:
            out.append(marks + w)
            marks = b""
        else:
            marks += MARK.encode()
    return out + ([marks[: -len(MARK.encode())]] if marks else [])


def decode(ids: bytes, trie: Trie) -> str:
    """The text of ids."""
    spoken = trie.spoken
    found = np.frombuffer(ids, "<u4")
    # Some ids at a time, so that a long text is not a list of all its pieces at once.
    raw = b"".join([b"".join([spoken[i] for i in found[a : a + 65_536].tolist()]) for a in range(0, len(found), 65_536)])
    return raw[1:].decode("utf-8", "replace")


def encoder(shared: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(Trie(*shared.value))
        for batch in text_slices(batches, most=SLICE):
            ids = coder.encode(batch.column("text").to_pylist())
            columns = [*batch.columns, pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "ids", "n_ids"])

    return run


def decoder(shared: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(*shared.value)
        for batch in text_slices(batches, "ids", SLICE):
            texts = [decode(x or b"", trie) for x in batch.column("ids").to_pylist()]
            columns = [*batch.columns, pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "text"])

    return run


def encode(docs: DataFrame, trie: Trie) -> DataFrame:
    """``docs`` with ``ids`` (little-endian unsigned 32-bit) and ``n_ids``. The trie's size is the vocabulary's."""
    docs = docs.drop("ids", "n_ids")
    fields = [*docs.schema.fields, T.StructField("ids", T.BinaryType()), T.StructField("n_ids", T.LongType())]
    shared = docs.sparkSession.sparkContext.broadcast(trie.parts())
    return docs.mapInArrow(encoder(shared), T.StructType(fields))


def decode_rows(encoded: DataFrame, trie: Trie) -> DataFrame:
    """``encoded`` with the ``text`` of its ``ids``."""
    encoded = encoded.drop("text")
    fields = [*encoded.schema.fields, T.StructField("text", T.StringType())]
    shared = encoded.sparkSession.sparkContext.broadcast(trie.parts())
    return encoded.mapInArrow(decoder(shared), T.StructType(fields))
