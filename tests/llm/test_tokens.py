from __future__ import annotations

import zlib

import numpy as np
import pytest

from tickloom.llm import packing, tokenfile, tokens
from tickloom.llm.common import shared_path, table

SF = "/root/testdata/sf0.001"
ODD = [
    "", None, " a  b\n\n c ", "don't\xa0x y\x1c z\x85w  ", "a\t\tb \n d<|endoftext|>e", "  ", "\n", " ", "a\nb's it's 12,3 x\n(q)", "a\n",
    "x \ny", "word " * 5000 + "end", "z" * 20_000, "é漢字 😀 ñandú\nß",
]


def whole_ids(text):
    from tokenizers import Tokenizer

    if not hasattr(whole_ids, "tokenizer"):
        whole_ids.tokenizer = Tokenizer.from_file(tokens.tokenizer_path())
        whole_ids.tokenizer.encode_special_tokens = True
    return whole_ids.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_long_words_and_words_of_one_hash_go_to_the_library_whole(monkeypatch):
    texts = ["a " + "x" * n + " b" for n in (7, 8, 9, 199, 200, 201, 202, 5000)] + ["é" * 100 + " c", "é" * 101, "12345678 123456789 1234567", "a\na a"]
    coder = tokens.WordEncoder(tokens.tokenizer_json())
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == [whole_ids(t) for t in texts]
    monkeypatch.setattr(tokens, "mixed", lambda x: x & np.uint64(1))
    clashing = tokens.WordEncoder(tokens.tokenizer_json())
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in clashing.encode(texts)] == [whole_ids(t) for t in texts]
    for some in (["a b"], ["b a"], ["c"]):  # words of one hash in different slices
        assert [np.frombuffer(x, "<u4").tolist() for x in clashing.encode(some)] == [whole_ids(t) for t in some]


@pytest.mark.parametrize("hashed", [1, 40, 3000])
def test_lots_change_nothing(rows, monkeypatch, hashed):
    monkeypatch.setattr(tokens, "HASHED", hashed)
    some = [t for _, t in rows[:25]] + ODD
    got = tokens.WordEncoder(tokens.tokenizer_json()).encode(some, 7)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [whole_ids(t) + [7] for t in some]


@pytest.fixture(scope="module")
def rows(spark):
    given = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    return given + [(10_000 + i, t) for i, t in enumerate(ODD)]


def test_words_give_the_ids_of_the_whole_text(rows):
    encoder = tokens.WordEncoder(tokens.tokenizer_json())
    for _, t in rows:
        assert np.frombuffer(encoder.encode([t])[0], "<u4").tolist() == whole_ids(t)


SPACES = ["\xa0", "\t", "\r", "\x0b", "\x1c", "\x85", "\u1680", "\u180e", "\u2003", "\u200b", "\u2028", "\u202f", "\u3000", "\ufeff", " ", "\n"]
EDGES = [e for s in SPACES for e in (f"{s}a b", f"{s}{s}a b", f"a b{s}", f"a b{s}{s}", f"a\n{s}b", f"a\n{s}{s}b", f"a{s}\nb c", f"a{s} b", f"a {s}b", f"a {s}{s}b c", f"a{s}b")]


def test_white_space_at_edges_gives_the_ids_of_the_whole_text():
    """Other white space at the ends of texts, lines and words: a text alone, and all in one slice with plain ones."""
    for t in EDGES:
        assert np.frombuffer(encoder().encode([t])[0], "<u4").tolist() == whole_ids(t), repr(t)
    mixed = [x for e in EDGES for x in (e, "a b\nc the", "the\na word. b")]
    got = tokens.WordEncoder(tokens.tokenizer_json()).encode(mixed)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [whole_ids(t) for t in mixed]


def encoder():
    if not hasattr(encoder, "held"):
        encoder.held = tokens.WordEncoder(tokens.tokenizer_json())
    return encoder.held


def test_full_memory_changes_nothing(rows, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    encoder = tokens.WordEncoder(tokens.tokenizer_json())
    some = [t for _, t in rows[:60]]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(some, 0)] == [whole_ids(t) + [0] for t in some]
    assert len(encoder.place) <= 50


def test_file_gives_all_documents_back(spark, rows, monkeypatch):
    monkeypatch.setattr(tokenfile, "BLOCK_DOCUMENTS", 16)
    path = shared_path(spark, "tokens")
    tokenfile.write_tokens(spark.createDataFrame(rows[::-1], "doc_id long, text string"), path, shards=3)
    got = sorted(tokenfile.read_tokens(spark, path).collect())
    start = 0
    for r, (doc_id, text) in zip(got, sorted(rows, key=lambda x: x[0]), strict=True):
        ids = np.array([*whole_ids(text), 0], "<u4").tobytes()
        assert (r.doc_id, r.start, r.n_tokens) == (doc_id, start, len(ids) // 4)
        assert zlib.crc32(r.ids) == zlib.crc32(ids)
        start += r.n_tokens
    few = {r.doc_id: r for r in tokenfile.read_tokens(spark, path, [3, 10_007, 99_999]).collect()}
    assert few == {r.doc_id: r for r in got if r.doc_id in (3, 10_007)}
    assert len(spark.read.parquet(f"{path}/dictionary").first().dictionary) > 1000


def test_file_of_nulls_repeats_and_nothing(spark):
    path = shared_path(spark, "tokens")
    rows = [(None, "a"), (5, "b"), (5, "b"), (5, None), (None, None)]
    tokenfile.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path)
    got = tokenfile.read_tokens(spark, path).collect()
    assert sorted((r.doc_id or -1, bytes(r.ids)[:-4]) for r in got) == sorted((d or -1, np.array(whole_ids(t), "<u4").tobytes()) for d, t in rows)
    assert sorted(r.start for r in got)[0] == 0 and all(r.start < 4 for r in got if r.doc_id is None)
    path = shared_path(spark, "tokens")
    tokenfile.write_tokens(spark.createDataFrame([], "doc_id long, text string"), path)
    assert tokenfile.read_tokens(spark, path).collect() == []


def test_wrong_dictionary_is_refused(spark):
    import pyarrow as pa

    row = {"shard": 0, "block": 0, "before": 0, "start": 0, "doc_ids": [1], "n_tokens": [1], "offsets": [0, 1], "dict_hash": "x", "frames": b"y"}
    with pytest.raises(ValueError, match="dictionary"):
        list(tokenfile.reader(b"", None)(iter([pa.RecordBatch.from_pylist([row])])))


def check_packing(pieces, rows, most):
    sequences, documents = {}, {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
        documents.setdefault(p.doc_id, []).append(p)
    for doc_id, text in rows:
        own = sorted(documents[doc_id], key=lambda p: p.start)
        ids = np.concatenate([np.frombuffer(p.ids, "<u4") for p in own]).tolist()
        assert ids == [*whole_ids(text), 1] and {p.doc_tokens for p in own} == {len(ids)}
        assert [p.start for p in own] == [0, *np.cumsum([p.length for p in own])[:-1].tolist()]
    lengths = []
    for i in range(len(sequences)):
        at = 0
        for p in sorted(sequences[i], key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        lengths.append(at)
    assert all(n <= most and n & (n - 1) == 0 for n in lengths)
    total = sum(lengths)
    assert sorted(lengths, reverse=True) == lengths and lengths.count(most) >= total // most


@pytest.mark.parametrize("shards", [1, 5])
def test_packing_keeps_every_id_once(spark, rows, shards):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check_packing(packing.pack(docs, shards=shards).collect(), rows, 2048)


def test_packing_small_sequences_nulls_and_nothing(spark):
    rows = [(i, "tick tock " * i) for i in range(20)] + [(30, None)]
    check_packing(packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), most=16).collect(), rows, 16)
    got = packing.pack(spark.createDataFrame([(None, None), (None, ""), (1, "a"), (1, "a")], "doc_id long, text string")).collect()
    assert sum(p.length for p in got) == 2 + 2 * (len(whole_ids("a")) + 1)
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_hilbert_curve_visits_neighbours():
    n = 8
    points = np.stack(np.meshgrid(*[np.arange(n)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    keys = packing.hilbert_key(points, 3)
    assert sorted(keys.tolist()) == list(range(n**3))
    walk = points[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_like_documents_are_near_on_the_curve():
    a, b = "the cat sat on the mat and slept ", "le chat dort sur la table et mange "
    texts = [a * k for k in (10, 12, 14)] + [b * k for k in (10, 12, 14)]
    ids = [np.array(whole_ids(t), "<u4") for t in texts]
    order = np.argsort(packing.curve_places(ids), kind="stable").tolist()
    assert {frozenset(order[:3]), frozenset(order[3:])} == {frozenset((0, 1, 2)), frozenset((3, 4, 5))}
