from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from tickloom.llm import components, nearcopies, vectorcopies


def reach(ids, links):
    best = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(best[a], best[b])
            if (best[a], best[b]) != (low, low):
                best[a] = best[b] = low
                changed = True
    return best


def test_components_equal_plain(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 6000 + i) for i in range(50)]
    got = components.components(spark.createDataFrame([*links, (None, 4), (7, None), (1, 1)], "a long, b long")).collect()
    real = [(a, b) for a, b in links if a != b]
    assert {r.id: r.component for r in got} == reach({x for e in real for x in e}, real)
    assert len(got) == len({r.id for r in got})
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def text_set(text):
    lower = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain_copies(rows):
    sets = {i: text_set(t) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    best = reach(ids, links)
    return sorted((i, len(sets[i]), best[i], best[i] == i) for i in ids)


def corpus(seed=5):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5)))
    rows = []
    for _ in range(25):  # groups around an original, some a chain, at all similarities
        base = [word() for _ in range(rng.randint(30, 150))]
        for _ in range(rng.randint(2, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 14))):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
            if rng.random() < 0.3:
                base = copy
    shared = " ".join(word() for _ in range(60))
    rows += [shared + " " + " ".join(word() for _ in range(rng.randint(5, 60))) for _ in range(40)]
    rows += ["one two", "ONE\ttwo", "one two ", "", " \n", "x", "X", "É a b c d e", "é a b c d e", "a b c d e", "A  b c\x0bd\x0ce"]
    rng.shuffle(rows)
    return [(3 * i + 1, t) for i, t in enumerate(rows)] + [(9000, None), (9001, " ".join(word() for _ in range(30_000)))]


@pytest.mark.parametrize("block", [512, 3])
def test_near_copies_equal_plain(spark, block, monkeypatch):
    monkeypatch.setattr(nearcopies, "BLOCK", block)
    rows = corpus()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, rep string, n_shingles int")
    assert sorted(tuple(r) for r in nearcopies.near_copies(df).collect()) == plain_copies(rows)


def test_family_around_an_original(spark):
    """Copies like the original, not like each other, whose smallest id isn't the original's."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    rows = [(500, " ".join(base))]
    for i in range(80):
        copy = list(base)
        for k in rng.sample(range(0, 200, 8), 6):
            copy[k] = f"c{i}.{k}"
        rows.append((i, " ".join(copy)))
    assert sorted(tuple(r) for r in nearcopies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == plain_copies(rows)


def test_repeated_and_missing_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, None), (3, "")]
    got = nearcopies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in got) == [
        (0, 0, 0, True), (0, 2, 0, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True),
    ]
    assert nearcopies.near_copies(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_pieces_of_a_long_text(monkeypatch):
    texts = [t for _, t in corpus()]
    together = nearcopies.shingle_sets(texts)
    monkeypatch.setattr(nearcopies, "PIECE", 20)
    assert all((a == nearcopies.shingle_sets([t])[0]).all() for a, t in zip(together, texts, strict=True))


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(2)
    times, salts = nearcopies.odd_numbers(nearcopies.SAMPLES, 2), nearcopies.odd_numbers(nearcopies.SAMPLES, 3)
    errors = []
    for _ in range(60):
        x = rng.integers(0, 2**63, 700).astype(np.uint64)
        rows = np.stack([nearcopies.minima(s, times, salts) for s in (x[:600], x[100:])])
        a, b = nearcopies.sketches(rows)
        differing = np.bitwise_count(a ^ b).sum()
        errors.append(float(nearcopies.similarity(np.array([differing]))[0]) - 500 / 700)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.045


def plain_cosine(a, b):
    dot, na, nb = (math.fsum(x * y for x, y in zip(u, v, strict=True)) for u, v in ((a, b), (a, a), (b, b)))
    return dot / (math.sqrt(na) * math.sqrt(nb))


def plain_vectors(rows, cosine=0.9):
    unit = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            unit[i] = min(unit.get(i, v), v)
    for i, v in unit.items():
        x = np.array(v, np.float32).astype(np.float64)
        unit[i] = (x / np.abs(x).max()).tolist()
    ids = sorted({i for i, _ in rows if i is not None})
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if a in unit and b in unit and len(unit[a]) == len(unit[b]) and plain_cosine(unit[a], unit[b]) >= cosine]
    best = reach(ids, links)
    n = {i: 0 for i in ids}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return sorted((i, n[i], best[i], best[i] == i) for i in ids)


def vectors(seed=4):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(30):
        base = rng.normal(size=16)
        for _ in range(rng.integers(1, 12)):
            rows.append((base + rng.normal(size=16) * rng.choice([0.02, 0.2, 0.3, 0.4])).tolist())
    rows += [[1.0] + [0.0] * 15] * 40 + [[1.0, 0.05] + [0.0] * 14] * 30
    rows += [None, [0.0] * 16, [float("nan")] * 16, [None] + [1.0] * 15, [float("inf")] * 16, [], [1.0, 2.0], [2.0, 4.0], [1e38] * 16, [1e-30] * 16]
    rng.shuffle(order := list(range(len(rows))))
    return [(int(i), rows[i]) for i in order]


@pytest.mark.parametrize("size", [1024, 5])
def test_near_vectors_equal_plain(spark, size, monkeypatch):
    monkeypatch.setattr(vectorcopies, "BLOCK", size)
    monkeypatch.setattr(vectorcopies, "MATES", 100)
    rows = vectors()
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "vec_id long, embedding array<float>, weight int, key string")
    assert sorted(tuple(r) for r in vectorcopies.near_vectors(df).collect()) == plain_vectors(rows)


def test_near_vectors_repeats_nulls_and_nothing(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, None), (3, [1.0, 0.2])]
    got = vectorcopies.near_vectors(spark.createDataFrame([*rows, (None, [1.0, 0.0])], schema)).collect()
    assert sorted(tuple(r) for r in got if r.vec_id is not None) == plain_vectors(rows)
    assert [tuple(r) for r in got if r.vec_id is None] == [(None, 0, None, True)]
    assert vectorcopies.near_vectors(spark.createDataFrame([], schema)).collect() == []


def test_no_link_below_the_threshold(spark):
    """Cosines a little above, at and below 0.9, of doubles."""
    rows, want = [(0, [1.0, 0.0])], {}
    for i, c in enumerate([0.9 - 3e-13, 0.9 - 1e-12, 0.9 + 3e-13, 0.9 + 1e-9, 0.9 - 1e-9, 0.9 - 2e-16], 1):
        v = [c, math.sqrt(1 - c * c)]
        # Each turned by an angle of its own, so that no two of them are near but through the first.
        rows.append((i, v if i % 2 else [v[0], -v[1]]))
        want[i] = plain_cosine(rows[0][1], rows[i][1]) >= 0.9
    for i, linked in want.items():
        got = vectorcopies.near_vectors(spark.createDataFrame([rows[0], rows[i]], "vec_id long, embedding array<double>")).collect()
        assert {r.n_links for r in got} == {int(linked)}, i
    assert set(want.values()) == {True, False}


def test_hashing_finds_pairs_at_the_threshold(spark):
    """Recall of pairs whose cosine is just above 0.9, with several directions a table."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(1500):
        x = rng.normal(size=64)
        x /= np.linalg.norm(x)
        y = rng.normal(size=64)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        rows += [(2 * i, x.tolist()), (2 * i + 1, (0.902 * x + np.sqrt(1 - 0.902**2) * y).tolist())]
    directions, tables, _ = vectorcopies.plan(200_000)
    assert directions >= 5 and tables < 60
    schema = "vec_id long, embedding array<float>"
    vectorcopies_plan = vectorcopies.plan
    try:
        vectorcopies.plan = lambda n, cosine=0.9: vectorcopies_plan(200_000, cosine)
        got = vectorcopies.near_vectors(spark.createDataFrame(rows, schema)).collect()
    finally:
        vectorcopies.plan = vectorcopies_plan
    assert sum(r.n_links > 0 for r in got) / len(rows) > 0.99
