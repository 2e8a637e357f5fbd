from __future__ import annotations

import random
import re

import pytest

from tickloom.llm import licenses

SCHEMA = "doc_id long, text string"


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def spans(text, listed):
    """Diagonals by plain loops over all places of a text and a template."""
    w, out = words(text), []
    for t in listed:
        on = {}
        for i in range(len(w) - t.k + 1):
            for p in range(len(t.words) - t.k + 1):
                if tuple(w[i : i + t.k]) == t.words[p : p + t.k]:
                    on.setdefault(i - p, []).append((i, p))
        groups = []
        for d in sorted(on):
            if groups and d - groups[-1][0] <= t.gap:
                groups[-1] = (d, groups[-1][1] + on[d])
            else:
                groups.append((d, on[d]))
        for _, votes in groups:
            covered = {p + j for _, p in votes for j in range(t.k)}
            first, last = min(i for i, _ in votes), max(i for i, _ in votes) + t.k - 1
            share = len(covered) / max(len(t.words), last - first + 1)
            if share >= t.share:
                out.append((t.label, t.number, t.base, first, last, share))
    return sorted(out)


def plain(rows, listed):
    out = []
    for i, text in rows:
        s = spans(text, listed)
        starts = [x[3] for x in s if x[2]]
        joined = [",".join(sorted({x[0] for x in s if x[2]})), ",".join(sorted({x[0] for x in s}))]
        ends = (min(starts), max(starts)) if starts else (None, None)
        out.append((i, len(words(text)), len(starts), *ends, *joined, max([x[5] for x in s], default=0.0)))
    return out


def found(spark, rows, schema=SCHEMA, **kw):
    return [tuple(r) for r in licenses.summary(licenses.scan(spark.createDataFrame(rows, schema), **kw)).collect()]


def key(row):
    return tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in row)


def altered(text, rng):
    w = text.split()
    for _ in range(rng.randint(0, 8)):
        i = rng.randrange(len(w))
        w[i : i + 1] = rng.choice([[], ["other"], [w[i], "more"]])
    return " ".join(w)


def corpus():
    rng = random.Random(4)
    notices = [t for _, t in licenses.OWN if len(t) > 100]
    rows = []
    for i in range(150):
        parts = [" ".join(rng.choices(["the", "license", "mit", "general", "public", "apache", "of", "cc", "by", "4", "0", "software", "é"], k=rng.randint(0, 40)))]
        parts += [altered(rng.choice(notices), rng) for _ in range(rng.randint(0, 2))]
        rng.shuffle(parts)
        rows.append((i, rng.choice(["\n", " - ", "_"]).join(parts)))
    return rows


EDGES = [
    (1000, "Released under the MIT License."),
    (1001, "mit-license MIT\tLICENSE mit licenses"),
    (1002, "GNU General Public License and general public  general public license"),
    (1003, "Licensed under CC BY-NC 4.0."),
    (1004, None),
    (1005, ""),
    (1006, "..."),
    (1007, "one"),
    (1008, "éMIT LICENSE MIT LICENSEé"),
    (None, "apache license"),
    (1009, "mit license " * 20_000),
]


def test_equals_plain_votes(spark):
    rows = corpus() + EDGES
    got, want = found(spark, rows), plain(rows, licenses.templates())
    assert sorted(got, key=key) == sorted(want, key=key)
    by_id = {r[0]: r for r in got}
    assert by_id[1000][2:] == (1, 3, 3, "mit", "mit", 1.0)
    assert by_id[1002][2:5] == (2, 1, 7)
    assert by_id[1003][5:7] == ("", "cc-by-nc")
    assert by_id[1009][1:5] == (40_000, 20_000, 0, 39_998)


def test_notices_are_known_when_altered(spark):
    rng = random.Random(8)
    notices = [(label, t) for label, t in licenses.OWN if len(t) > 100]
    rows = [(i, altered(t, rng)) for i, (_, t) in enumerate(notices)]
    for row, (label, _) in zip(sorted(found(spark, rows)), notices, strict=True):
        assert label in row[6].split(","), row


def test_repeated_rows_empty_table_and_clashing_columns(spark):
    rows = [(1, "mit license"), (1, "mit license"), (1, "apache license"), (None, "x"), (None, None)]
    assert sorted(found(spark, rows), key=key) == sorted(plain(rows[1:], licenses.templates()), key=key)
    assert found(spark, []) == []
    wide = [(1, "mit license", 3, "x", 4, "y")]
    names = ", n int, words string, template int, labels string"
    assert found(spark, wide, SCHEMA + names) == plain(wide[:1] and [(1, "mit license")], licenses.templates())


def test_own_templates(spark):
    listed = licenses.templates([("z", "zeta license")], [])
    assert found(spark, [(1, "Zeta License, mit license")], listed=listed) == [(1, 4, 1, 0, 0, "z", "z", 1.0)]
    assert found(spark, [(1, "mit license")], listed=[]) == [(1, 2, 0, None, None, "", "", 0.0)]
    with pytest.raises(ValueError):
        licenses.templates([("one", "word")])
