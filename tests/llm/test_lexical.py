from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from tickloom.llm import lexical

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    texts = {}
    for i, t in items:
        if i is not None and t is not None:
            texts[i] = min(texts.get(i, t), t)
    out = []
    for item, text in texts.items():
        scored = []
        for doc, c in counted:
            m = 25 + 75 * sum(c.values()) * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text)
                if c[t]
            )
            if score > 0 and doc is not None:
                scored.append((-score, doc))
        out += [(item, r, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def found(spark, docs, items, k=10, **sizes):
    df = lexical.rank(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), k, **sizes)
    return sorted(tuple(r) for r in df.collect())


def corpus(seed=1):
    rng = random.Random(seed)
    words = ["the", "of", "Él", "ähre", "日本", "x1", "42"] + ["".join(rng.choices("abcde", k=rng.randint(1, 4))) for _ in range(400)]

    def text(n):
        return "".join(w + rng.choice([" ", "-", "\n", "_", ", "]) for w in rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=n))

    docs = [(i, text(rng.choice([1, 3, 10, 40, 200, 1500]))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(60)] + [(5, docs[5][1]), (6, "other text"), (None, text(30)), (2000, None), (2001, ""), (2002, " .,;")]
    items = [(i, text(rng.choice([1, 5, 30]))) for i in range(40)] + [(50, None), (51, "--"), (52, "unseenword"), (None, "the of"), (3, "The the THE"), (53, docs[7][1])]
    return docs, items


@pytest.mark.parametrize("sizes", [{}, {"bucket_terms": 500, "first": 1, "growth": 2}, {"block_bytes": 300, "bucket_terms": 3000}])
def test_equals_plain_ranking(spark, sizes):
    docs, items = corpus()
    assert found(spark, docs, items, **sizes) == plain(docs, items)


def test_few_documents_ties_and_empty(spark):
    docs, items = [(3, "a b"), (1, "a b"), (2, "a c")], [(0, "a b"), (1, "c c")]
    assert found(spark, docs, items) == plain(docs, items)
    assert found(spark, docs, items, k=1) == plain(docs, items, k=1)
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == []
    assert found(spark, [(1, None)], items) == []


def test_one_document_holds_most_terms(spark):
    docs = [(0, "alpha beta " * 30_000), (1, "alpha"), (2, "beta gamma")]
    items = [(0, "alpha"), (1, "beta gamma"), (2, "alpha beta gamma")]
    assert found(spark, docs, items, bucket_terms=1) == plain(docs, items)


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 1, "x", 2.0)], DOCS + ", n int, terms string, length double")
    items = spark.createDataFrame([(1, "a", 9, 9)], ITEMS + ", doc_id int, rank int")
    assert [tuple(r) for r in lexical.rank(docs, items).collect()] == plain([(1, "a b")], [(1, "a")])


def test_buckets_and_documents_are_left_out():
    """Once an item has k good hits, short buckets and documents without its heavy terms are not scored."""
    import pyarrow as pa

    weight = {0: 5000, 1: 100}
    item = lexical.Item.of(0, {0: 1, 1: 1}, weight)
    assert item.terms == [0, 1] and item.heavy == 1
    rows = {"doc_id": [1, 2], "terms": [[0], [1]], "impacts": [[900], [900]]}
    bucket = pa.table(rows, pa.schema([("doc_id", pa.int64()), ("terms", pa.list_(pa.int32())), ("impacts", pa.list_(pa.int64()))]))
    item.best = 4_500_000
    assert lexical.bucket_search([item], 10)(bucket).to_pylist() == [{"item_id": 0, "doc_id": 1, "score": 4_500_000}]
    item.best = 10_000_000
    assert lexical.bucket_search([item], 10)(bucket).num_rows == 0
