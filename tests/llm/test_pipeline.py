from __future__ import annotations

import subprocess
import sys
import zlib

import corpus_pipeline
from test_copies import plain_copies

from tickloom.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_copies", "packing"]
    labels = {r.doc_id: r for r in table(spark, SF, "labels").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.schema == docs.schema
        left = {r.doc_id for r in out.collect()}
        before = docs.collect()
        if name == "near_copies":
            want = {i for i, _, _, kept in plain_copies([(r.doc_id, r.text) for r in before]) if kept}
            assert left == want
        else:
            clean = [r.doc_id for r in before if r.doc_id in labels and labels[r.doc_id].quality == 1]
            assert sum(d in left for d in clean) / len(clean) > 0.97
        docs = spark.createDataFrame(out.collect(), docs.schema)
    pieces = corpus_pipeline.packing(spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.collect()}


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, component_id string"
    known = next(i for i in range(2, 100) if zlib.crc32(str(i).encode()) % 3 != 1)  # its language may be learned
    rows = [(1, None, None, None, None, "s", "c"), (None, "the to of and in is", "en", None, 5, "s", "c"), (known, "the to of and", "en", "a", 1, "s", "c"), (known, "the to of and", "en", "a", 1, "s", "c"), (100, "12", None, None, None, None, None)]
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if stage is not corpus_pipeline.packing:
                assert out.columns == docs.columns
                docs = spark.createDataFrame(out.collect(), schema)
        if given:
            assert sorted((r.doc_id or 0) for r in docs.collect()) == [0, known]


def test_entry_works_without_the_folder(tmp_path):
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('tickloom.llm'):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert not any(k.startswith('op1') or k == 'pipeline' for k in e.queries()) and e.oracle_sql()\n"
    )
    root = str(__import__("pathlib").Path(__file__).resolve().parents[2])
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_rows_with_one_id_are_documents_of_their_own(spark):
    """Every distinct clean text survives exactly once, whatever ids repeat."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    texts = {k: " ".join(f"{k}{i % 37}x{i}" for i in range(60)) for k in "ABCD"}
    near = texts["B"] + " more"
    rows = [(1, texts["A"]), (1, texts["B"]), (2, texts["A"]), (3, texts["B"]), (4, near), (5, texts["C"]), (5, texts["C"]), (None, texts["D"]), (6, None), (6, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], schema)
    out = [(r.doc_id, r.text) for r in corpus_pipeline.without_copies(spark, docs, SF).collect()]
    assert sorted(t for _, t in out if t) == sorted(texts.values())
    assert {i for i, t in out if t} == {1, 5, None} and sorted(str(t) for i, t in out if i == 6) == ["", "None"]
    found = {(r.doc_id, r.n_shingles): r for r in __import__("tickloom.llm.nearcopies", fromlist=["x"]).near_copies(docs).collect()}
    assert len(found) == 7  # one row a document id, the null one included


def test_rejected_rows_take_no_others_with_them(spark):
    """Of two rows with one id, junk goes and the clean one stays, all columns as they were."""
    docs = table(spark, SF, "documents")
    good = table(spark, SF, "labels").where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")
    unlabelled = docs.join(good, "doc_id", "left_anti")  # what is trusted is learned
    kept = {r.doc_id for r in corpus_pipeline.good_quality(spark, docs, SF).collect()}
    some = [r for r in unlabelled.collect() if r.doc_id in kept][:5]
    junk = spark.createDataFrame([(r.doc_id, "zq xk " * 400, r.lang, "junk", 7) for r in some], docs.schema)
    out = corpus_pipeline.good_quality(spark, docs.unionByName(junk), SF)
    rows = out.collect()
    assert out.schema == docs.schema and {r.doc_id for r in some} <= {r.doc_id for r in rows if r.source != "junk"}
    assert not any(r.source == "junk" for r in rows)
    whole = {tuple(r) for r in docs.collect()}
    assert all(tuple(r) in whole for r in rows)
