"""A corpus from documents: languages we know, good text, one of each group of near copies, packed sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import language, nearcopies, quality
from tickloom.llm.common import keep, stored, table, with_ids, working_tables
from tickloom.llm.queries import learnable, packed, trusted_ids

#: The least probability of a language for a text to stay.
SURE = 0.4


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no language with probability SURE, go; none if no language could be learned."""
    names = ("_language", "_probability")
    model = language.train(learnable(docs))
    if model is None:
        return docs
    judged = language.predict(docs, model, names)
    return judged.filter((F.col(names[0]) != language.UNKNOWN) & (F.col(names[1]) >= SURE)).select(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows beyond their language's limits go, each judged by itself, whatever ids repeat."""
    return quality.accepted(docs, trusted_ids(spark, sf_dir))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays, in one row; rows without id stay.

    Where ids repeat, each row is a document of its own: of equal ids the one with the smaller hash of its text is first.
    """
    with working_tables(spark):
        known, unknown = docs.filter("doc_id is not null"), docs.filter("doc_id is null")
        if not nearcopies.repeats_ids(known):
            gone = keep(stored(nearcopies.near_copies(docs).filter("not kept").select("doc_id"), "copies"))
            return with_ids(docs, gone, "left_anti").select(*docs.columns)
        order = ["doc_id", "_tie"]
        placed = known.withColumn("_tie", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)
        rows = keep(stored(placed.drop("_tie").withColumn("_row", F.monotonically_increasing_id()), "rows"))
        copies = nearcopies.near_copies(rows.select(F.col("_row").alias("doc_id"), "text"))
        gone = keep(stored(copies.filter("not kept").select(F.col("doc_id").alias("_row")), "copies"))
        return with_ids(rows, gone, "left_anti", "_row").select(*docs.columns).unionByName(unknown)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("quality", good_quality),
    ("near_copies", without_copies),
    ("packing", packing),
]

#: Models and tokenizers are beyond SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
