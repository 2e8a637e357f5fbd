"""Connected components of links, by rounds of alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored

#: More rounds than any graph needs: each at least halves the longest path, about.
ROUNDS = 100


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the smallest id that links reach.

    Links stay distributed: a round groups by id with a partial minimum and joins it back; each round is written to
    the shared folder. Rows with nulls and links of an id to itself count for nothing; links may repeat.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .filter("a is not null and b is not null and hi > lo")
        .distinct(),
        "edges",
    )
    mark = None
    for _ in range(ROUNDS):
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(smallest, "u").filter("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(F.explode(F.array(F.struct("lo", "m"), F.struct(F.col("hi").alias("lo"), "m"))).alias("e"))
        edges = stored(small.select(F.col("e.lo").alias("hi"), F.col("e.m").alias("lo")).filter("hi <> lo").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    ids = edges.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return ids.unionByName(edges.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct())
