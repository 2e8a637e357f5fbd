"""Keyed tables that take upserts without rewriting: sorted runs in levels, merged as they gather.

Every ``put`` adds a run of the changed rows at level 0, sorted by key. Once a level has ``FANOUT`` runs they become one run
of the next level, with only the newest row of a key. So after n puts a level has fewer than ``FANOUT`` runs, there are at
most 1 + log(n) / log(FANOUT) levels, and a row is rewritten at most once a level. A read takes the newest row of each key
over all runs: it reads each key at most ``runs`` times, however many puts there were.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.sources import versions
from tickloom.sources.tables import latest_versions

#: Runs of a level that are merged into one of the next.
FANOUT = 4
LEVEL = "level"


def runs(version: versions.Version | None) -> dict[int, dict[str, list[versions.File]]]:
    """Files of each run, by level."""
    out: dict[int, dict[str, list[versions.File]]] = {}
    for f in version.files if version else ():
        run = f.path.split("/", 1)[0]
        out.setdefault(int(f.partition[LEVEL]), {}).setdefault(run, []).append(f)
    return out


def next_run(spark: SparkSession, path: str) -> int:
    """A number above that of every run so far, for rows to carry as their version."""
    version = versions.current(spark, path)
    return version.number + 1 if version else 1


def put(df: DataFrame, path: str, keys: Sequence[str], version: str, fanout: int = FANOUT) -> None:
    """Add rows, one a key; those with a higher ``version`` replace older ones of their key. Runs are merged when due."""
    rows = df.hint("rebalance").withColumn(LEVEL, F.lit(0)).sortWithinPartitions(*keys)
    versions.append(rows, path, [LEVEL])
    level = 0
    while merge(df.sparkSession, path, keys, version, level, fanout):
        level += 1


def merge(spark: SparkSession, path: str, keys: Sequence[str], version: str, level: int, fanout: int = FANOUT) -> bool:
    """Make one run of the next level of the runs of a level, if there are ``fanout`` of them."""
    seen = versions.current(spark, path)
    here = runs(seen).get(level, {})
    if len(here) < fanout:
        return False
    files = [f for run in here.values() for f in run]
    rows = versions.read_files(spark, path, files, seen.schema)
    newest = latest_versions(rows.drop(LEVEL), keys, F.col(version))
    merged = newest.select(*[c for c in rows.columns if c != LEVEL]).hint("rebalance", *keys).sortWithinPartitions(*keys)
    new = versions.write_files(merged.withColumn(LEVEL, F.lit(level + 1)), path, [LEVEL], versions.COMPACTED)
    gone = {f.path for f in files}

    def change(old: versions.Version) -> versions.Version:
        if not gone <= {f.path for f in old.files}:
            raise versions.Conflict(f"{path}: another writer merged these runs")
        return replace(old, files=(*[f for f in old.files if f.path not in gone], *new))

    versions.commit(spark, path, change)
    return True


def read(spark: SparkSession, path: str, keys: Sequence[str], version: str) -> DataFrame:
    """The newest row of each key."""
    rows = versions.read(spark, path).drop(LEVEL)
    return latest_versions(rows, keys, F.col(version)).select(*rows.columns)
