"""Table readers and writers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.constants import ENVELOPE_SCHEMA, GOLD_SCHEMA, SILVER_SCHEMA
from tickloom.functions.canonical import packed, unpacked
from tickloom.session import pin_utc
from tickloom.sources import versions

QUALITY = "quality"
Keep = Callable[[dict[str, str | None]], bool]


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Read a table by its newest version, or plain Parquet. With a schema nothing is inferred, so partition values such
    as ``001`` stay text."""
    if versions.numbers(spark, path):
        return versions.read(spark, path, schema)
    reader = pin_utc(spark).read
    return (reader.schema(schema) if schema else reader).parquet(path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, ENVELOPE_SCHEMA + ", dt date, token string")


def within(column: str, first: date | None, last: date | None) -> Keep:
    """Chooses partitions by days, both ends included; None is open."""

    def keep(partition: dict[str, str | None]) -> bool:
        day = partition.get(column)
        return day is not None and (first is None or day >= str(first)) and (last is None or day <= str(last))

    return keep


def read_silver(spark: SparkSession, path: str, quality: str = "valid", keep: Keep | None = None) -> DataFrame:
    schema = SILVER_SCHEMA + f", quarantine_reasons array<string>, {QUALITY} string"
    if keep is None:
        df = read_table(spark, path, schema)
    else:
        df = versions.read(spark, path, schema, keep=lambda p: p.get(QUALITY) == quality and keep(p))
    df = df.where(F.col(QUALITY) == quality).drop(QUALITY)
    return df.drop("quarantine_reasons") if quality == "valid" else df


def read_gold(spark: SparkSession, path: str, keep: Keep | None = None) -> DataFrame:
    return read_table(spark, path, GOLD_SCHEMA) if keep is None else versions.read(spark, path, GOLD_SCHEMA, keep=keep)


def table_files(df: DataFrame) -> DataFrame:
    """Files behind a table, with their sizes."""
    return df.select("_metadata.file_path", "_metadata.file_size").distinct()


def latest_partition(df: DataFrame, column: str = "dt") -> DataFrame:
    """Rows of the newest partition. The subquery's value prunes the scan; an empty table stays empty."""
    return df.where(F.col(column) == df.agg(F.max(column).alias(column)).scalar())


def write_partitioned(
    df: DataFrame, path: str, partition_by: Sequence[str], *, append: bool = False, sort_by: Sequence[str] = (),
    only: tuple[str, Sequence[str]] | None = None, note: tuple[str, str] | None = None,
) -> versions.Version:
    """Write with even files: small partitions share a task, large ones are split (AQE rebalance).

    Without ``append`` the whole table is replaced, or, given ``only`` (a partition column and its values), those
    partitions, also where ``df`` no longer has rows for them. A write is seen whole or not at all, so a re-run is
    idempotent, a failed one leaves the table as it was, and ``df`` may read the table. An append with a ``note``
    that the table has already does nothing.
    """
    df = unpacked(packed(df).hint("rebalance", *partition_by))
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    if append:
        return versions.append(df, path, partition_by, note)
    return versions.overwrite(df, path, partition_by, only)


def append_closed(
    df: DataFrame, closed: Column, path: str, partition_by: Sequence[str], sort_by: Sequence[str], note: tuple[str, str]
) -> tuple[int, DataFrame]:
    """Append the rows that are ``closed`` (never null), with even files, and write the others apart in the same job; see
    ``versions.append_apart``."""
    final = unpacked(packed(df.where(closed)).hint("rebalance", *partition_by))
    return versions.append_apart(final, df.where(~closed), path, partition_by, sort_by, note)


def write_bronze(envelopes: DataFrame, path: str, by_token: bool = False) -> None:
    """Append to bronze under domain / dt, sorted by token. File names never collide, so nothing is lost.

    ``by_token`` adds a folder per token, which suits some thousands of tokens; without it the number
    of folders does not grow with the tokens, and a read for one token skips by file statistics.
    """
    rows = envelopes.withColumns({"dt": F.to_date("event_timestamp"), "token": F.col("token_address")})
    folders = ["domain", "dt", "token"] if by_token else ["domain", "dt"]
    write_partitioned(rows, path, folders, append=True, sort_by=["token_address", "event_timestamp"])


def partition_counts(envelopes: DataFrame) -> DataFrame:
    """Rows per bronze partition."""
    day = F.to_date("event_timestamp").alias("dt")
    return envelopes.groupBy("domain", day, "token_address").agg(F.count(F.lit(1)).alias("events"))


def write_ndjson(df: DataFrame, path: str) -> None:
    """One envelope per line."""
    df.write.mode("append").json(path)


def write_parquet(df: DataFrame, path: str, require_non_empty: bool = False) -> None:
    if require_non_empty and df.isEmpty():
        raise ValueError("nothing to write")
    df.write.mode("append").parquet(path)


def latest_versions(df: DataFrame, keys: Sequence[str], version: Column) -> DataFrame:
    """The newest version of each row of an append-only keyed table."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), version).alias("_row"))
    return newest.select(*keys, "_row.*")


def upsert(current: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``changes`` replace rows with the same keys; all others are untouched."""
    kept = current.join(changes.select(*keys), list(keys), "left_anti")
    return kept.unionByName(changes, allowMissingColumns=True)
