"""Bronze to silver as a stream: each event once, whenever its copies come, with state of bounded age.

Copies that come within ``delay`` of each other are told apart by the state of ``dropDuplicatesWithinWatermark``, which
forgets an event id ``delay`` after it came. The watermark follows the time of arrival, not of the event, so no event is too
late for it. A copy that comes later than that finds its first copy in silver: such a row is older than ``delay`` when it
arrives, and copies share their time, so only the event ids of its own day are looked up, and only for such rows.

A micro-batch is written with its number, once, in the same commit as its rows.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.constants import ENVELOPE_SCHEMA
from tickloom.operators import silver
from tickloom.sources import tables, versions
from tickloom.streaming.ingest import start_foreach

_ARRIVED = "_arrived"


def arrivals(spark: SparkSession, bronze_path: str, max_files: int = 1000) -> DataFrame:
    """Envelopes as they are appended to bronze, with the time their file appeared."""
    rows = versions.stream_appended(spark, bronze_path, ENVELOPE_SCHEMA + ", dt date, token string", _ARRIVED, max_files)
    return rows.drop("dt", "token")


def first_copies(envelopes: DataFrame, delay: timedelta) -> DataFrame:
    """Envelopes without copies of one that came at most ``delay`` before."""
    stamped = envelopes.withWatermark(_ARRIVED, f"{int(delay.total_seconds())} seconds")
    return stamped.dropDuplicatesWithinWatermark(["event_id"])


def unseen(batch: DataFrame, silver_path: str, delay: timedelta) -> DataFrame:
    """Rows of a batch whose event is not in silver. Only rows older than ``delay`` on arrival are looked up."""
    spark = batch.sparkSession
    age = F.unix_micros(_ARRIVED) - F.unix_micros("event_timestamp")
    old = F.coalesce(age > int(delay.total_seconds() * 1_000_000), F.lit(True))
    days = [r[0] for r in batch.where(old).select(F.to_date("event_timestamp").alias("d")).distinct().collect()]
    version = versions.current(spark, silver_path)
    if not days or version is None:
        return batch
    wanted = {None if d is None else str(d) for d in days}
    done = versions.read(spark, silver_path, version=version, keep=lambda p: p["event_date"] in wanted).select("event_id")
    return batch.join(done.distinct(), "event_id", "left_anti")


def start(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    checkpoint: str,
    delay: timedelta = timedelta(days=2),
    arrived: Column | None = None,
    every: str | None = "1 minute",
    max_files: int = 1000,
) -> StreamingQuery:
    """Market events of bronze to silver; ``every=None`` takes what is there and stops.

    Envelopes arrive when their file appears. Files are taken in that order, so none is behind the watermark. ``arrived``
    is another time of arrival, for a replay: one more than ``delay`` behind the newest seen would be dropped by Spark.
    """
    market = arrivals(spark, bronze_path, max_files).where(F.col("domain") == "market")
    rows = first_copies(market if arrived is None else market.withColumn(_ARRIVED, arrived), delay)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        key = f"stream {checkpoint}"
        version = versions.current(spark, silver_path)
        if version and int(version.notes.get(key, -1)) >= number:
            return
        batch = batch.persist()
        try:
            marked = silver.judged(unseen(batch, silver_path, delay).drop(_ARRIVED))
            quality = F.when(F.col("is_valid"), "valid").otherwise("quarantine")
            tables.write_partitioned(
                marked.withColumn(tables.QUALITY, quality).drop("is_valid"),
                silver_path,
                [tables.QUALITY, "event_date"],
                append=True,
                sort_by=["token_address", "event_timestamp"],
                note=(key, str(number)),
            )
        finally:
            batch.unpersist()

    return start_foreach(rows, write, checkpoint, every)
