"""Price tick streams: sources, decoding, keyed messages and the dead-letter path."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.times import iso_time
from tickloom.session import pin_utc

TOPIC = "market.price.raw.v1"
MESSAGE = "event_id string, token_address string, event_timestamp string, payload struct<value:string>"


def kafka_messages(spark: SparkSession, servers: str, topic: str = TOPIC, max_offsets: int = 5_000_000) -> DataFrame:
    """Messages from the newest offset on; later offsets live in the query checkpoint.

    ``max_offsets`` bounds a micro-batch, also while catching up. Needs the Kafka connector package.
    """
    return (
        pin_utc(spark)
        .readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def file_messages(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Messages from text files that appear in a folder, one JSON message per line."""
    return pin_utc(spark).readStream.format("text").option("maxFilesPerTrigger", max_files).load(path)


def decode(messages: DataFrame) -> DataFrame:
    """Messages with token, time and price; ``problem`` says why a message is not a tick."""
    m = F.from_json("value", MESSAGE)
    parsed = messages.withColumn("_m", m).select(
        "value",
        F.coalesce("_m.event_id", F.sha2("value", 256)).alias("event_id"),
        F.col("_m.token_address").alias("token_address"),
        iso_time(F.col("_m.event_timestamp")).alias("event_timestamp"),
        F.col("_m.payload.value").try_cast("double").alias("price"),
    )
    problem = (
        F.when(F.col("token_address").isNull(), "token")
        .when(F.col("event_timestamp").isNull(), "time")
        .when(F.col("price").isNull() | F.isnan("price"), "price")
    )
    return parsed.withColumn("problem", problem)


def ticks(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("problem").isNull()).select("token_address", "event_timestamp", "event_id", "price")


def dead_letters(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("problem").isNotNull()).select("value", "problem")


def keyed_messages(envelopes: DataFrame) -> DataFrame:
    """Key and value columns for a keyed log: the token is the key, so its events keep their order."""
    return envelopes.select(F.col("token_address").alias("key"), F.to_json(F.struct("*")).alias("value"))


def start_kafka_sink(envelopes: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC, every: str = "20 seconds") -> StreamingQuery:
    """Publish a stream of envelopes. Needs the Kafka connector package."""
    return (
        keyed_messages(envelopes)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )


def start_table_sink(df: DataFrame, path: str, checkpoint: str, every: str | None = "20 seconds") -> StreamingQuery:
    """Append a stream to a Parquet table; ``every=None`` processes what is there and stops."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def start_foreach(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = "20 seconds") -> StreamingQuery:
    writer = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()
