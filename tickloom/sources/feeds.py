"""RSS feeds to news envelopes."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions.news import mentions
from tickloom.functions.times import feed_time
from tickloom.operators.series import lay_out
from tickloom.session import pin_utc
from tickloom.sources.envelope import to_envelope

logger = logging.getLogger(__name__)

#: Spark keeps a window's first rows before the shuffle up to this rank.
THINNED = 1000
ITEM_SCHEMA = "title string, description string, link string, pubDate string"


def read_feed(spark: SparkSession, feed: str, path: str) -> DataFrame:
    """Items of one feed with their place in the document."""
    return (
        pin_utc(spark)
        .read.format("xml")
        .option("rowTag", "item")
        .option("mode", "PERMISSIVE")
        .option("ignoreCorruptFiles", True)
        .schema(ITEM_SCHEMA)
        .load(path)
        .select(
            F.lit(feed).alias("feed"),
            F.struct(
                "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row")
            ).alias("place"),
            F.coalesce("title", F.lit("")).alias("title"),
            F.coalesce("description", F.lit("")).alias("summary"),
            F.coalesce("link", F.lit("")).alias("link"),
            "pubDate",
        )
    )


def read_feeds(spark: SparkSession, feeds: dict[str, str]) -> DataFrame:
    """All feeds that can be read, in the given order; a feed that cannot is logged and skipped."""
    parts = []
    for rank, (feed, path) in enumerate(feeds.items()):
        try:
            parts.append(read_feed(spark, feed, path).withColumn("feed_rank", F.lit(rank)))
        except AnalysisException:
            logger.warning("skipping feed %s: cannot read %s", feed, path)
    if not parts:
        raise ValueError("no feed could be read")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def first_items(items: DataFrame, limit: int, **layout) -> DataFrame:
    """The first ``limit`` items of each feed, before any topic filter. Small limits thin items before the shuffle; with
    a larger one a feed of any length is ranked by many tasks."""
    if limit > THINNED:
        return lay_out(items, ("feed",), ("place",), **layout).index("item_rank").frame().where(F.col("item_rank") <= limit)
    w = Window.partitionBy("feed").orderBy("place")
    return items.withColumn("item_rank", F.row_number().over(w)).where(F.col("item_rank") <= limit)


def feed_envelopes(
    items: DataFrame, topic: str | None = None, limit_per_feed: int = 10, received_at: Column | None = None
) -> DataFrame:
    """News envelopes; ``token_address`` is the topic, or the feed's domain without one."""
    rows = first_items(items, limit_per_feed)
    if topic is not None:
        rows = rows.where(mentions(F.lit(topic), F.col("title"), F.col("summary")))
    payload = F.to_json(F.struct(F.col("feed").alias("domain"), "link", "summary", "title"))
    now = F.current_timestamp() if received_at is None else received_at
    return to_envelope(
        rows,
        source="rss",
        domain="news",
        token=F.lit(topic) if topic else F.col("feed"),
        event_timestamp=F.coalesce(feed_time(F.col("pubDate")), now),
        payload=payload,
    )
