"""Token screener, candidate quality and ranking."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.constants import MAX_DISCOVERED
from tickloom.functions.rules import candidate_problem, momentum_tier
from tickloom.sources.tables import latest_versions

@dataclass(frozen=True)
class ScreenFilters:
    """Screener bounds, all inclusive; None means no such filter, as limit None means all rows."""

    sort_by: str = "volume_24h_usd"
    sort_type: str = "desc"
    min_liquidity: float | None = 5_000
    max_liquidity: float | None = 2_000_000
    min_volume_24h_usd: float | None = 10_000
    min_holder: int | None = 50
    min_trade_24h_count: int | None = 50
    limit: int | None = 50
    offset: int = 0

    def predicate(self) -> Column:
        bounds = [
            (F.col("liquidity") >= self.min_liquidity) if self.min_liquidity is not None else None,
            (F.col("liquidity") <= self.max_liquidity) if self.max_liquidity is not None else None,
            (F.col("volume_24h_usd") >= self.min_volume_24h_usd) if self.min_volume_24h_usd is not None else None,
            (F.col("holder") >= self.min_holder) if self.min_holder is not None else None,
            (F.col("trade_24h_count") >= self.min_trade_24h_count) if self.min_trade_24h_count is not None else None,
        ]
        return reduce(lambda a, b: a & b, [b for b in bounds if b is not None], F.lit(True))

    def order(self) -> list[Column]:
        by = F.col(self.sort_by)
        return [by.desc() if self.sort_type == "desc" else by.asc(), F.col("token_address").asc()]


def screen(tokens: DataFrame, filters: ScreenFilters | None = None) -> DataFrame:
    """The rows from ``offset`` on, ``limit`` of them."""
    f = filters or ScreenFilters()
    page = tokens.where(f.predicate()).orderBy(*f.order())
    page = page.offset(f.offset)
    return page if f.limit is None else page.limit(f.limit)


def parse_candidates(envelopes: DataFrame) -> DataFrame:
    """Typed screener metrics from discovery envelopes, one row per token and scan."""
    def number(name: str, kind: str) -> Column:
        return F.get_json_object("payload", f"$.{name}").try_cast(kind).alias(name)

    return envelopes.dropDuplicates(["token_address", "event_timestamp"]).select(
        "token_address",
        "event_timestamp",
        F.get_json_object("payload", "$.symbol").alias("symbol"),
        number("liquidity", "double"),
        number("volume_24h_usd", "double"),
        number("holder", "long"),
        number("trade_24h_count", "long"),
    )


def judge(candidates: DataFrame) -> DataFrame:
    """Add ``problem`` (null for a valid candidate)."""
    return candidates.withColumn("problem", candidate_problem(F.col("liquidity"), F.col("volume_24h_usd")))


def split_candidates(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined)."""
    judged = judge(candidates)
    return judged.where(F.col("problem").isNull()).drop("problem"), judged.where(F.col("problem").isNotNull())


def quality_counts(candidates: DataFrame) -> DataFrame:
    return judge(candidates).groupBy(F.coalesce("problem", F.lit("valid")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def scan_counts(candidates: DataFrame) -> DataFrame:
    """Tokens received by each scan, and how many of them are valid."""
    judged = judge(candidates)
    return judged.groupBy("event_timestamp").agg(F.count(F.lit(1)).alias("received"), F.count_if(F.col("problem").isNull()).alias("valid"))


def with_momentum(candidates: DataFrame) -> DataFrame:
    metrics = [F.col(c) for c in ("volume_24h_usd", "liquidity", "holder", "trade_24h_count")]
    return candidates.withColumn("momentum_tier", momentum_tier(*metrics))


def newest(candidates: DataFrame) -> DataFrame:
    """One row per token, that of its newest scan."""
    return latest_versions(candidates, ["token_address"], F.col("event_timestamp")).select(*candidates.columns)


def top_by_volume(candidates: DataFrame, limit: int | None = MAX_DISCOVERED) -> DataFrame:
    """The busiest candidates, all of them without a limit; a missing volume counts as 0."""
    volume = F.coalesce("volume_24h_usd", F.lit(0.0))
    return candidates if limit is None else candidates.orderBy(volume.desc(), "token_address").limit(limit)


def display_rows(candidates: DataFrame) -> DataFrame:
    """Report line per candidate; a missing symbol shows as ``?`` and a missing amount as 0."""
    return candidates.select(
        "token_address",
        F.substring("token_address", 1, 8).alias("label"),
        F.coalesce("symbol", F.lit("?")).alias("symbol"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("volume_24h_usd", "liquidity")],
    )


def merge_watchlist(manual: DataFrame, discovered: DataFrame) -> DataFrame:
    """Tokens with their first source: manual ones, then discovered ones that are not manual."""
    first = manual.select("token_address").distinct().withColumn("source", F.lit("manual"))
    rest = discovered.select("token_address").distinct().join(first, "token_address", "left_anti")
    return first.unionByName(rest.withColumn("source", F.lit("discovered")))
