"""Ownership concentration per token."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.rules import concentration_tier


def explode_holders(envelopes: DataFrame) -> DataFrame:
    """(token_address, owner, amount) from holder envelopes; rows without an amount are dropped."""
    items = F.from_json(F.get_json_object("payload", "$.items"), "array<struct<owner:string,amount:double>>")
    return (
        envelopes.select("token_address", F.explode(items).alias("i"))
        .select("token_address", "i.owner", "i.amount")
        .where(F.col("amount").isNotNull())
    )


def concentration(holders: DataFrame, tokens: DataFrame | None = None, top: int = 10) -> DataFrame:
    """Holder count, share of the ten largest, HHI and tier. No or non-positive holdings give 0 and LOW.

    The totals are partial sums; the ten largest are cut down before the shuffle (window group
    limit), so one widely held token does not weigh on one task. Null tokens are dropped on both
    sides alike, which lets Spark reuse the shuffle when ``holders`` is itself an aggregate.
    """
    holders = holders.where(F.col("token_address").isNotNull())
    totals = holders.groupBy("token_address").agg(
        F.count(F.lit(1)).alias("holder_count"),
        F.sum("amount").alias("_total"),
        F.sum(F.col("amount") * F.col("amount")).alias("_squares"),
    )
    largest = Window.partitionBy("token_address").orderBy(F.col("amount").desc(), F.col("owner"))
    top10 = (
        holders.withColumn("_rank", F.row_number().over(largest))
        .where(F.col("_rank") <= top)
        .groupBy("token_address")
        .agg(F.sum("amount").alias("_top"))
    )
    joined = totals.join(top10, "token_address", "left")
    if tokens is not None:
        joined = tokens.select("token_address").distinct().join(joined, "token_address", "left")
    owned = F.col("_total") > 0
    share = F.coalesce(F.when(owned, F.col("_top") / F.col("_total")), F.lit(0.0))
    hhi = F.coalesce(F.when(owned, F.col("_squares") / (F.col("_total") * F.col("_total"))), F.lit(0.0))
    return joined.select(
        "token_address",
        F.coalesce("holder_count", F.lit(0)).alias("holder_count"),
        share.alias("top10_share"),
        hhi.alias("hhi"),
        concentration_tier(share).alias("risk_tier"),
    )


def verdicts(sample: DataFrame, supply: DataFrame) -> DataFrame:
    """Tier from the vendor's share of supply (``top10_hold_percent``); the sample only where that is missing.

    ``supply_tier`` has no fallback: it is null without the vendor figure, and is what rug scoring takes.
    """
    joined = sample.join(supply.select("token_address", "top10_hold_percent", "total_holders"), "token_address", "left")
    vendor = F.col("top10_hold_percent") / 100
    share = F.coalesce(vendor, F.col("top10_share"))
    return joined.withColumns(
        {
            "verdict_share": share,
            "verdict_basis": F.when(vendor.isNotNull(), "supply").otherwise("sample"),
            "verdict_tier": concentration_tier(share),
            "supply_tier": concentration_tier(vendor),
        }
    )


def supply_figures(envelopes: DataFrame) -> DataFrame:
    """Vendor figures of holder envelopes, the latest per token."""
    rows = envelopes.select(
        "token_address",
        "event_timestamp",
        "event_id",
        F.get_json_object("payload", "$.top10_hold_percent").try_cast("double").alias("top10_hold_percent"),
        F.get_json_object("payload", "$.holder").try_cast("long").alias("total_holders"),
    )
    newest = F.struct("event_timestamp", "event_id")
    latest = F.max_by(F.struct("top10_hold_percent", "total_holders"), newest).alias("_v")
    return rows.groupBy("token_address").agg(latest).select("token_address", "_v.*")
