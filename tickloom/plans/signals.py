"""Per-token signals joined into risk scores and recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.news import classify
from tickloom.functions.rules import concentration_tier, mint_flags, recommendation, rug_risk


def mint_signals(envelopes: DataFrame) -> DataFrame:
    """Mint and freeze flags per token, from its newest account document."""
    newest = F.struct("event_timestamp", "event_id")
    latest = envelopes.groupBy("token_address").agg(F.max_by("payload", newest).alias("payload"))
    mint, freeze = mint_flags(F.col("payload"))
    return latest.select("token_address", mint.alias("mint_active"), freeze.alias("freeze_active"))


def news_signals(items: DataFrame) -> DataFrame:
    """Per topic, the first item in reading order that is not ``other``.

    Items: topic, title, domain, feed_rank, item_rank. Only the title is classified.
    """
    place = F.when(F.col("event_type") != "other", F.struct("feed_rank", "item_rank"))
    first = F.min_by(F.struct("event_type", "credibility"), place).alias("_n")
    return (
        classify(items)
        .groupBy("topic")
        .agg(first)
        .where(F.col("_n").isNotNull())
        .select("topic", F.col("_n.event_type").alias("news_event_type"), F.col("_n.credibility").alias("news_credibility"))
    )


def dev_outflow_flags(monitored: DataFrame, report: DataFrame) -> DataFrame:
    """Recent-outflow flag per token from the report of its monitored wallets (any wallet counts)."""
    joined = monitored.select("wallet", "token_address").join(report, ["wallet", "token_address"])
    return joined.groupBy("token_address").agg(F.bool_or("has_recent_outflow").alias("dev_outflow"))


def security_scores(tokens: DataFrame, tiers: DataFrame, outflow_flags: DataFrame, mints: DataFrame) -> DataFrame:
    """Rug-risk score of every token; a signal a token lacks is a data gap.

    tiers: token_address, supply_tier. outflow_flags: token_address, dev_outflow.
    mints: token_address, mint_active, freeze_active. Each has one row per token.
    """
    joined = (
        tokens.join(tiers.select("token_address", "supply_tier"), "token_address", "left")
        .join(outflow_flags.select("token_address", "dev_outflow"), "token_address", "left")
        .join(mints.select("token_address", "mint_active", "freeze_active"), "token_address", "left")
    )
    signals = [F.col(c) for c in ("supply_tier", "dev_outflow", "mint_active", "freeze_active")]
    return joined.withColumns(rug_risk(*signals))


def supply_tiers(supply: DataFrame) -> DataFrame:
    """(token_address, supply_tier) from the vendor's figures alone, all that risk scores need of the holders."""
    return supply.select("token_address", concentration_tier(F.col("top10_hold_percent") / 100).alias("supply_tier"))


def _optional(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def decisions(
    scores: DataFrame,
    news: DataFrame | None = None,
    probabilities: DataFrame | None = None,
    momentum: DataFrame | None = None,
) -> DataFrame:
    """One recommendation per scored token.

    scores: token_address, rug_risk_score, risk_tier, and optionally symbol, the news topic, and, without
    ``momentum``, momentum_tier. A token
    whose topic has no news, or that lacks a probability or momentum, gets null for that signal.
    """
    own = ["token_address", "symbol", "rug_risk_score", "risk_tier", *(["momentum_tier"] if momentum is None else [])]
    df = scores.select(*[c for c in own if c in scores.columns])
    if probabilities is not None:
        df = df.join(probabilities.select("token_address", "probability"), "token_address", "left")
    if momentum is not None:
        df = df.join(momentum.select("token_address", "momentum_tier"), "token_address", "left")
    if news is not None:
        df = df.join(news.withColumnRenamed("topic", "symbol"), "symbol", "left")
    columns = recommendation(
        F.col("rug_risk_score"),
        F.col("risk_tier"),
        _optional(df, "probability", "double"),
        _optional(df, "news_event_type", "string"),
        _optional(df, "news_credibility", "string"),
        _optional(df, "momentum_tier", "string"),
    )
    return df.select("token_address", *[c.alias(n) for n, c in columns.items()])
