"""Outflows of monitored wallets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRANSACTIONS = (
    "array<struct<timestamp:bigint,tokenTransfers:array<struct<mint:string,fromUserAccount:string,"
    "toUserAccount:string,tokenAmount:double>>>>"
)

SIGNED_TRANSACTIONS = TRANSACTIONS.replace("struct<timestamp", "struct<signature:string,timestamp", 1)


def parse_transactions(envelopes: DataFrame) -> DataFrame:
    """(wallet, transactions) from wallet envelopes."""
    listed = F.from_json(F.get_json_object("payload", "$.transactions"), SIGNED_TRANSACTIONS)
    return envelopes.select(F.col("token_address").alias("wallet"), listed.alias("transactions"))


def transfers(wallets: DataFrame, sent: bool = False) -> DataFrame:
    """One row per token transfer of each wallet's transactions, or of those that the wallet itself ``sent``.

    Polls of a wallet overlap: a transfer that several of them show (same wallet, signature and place in the
    transaction) counts once. Transactions without a signature cannot be told apart and all count. Only what is kept is
    shuffled, and nothing where no transaction can have a signature.
    """
    # An inner explode would have Spark look for empty lists first, below joins that choose wallets, so all would be parsed
    # there. A wallet without transactions gives a null one here, which has no transfers.
    listed = wallets.select("wallet", F.explode_outer("transactions").alias("t"))
    signed = "signature" in listed.schema["t"].dataType.names
    move = F.struct(
        F.col("tx_time"),
        F.col("x.mint").alias("token_address"),
        F.col("x.fromUserAccount").alias("sender"),
        F.col("x.tokenAmount").alias("amount"),
    )
    moves = listed.select(
        "wallet",
        (F.col("t.signature") if signed else F.lit(None).cast("string")).alias("signature"),
        F.timestamp_seconds("t.timestamp").alias("tx_time"),
        F.posexplode("t.tokenTransfers").alias("place", "x"),
    ).select("wallet", "signature", "place", move.alias("move"))
    if sent:
        moves = moves.where(F.col("move.sender") == F.col("wallet"))
    if signed:
        # Without a signature a transfer is told by all it says, and its copies are counted, not dropped.
        own = F.when(F.col("signature").isNull(), F.col("move"))
        once = moves.groupBy("wallet", "signature", "place", own.alias("own")).agg(F.min("move").alias("move"), F.count(F.lit(1)).alias("n"))
        times = F.when(F.col("signature").isNull(), F.col("n")).otherwise(F.lit(1)).cast("int")
        moves = once.select("wallet", F.explode(F.array_repeat("move", times)).alias("move"))
    return moves.select("wallet", "move.*")


def outflows(moves: DataFrame, now: Column, recency_hours: float = 24.0) -> DataFrame:
    """What each wallet sent of each token: total, count, latest time, and whether that is recent.

    A transfer without a time counts but cannot make the flow recent; a time after ``now`` is recent.
    """
    sent = moves.where(F.col("sender") == F.col("wallet"))
    flows = sent.groupBy("wallet", "token_address").agg(
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("total_outflow"),
        F.count(F.lit(1)).alias("outflow_count"),
        F.max("tx_time").alias("latest_outflow"),
    )
    age = F.unix_micros(now) - F.unix_micros("latest_outflow")
    recent = F.coalesce(age <= F.lit(int(recency_hours * 3_600_000_000)), F.lit(False))
    return flows.withColumn("has_recent_outflow", recent)


def outflow_report(monitored: DataFrame, flows: DataFrame) -> DataFrame:
    """Every monitored (wallet, token), with zeros where nothing was sent."""
    joined = monitored.select("wallet", "token_address").join(flows, ["wallet", "token_address"], "left")
    empty = {"total_outflow": 0.0, "outflow_count": 0, "has_recent_outflow": False}
    return joined.na.fill(empty)
