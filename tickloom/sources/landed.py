"""Landed vendor responses to envelopes.

A landed file is NDJSON, one response per line: ``request_key`` (the token, wallet, currency or
screener run it answers), ``received_at`` and the response body as it came. Every adapter has the
same contract, a landed DataFrame in and an envelope DataFrame out, and is listed in ``ADAPTERS``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.constants import LANDED_SCHEMA
from tickloom.functions.canonical import drop_empty_objects
from tickloom.functions.times import iso_time, unix_seconds
from tickloom.session import pin_utc
from tickloom.sources.envelope import to_envelope

CORRUPT = "_corrupt_record"


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed lines; a malformed one has null fields, its text in ``_corrupt_record``, and gives no envelope."""
    schema = f"{LANDED_SCHEMA}, {CORRUPT} string"
    return pin_utc(spark).read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)


def rejects(landed: DataFrame) -> DataFrame:
    """The lines no adapter can use, with the reason: no JSON, or no response in it."""
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed").when(F.col("response").isNull(), "no_response")
    return landed.withColumn("reason", reason).where(F.col("reason").isNotNull()).select("request_key", "received_at", CORRUPT, "reason")


def _field(json: Column, path: str) -> Column:
    return F.get_json_object(json, path)


def _number(json: Column, path: str) -> Column:
    return _field(json, path).try_cast("double")


def _items(df: DataFrame, array: Column, limit: int | None = None) -> DataFrame:
    """One row per element of a JSON array, each element as raw JSON in ``item``; none for a missing array."""
    elements = F.from_json(array, "array<string>")
    if limit is not None:
        elements = F.slice(elements, 1, limit)
    return df.withColumn("item", F.explode(elements))


def candles(landed: DataFrame) -> DataFrame:
    """OHLCV history. A candle without a numeric ``unixTime`` is skipped."""
    rows = _items(landed, _field(F.col("response"), "$.data.items"))
    seconds = _number(F.col("item"), "$.unixTime")
    return to_envelope(
        rows.where(seconds.isNotNull()),
        source="birdeye",
        domain="market",
        token=F.col("request_key"),
        event_timestamp=unix_seconds(seconds),
        payload=F.col("item"),
    )


def malformed_candles(landed: DataFrame) -> DataFrame:
    """The candles ``candles`` skips, kept for inspection."""
    rows = _items(landed, _field(F.col("response"), "$.data.items"))
    return rows.where(_number(F.col("item"), "$.unixTime").isNull()).drop("response")


def latest_prices(landed: DataFrame) -> DataFrame:
    """Latest price per token; its time is ``updateUnixTime``, or the landing time when missing or 0."""
    data = _field(F.col("response"), "$.data")
    rows = landed.withColumn("item", data).where(_field(F.col("item"), "$.value").isNotNull())
    seconds = _number(F.col("item"), "$.updateUnixTime")
    return to_envelope(
        rows,
        source="birdeye",
        domain="market",
        token=F.col("request_key"),
        event_timestamp=F.coalesce(unix_seconds(F.nullif(seconds, F.lit(0.0))), F.col("received_at")),
        payload=F.col("item"),
    )


def holders(landed: DataFrame) -> DataFrame:
    """Holder list of a token: one envelope with the whole ``data`` object."""
    return to_envelope(
        landed.where(F.col("response").isNotNull()),
        source="birdeye",
        domain="holder",
        token=F.col("request_key"),
        event_timestamp=F.col("received_at"),
        payload=F.coalesce(_field(F.col("response"), "$.data"), F.lit("{}")),
    )


def wallet_history(landed: DataFrame) -> DataFrame:
    """Wallet transactions: ``token_address`` holds the wallet, the payload its transaction list."""
    return to_envelope(
        landed.where(F.col("response").isNotNull()),
        source="helius",
        domain="wallet",
        token=F.col("request_key"),
        event_timestamp=F.col("received_at"),
        payload=F.concat(F.lit('{"transactions":'), F.col("response"), F.lit("}")),
    )


def security_info(landed: DataFrame) -> DataFrame:
    return to_envelope(
        landed.where(F.col("response").isNotNull()),
        source="birdeye",
        domain="security",
        token=F.col("request_key"),
        event_timestamp=F.col("received_at"),
        payload=F.coalesce(_field(F.col("response"), "$.data"), F.lit("{}")),
    )


def mint_info(landed: DataFrame) -> DataFrame:
    """Mint account documents as they came; an RPC error is a payload too."""
    return to_envelope(
        landed.where(F.col("response").isNotNull()),
        source="solana_rpc",
        domain="security",
        token=F.col("request_key"),
        event_timestamp=F.col("received_at"),
        payload=F.col("response"),
    )


def screened_tokens(landed: DataFrame) -> DataFrame:
    """Screener rows with an address. The event time is the landing time, so one scan has one time."""
    rows = _items(landed, _field(F.col("response"), "$.data.items"))
    address = _field(F.col("item"), "$.address")
    return to_envelope(
        rows.where(F.length(address) > 0),
        source="birdeye",
        domain="discovery",
        token=address,
        event_timestamp=F.col("received_at"),
        payload=drop_empty_objects(F.col("item")),
    )


def news_posts(landed: DataFrame, limit: int | None = None) -> DataFrame:
    """News posts of a currency, of each response the first ``limit`` if given; time is published, else created,
    else the landing time."""
    rows = _items(landed, _field(F.col("response"), "$.results"), limit)
    item = F.col("item")
    written = F.coalesce(
        F.nullif(_field(item, "$.published_at"), F.lit("")), F.nullif(_field(item, "$.created_at"), F.lit(""))
    )
    fields = F.try_parse_json(item).cast("map<string,variant>")
    post_id = F.map_from_arrays(F.array(F.lit("_post_id")), F.array(F.element_at(fields, "id")))
    return to_envelope(
        rows,
        source="cryptopanic",
        domain="news",
        token=F.col("request_key"),
        event_timestamp=F.coalesce(iso_time(written), F.col("received_at")),
        payload=F.coalesce(F.to_json(F.map_concat(fields, post_id)), item),
    )


ADAPTERS: dict[tuple[str, str], Callable[[DataFrame], DataFrame]] = {
    ("birdeye", "market"): candles,
    ("birdeye", "price"): latest_prices,
    ("birdeye", "holder"): holders,
    ("birdeye", "security"): security_info,
    ("birdeye", "discovery"): screened_tokens,
    ("helius", "wallet"): wallet_history,
    ("solana_rpc", "security"): mint_info,
    ("cryptopanic", "news"): news_posts,
}
