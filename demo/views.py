"""The test tables read as market data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.series import lay_out
from tickloom.session import pin_utc
from tickloom.sources.envelope import to_envelope

NOW = "2001-10-15 00:00:00"
RECENCY_HOURS = 24.0 * 30
HEADLINES = (
    "hackers hit bridge",
    "token drained overnight",
    "Rug Pull feared",
    "breach reported",
    "sued by holders",
    "probe by SEC",
    "delisting notice",
    "now available on market",
    "network outage",
    "whale moves funds",
    "partners with bank",
    "Mainnet upgrade",
    "airdrop announced",
    "quiet day",
    "quiet week",
    "quiet month",
)
DOMAINS = ("www.CoinDesk.com", "reuters.com", "www.unknown.example", "bloomberg.com", "www.www.decrypt.co")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, its zone-less timestamps taken as UTC."""
    df = pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = {c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"}
    return df.withColumns(zoneless) if zoneless else df


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as candles: one series per user."""
    return table(spark, sf_dir, "events").where(F.col("value") > 0).select(
        _text("event_id").alias("event_id"),
        _text("user_id").alias("token_address"),
        F.col("ts").alias("event_timestamp"),
        F.col("value").alias("close"),
        F.get_json_object("props", "$.k").try_cast("double").alias("volume"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as price ticks: five tokens, one per event type."""
    return table(spark, sf_dir, "events").select(
        _text("event_id").alias("event_id"),
        F.col("event_type").alias("token_address"),
        F.col("ts").alias("event_timestamp"),
        F.col("value").alias("price"),
    )


def tick_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ticks with the quarter of the whole time span they are in."""
    rows = ticks(spark, sf_dir)
    span = rows.agg(F.min(F.unix_micros("event_timestamp")).alias("low"), F.max(F.unix_micros("event_timestamp")).alias("high")).first()
    low, length = span.low or 0, (span.high or 0) - (span.low or 0) + 1
    return rows.withColumn("slice", F.floor((F.unix_micros("event_timestamp") - low) * 4 / F.lit(length)).cast("int"))


def market_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a market envelope, delivered twice: a minute and an hour after it happened."""
    payload = F.concat(
        F.lit('{"o":'), _text("value"), F.lit(',"h":'), _text("value"), F.lit(',"l":'),
        (F.col("value") - 5).cast("decimal(18,2)").cast("string"), F.lit(',"c":'), _text("value"),
        F.lit(',"v":'), F.get_json_object("props", "$.k"), F.lit(',"currency":"usd"}'),
    )
    sent = to_envelope(
        table(spark, sf_dir, "events"),
        source="birdeye",
        domain="market",
        token=_text("user_id"),
        event_timestamp=F.col("ts"),
        payload=payload,
        ingested=F.col("ts"),
    )
    delays = F.array(F.expr("interval 1 minute"), F.expr("interval 1 hour"))
    return sent.withColumn("ingestion_timestamp", F.explode(F.transform(delays, lambda d: F.col("event_timestamp") + d)))


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as holders: token = part, owner = supplier."""
    # Dealt by token, which serves both this grouping and one by token.
    return (
        table(spark, sf_dir, "lineitem")
        .select(_text("l_partkey").alias("token_address"), _text("l_suppkey").alias("owner"), "l_quantity")
        .repartition("token_address")
        .groupBy("token_address", "owner")
        .agg(F.sum("l_quantity").alias("amount"))
    )


def supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor share of supply per part; every fifth size has none."""
    return table(spark, sf_dir, "part").select(
        _text("p_partkey").alias("token_address"),
        F.when(F.col("p_size") % 5 != 0, F.col("p_size") * 2.0).alias("top10_hold_percent"),
        F.col("p_size").cast("long").alias("total_holders"),
    )


def wallet_transactions(spark: SparkSession, sf_dir: str, signed: bool = False) -> DataFrame:
    """lineitem as wallet history: a supplier sends open lines and receives the others.

    ``signed`` adds a signature to each transaction, and its line number beside it.
    """
    tx = _transaction(F.col, signed)
    line = [F.col("l_linenumber").alias("line")] * signed
    return table(spark, sf_dir, "lineitem").select(_text("l_suppkey").alias("wallet"), F.array(tx).alias("transactions"), *line)


def wallet_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The signed transactions of each wallet with their line numbers in one row. Lines are shuffled as they are, and made
    into transactions, which are several times as wide, after that."""
    of = ("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", *of).repartition("l_suppkey")
    listed = lines.groupBy("l_suppkey").agg(F.collect_list(F.struct(*of)).alias("lines"))

    def item(row: Column) -> Column:
        def field(name: str) -> Column:
            return F.col("l_suppkey") if name == "l_suppkey" else row[name]

        return F.struct(row["l_linenumber"].alias("line"), _transaction(field, True).alias("t"))

    return listed.select(_text("l_suppkey").alias("wallet"), F.transform("lines", item).alias("history"))


def _transaction(field: Callable[[str], Column], signed: bool) -> Column:
    """The transaction of a line, by its columns."""
    wallet = field("l_suppkey").cast("string")
    other = F.concat(F.lit("order-"), field("l_orderkey").cast("string"))
    outgoing = field("l_linestatus") == "O"
    amount = F.when(field("l_returnflag") != "N", field("l_quantity"))
    when = F.when(field("l_tax") > 0, F.unix_timestamp(field("l_shipdate")))

    def transfer(mint: Column, sender: Column, receiver: Column, value: Column) -> Column:
        return F.struct(
            mint.alias("mint"), sender.alias("fromUserAccount"), receiver.alias("toUserAccount"), value.alias("tokenAmount")
        )

    moves = F.array(
        transfer(field("l_partkey").cast("string"), F.when(outgoing, wallet).otherwise(other), F.when(outgoing, other).otherwise(wallet), amount),
        transfer(F.lit("fee"), wallet, other, field("l_tax")),
    )
    signature = F.concat_ws("-", *[field(n) for n in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    return F.struct(*[signature.alias("signature")] * signed, when.alias("timestamp"), moves.alias("tokenTransfers"))


def mint_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account documents of parts: by size they have both authorities, one, none, or are an error."""
    kind = F.col("p_size") % 4
    info = F.struct(
        F.when(kind < 2, F.lit("owner")).alias("mintAuthority"),
        F.when(kind == 0, F.lit("owner")).alias("freezeAuthority"),
        F.lit(6).alias("decimals"),
    )
    parsed = F.struct(F.struct(F.struct(F.struct(info.alias("info")).alias("parsed")).alias("data")).alias("value"))
    good = F.to_json(F.struct(parsed.alias("result")))
    bad = F.lit('{"error":{"code":-32602}}')
    return table(spark, sf_dir, "part").select(
        _text("p_partkey").alias("token_address"),
        _text("p_partkey").alias("event_id"),
        F.lit(NOW).cast("timestamp").alias("event_timestamp"),
        F.when(kind == 3, bad).otherwise(good).alias("payload"),
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as screened tokens."""
    traded = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            F.sum("l_extendedprice").alias("volume_24h_usd"),
            F.count_distinct("l_orderkey").alias("holder"),
            F.count(F.lit(1)).alias("trade_24h_count"),
        )
    )
    return (
        table(spark, sf_dir, "supplier")
        .join(traded, F.col("s_suppkey") == F.col("l_suppkey"), "left")
        .select(
            _text("s_suppkey").alias("token_address"),
            F.col("s_name").alias("symbol"),
            (F.col("s_acctbal") * 100).alias("liquidity"),
            F.when(F.col("s_nationkey") != 3, F.col("volume_24h_usd") / 10).alias("volume_24h_usd"),
            "holder",
            "trade_24h_count",
        )
    )


def news_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as news: the whole text with a headline fragment, a topic per source."""
    pick = (F.col("doc_id") % len(HEADLINES)).cast("int")
    place = (F.col("doc_id") % len(DOMAINS)).cast("int")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("source").alias("topic"),
        F.concat(F.col("text"), F.lit(" "), F.array(*[F.lit(h) for h in HEADLINES])[pick]).alias("title"),
        F.array(*[F.lit(d) for d in DOMAINS])[place].alias("domain"),
        place.alias("feed_rank"),
        F.col("doc_id").alias("item_rank"),
    )


def position_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per user: the first opens, purchases sell 20 %, errors sell what is left, others are prices.

    A sell whose ``k`` is a multiple of ten asks for nothing, which is not a valid sell.
    """
    base = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("position_id"),
        F.concat(F.lit("token-"), (F.col("user_id") % 7).cast("string")).alias("token_address"),
        F.col("ts").alias("event_timestamp"),
        _text("event_id").alias("event_id"),
        F.col("value").alias("price"),
        F.col("event_type").alias("kind"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    numbered = lay_out(base, ("position_id",), ("event_timestamp", "event_id")).index("n").frame()
    first, sells = F.col("n") == 1, F.col("kind").isin("purchase", "error")
    full = (F.col("kind") == "error") & (F.col("k") % 3 == 0)
    fraction = F.when(F.col("k") % 10 == 0, 0.0).when(full, 1.0).otherwise(0.2)
    return numbered.select(
        "position_id",
        "token_address",
        "event_timestamp",
        "event_id",
        "price",
        F.when(first, "open").when(sells, "sell").otherwise("price").alias("event_type"),
        F.when(first, 10.0).alias("size"),
        F.when(~first & sells, fraction).alias("sell_fraction"),
    )


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as training runs, some without a metric."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        _text("o_custkey").alias("token_address"),
        F.when(key % 2 == 0, "entry").otherwise("exit").alias("model_type"),
        key.cast("string").alias("run_id"),
        F.col("o_orderdate").alias("start_time"),
        F.when(key % 11 != 0, 0.4 + (key * 7919 % 500) / 1000.0).alias("roc_auc"),
        F.when(key % 13 != 0, 0.1 + (key * 104729 % 40) / 1000.0).alias("brier_score"),
    )


def champions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best finished run per customer and model type, for two customers in three."""
    runs = model_runs(spark, sf_dir).where(F.col("token_address").cast("long") % 3 != 0)
    old = runs.where(F.col("start_time") < F.lit("1998-01-01").cast("timestamp"))
    newest = F.max_by(F.struct("run_id", "roc_auc", "brier_score"), F.struct("start_time", "run_id")).alias("_r")
    return old.groupBy("token_address", "model_type").agg(newest).select("token_address", "model_type", "_r.*")


def simple_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A two-feature model per user from the spread of its own candles."""
    return candles(spark, sf_dir).groupBy("token_address").agg(
        F.array(F.avg("close"), F.avg("volume")).alias("mean"),
        F.array(F.stddev_pop("close"), F.stddev_pop("volume")).alias("scale"),
        F.array(F.lit(0.5), F.lit(-0.25)).alias("coef"),
        F.lit(0.1).alias("intercept"),
    )


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a probability from value and a label from ``k``, per event type."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("token_address"),
        (F.col("value") / (F.col("value") + 40)).alias("probability"),
        (F.get_json_object("props", "$.k").cast("int") % 3 == 0).cast("int").alias("label"),
    )


def candle_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a landed OHLCV response of two candles, one of them without a time."""
    seconds = F.unix_timestamp("ts").cast("string")
    parts = ('{"data":{"items":[{"unixTime":', seconds, ',"c":', _text("value"), '},{"c":', _text("value"), "}]}}")
    return _landed(table(spark, sf_dir, "events"), _text("user_id"), parts)


def price_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a landed price response; errors have no value, signups no update time."""
    value = F.when(F.col("event_type") == "error", F.lit("null")).otherwise(_text("value"))
    updated = F.when(F.col("event_type") == "signup", F.lit("0")).otherwise(F.unix_timestamp("ts").cast("string"))
    parts = ('{"data":{"value":', value, ',"updateUnixTime":', updated, "}}")
    return _landed(table(spark, sf_dir, "events"), _text("user_id"), parts)


def screener_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier as a landed screener page with one address and one row without."""
    cents = F.round(F.col("s_acctbal") * 100).cast("long").cast("string")
    parts = ('{"data":{"items":[{"liquidity":', cents, ',"extensions":{},"address":"', _text("s_suppkey"), '"},{"symbol":"none"}]}}')
    rows = table(spark, sf_dir, "supplier").withColumn("ts", F.lit(NOW).cast("timestamp"))
    return _landed(rows, F.lit("scan"), parts)


def _landed(df: DataFrame, key: Column, parts: tuple) -> DataFrame:
    text = F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return df.select(
        key.alias("request_key"), (F.col("ts") + F.expr("interval 1 minute")).alias("received_at"), text.alias("response")
    )


def tick_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a stream message; errors have no price, signups no readable time."""
    price = F.when(F.col("event_type") == "error", F.lit("null")).otherwise(_text("value"))
    when = F.when(F.col("event_type") == "signup", F.lit("soon")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    parts = ('{"event_id":"', _text("event_id"), '","token_address":"', _text("user_id"), '","event_timestamp":"', when, '","payload":{"value":', price, "}}")
    return table(spark, sf_dir, "events").select(F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts]).alias("value"))


def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as feed items, one feed per source."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("feed"), F.col("doc_id").alias("place"), F.col("text").alias("title"), F.col("lang").alias("summary")
    )


def monitored_wallets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wallet to watch for every part."""
    return table(spark, sf_dir, "part").select(
        _text("p_size").alias("wallet"), _text("p_partkey").alias("token_address")
    )
