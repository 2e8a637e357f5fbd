"""Queries that run the jobs: they write tables to the shared folder, twice where a job must stand that, and read them."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demo import views
from demo.queries import decided
from tickloom import constants as K
from tickloom.functions.times import feed_time
from tickloom.operators import discovery, features, holders, labels, prices
from tickloom.operators.scoring import score
from tickloom.plans import jobs, models
from tickloom.session import checkpoint_root, cut, pin_utc
from tickloom.sources import feeds, landed, tables
from tickloom.streaming import ingest


def _now() -> Column:
    return F.lit(views.NOW).cast("timestamp")


def _path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/tickloom-lake/{name}-{uuid.uuid4().hex}"


def micros(df: DataFrame) -> DataFrame:
    changed = {n: F.unix_micros(n) for n, kind in df.dtypes if kind == "timestamp"}
    changed |= {n: F.col(n).cast("string") for n, kind in df.dtypes if kind == "date"}
    return df.withColumns(changed) if changed else df


def rounded(df: DataFrame) -> DataFrame:
    changed = {n: F.round(n, 6) for n, kind in df.dtypes if kind == "double"}
    return micros(df.withColumns(changed) if changed else df)


def _bronze(spark: SparkSession, sf: str) -> str:
    path = _path(spark, "bronze")
    tables.write_bronze(views.market_events(spark, sf), path)
    return path


def _silver(spark: SparkSession, sf: str) -> str:
    """Silver of all days, then again, then of the two newest days alone."""
    bronze, path = _bronze(spark, sf), _path(spark, "silver")
    for _ in range(2):
        jobs.silver(spark, bronze, path)
    last = tables.read_bronze(spark, bronze).agg(F.max("dt")).first()[0]
    if last is not None:
        jobs.silver(spark, bronze, path, days=(str(last - timedelta(days=1)), str(last)))
    return path


def _gold(spark: SparkSession, sf: str) -> str:
    silver, path = _silver(spark, sf), _path(spark, "gold")
    for _ in range(2):
        jobs.features(spark, silver, path)
    return path


def bronze_table(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends to bronze: envelopes and files' rows by day."""
    path = _bronze(spark, sf)
    tables.write_bronze(views.market_events(spark, sf), path)
    days = tables.read_bronze(spark, path).groupBy("domain", "dt").agg(F.count(F.lit(1)).alias("events"), F.count_distinct("event_id").alias("ids"))
    listed = tables.table_files(tables.read_table(spark, path)).count()
    return micros(days.withColumn("has_files", F.lit(listed > 0)))


def silver_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.read_silver(spark, _silver(spark, sf))
    return rounded(rows.select("token_address", "event_timestamp", "event_date", "open", "high", "low", "close", "volume", "currency"))


def silver_quarantine_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.read_silver(spark, _silver(spark, sf), "quarantine")
    return rounded(rows.select("token_address", "event_timestamp", "low", "close", F.array_join("quarantine_reasons", ",").alias("reasons")))


def silver_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What the job itself counted on the way."""
    seen = jobs.silver(spark, _bronze(spark, sf), _path(spark, "silver"))
    return spark.createDataFrame([(seen["valid"], seen["quarantined"])], "valid long, quarantined long")


def gold_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.read_gold(spark, _gold(spark, sf))
    return rounded(rows.select("token_address", "event_timestamp", "close", *K.ENTRY_FEATURES))


def backtest_table(spark: SparkSession, sf: str) -> DataFrame:
    gold, path = _gold(spark, sf), _path(spark, "backtest")
    for _ in range(2):
        metrics = jobs.backtest(spark, gold, path)
    return rounded(metrics)


def _positions(spark: SparkSession, sf: str) -> str:
    """All positions, then those of even id again."""
    path, events = _path(spark, "positions"), views.position_events(spark, sf)
    jobs.positions(events, path)
    jobs.positions(events.where(F.col("position_id") % 2 == 0), path)
    return path


def positions_table(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(jobs.current_positions(spark, _positions(spark, sf)))


def sales_table(spark: SparkSession, sf: str) -> DataFrame:
    sold = jobs.sale_history(spark, _positions(spark, sf))
    return rounded(sold.select("position_id", "event_id", "sell_fraction", "amount_sold", "realized_pnl", "remaining_size"))


def rejections_table(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.rejected_events(spark, _positions(spark, sf)).select("position_id", "event_id", "reason")


def position_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Positions of the older half of the events, upserted by those of all events of positions that have newer ones."""
    events = views.position_events(spark, sf)
    at = F.unix_micros("event_timestamp")
    middle = events.agg(((F.min(at) + F.max(at)) / 2).alias("middle")).scalar()
    older = jobs.positions(events.where(at <= middle))
    moved = events.where(at > middle).select("position_id").distinct()
    return rounded(tables.upsert(older, jobs.positions(events.join(moved, "position_id", "left_semi")), ["position_id"]))


def _land(spark: SparkSession, rows: DataFrame, name: str) -> str:
    """Landed responses as NDJSON files."""
    path = _path(spark, name)
    rows.write.json(path, ignoreNullFields=False, compression="gzip")
    return path


def _ingested(spark: SparkSession, source: str, domain: str, rows: DataFrame) -> DataFrame:
    bronze = _path(spark, "bronze")
    jobs.ingest(spark, source, domain, _land(spark, rows, "landed"), bronze)
    return tables.read_bronze(spark, bronze).where(F.col("domain") == domain)


def holder_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Two holder responses for each part: an old one with half of every amount, then the right one."""
    item = F.struct("owner", "amount")
    held = views.holdings(spark, sf).groupBy("token_address").agg(F.collect_list(item).alias("items"))
    figures = views.supply(spark, sf).select("token_address", "top10_hold_percent", F.col("total_holders").alias("holder"))
    polls = F.explode(F.array(F.lit(0), F.lit(1))).alias("poll")
    rows = figures.join(held, "token_address", "left").select("*", polls)
    items = F.transform("items", lambda i: F.struct(i["owner"].alias("owner"), (i["amount"] / F.when(F.col("poll") == 0, 2.0).otherwise(1.0)).alias("amount")))
    data = F.struct(F.coalesce(items, F.array().cast("array<struct<owner:string,amount:double>>")).alias("items"), "top10_hold_percent", "holder")
    at = F.timestamp_micros(F.unix_micros(_now()) + F.col("poll") * 3_600_000_000)
    return rows.select(F.col("token_address").alias("request_key"), at.alias("received_at"), F.to_json(F.struct(data.alias("data"))).alias("response"))


def wallet_polls(spark: SparkSession, sf: str) -> DataFrame:
    """Two overlapping polls of each supplier's history: its lines up to the fourth of an order, then all."""
    first = F.filter("history", lambda h: h["line"] <= 4)
    polls = F.array(F.struct(F.lit(0).alias("poll"), first.alias("items")), F.struct(F.lit(1).alias("poll"), F.col("history").alias("items")))
    rows = views.wallet_histories(spark, sf).select("wallet", F.explode(polls).alias("p")).select("wallet", "p.poll", F.col("p.items.t").alias("ts"))
    # A poll that lists nothing is not there; a line without a number is in the second alone.
    rows = rows.where(F.size("ts") > 0)
    at = F.timestamp_micros(F.unix_micros(_now()) + F.col("poll") * 3_600_000_000)
    return rows.select(F.col("wallet").alias("request_key"), at.alias("received_at"), F.to_json("ts").alias("response"))


def mint_accounts(spark: SparkSession, sf: str) -> DataFrame:
    docs = views.mint_documents(spark, sf)
    return docs.select(F.col("token_address").alias("request_key"), F.col("event_timestamp").alias("received_at"), F.col("payload").alias("response"))


def holder_report(spark: SparkSession, sf: str) -> DataFrame:
    envelopes = _ingested(spark, "birdeye", "holder", holder_lists(spark, sf))
    return rounded(jobs.holder_report(envelopes))


def held_amounts(spark: SparkSession, sf: str) -> DataFrame:
    """Holders exploded from the newest list of each token."""
    envelopes = _ingested(spark, "birdeye", "holder", holder_lists(spark, sf))
    return rounded(holders.explode_holders(jobs.newest_snapshots(envelopes)))


def outflow_report_job(spark: SparkSession, sf: str) -> DataFrame:
    envelopes = _ingested(spark, "helius", "wallet", wallet_polls(spark, sf))
    return rounded(jobs.outflow_report(envelopes, views.monitored_wallets(spark, sf), _now(), views.RECENCY_HOURS))


def security_report(spark: SparkSession, sf: str) -> DataFrame:
    tokens = views.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("token_address"))
    report = jobs.security_report(
        tokens,
        _ingested(spark, "birdeye", "holder", holder_lists(spark, sf)),
        _ingested(spark, "helius", "wallet", wallet_polls(spark, sf)),
        _ingested(spark, "solana_rpc", "security", mint_accounts(spark, sf)),
        views.monitored_wallets(spark, sf),
        F.lit("1998-12-01").cast("timestamp"),
    )
    return report.select(
        "token_address",
        F.col("rug_risk_score").cast("long").alias("rug_risk_score"),
        "risk_tier",
        F.array_join("data_gaps", "; ").alias("data_gaps"),
    )


def security_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Security responses of parts; those of the smallest size have no data."""
    data = F.when(F.col("p_size") > 1, F.struct(F.struct(F.col("p_size").alias("size"), F.col("p_name").alias("name")).alias("data"))).otherwise(F.lit(None))
    rows = views.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("request_key"), _now().alias("received_at"), F.coalesce(F.to_json(data), F.lit("{}")).alias("response")
    )
    found = _ingested(spark, "birdeye", "security", rows)
    size = F.get_json_object("payload", "$.size").try_cast("long").alias("size")
    return found.select("source", "domain", "token_address", size, F.get_json_object("payload", "$.name").alias("name"))


def _scan_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Two scans on one day: each lists every supplier, the first with half of the volume."""
    rows = views.candidates(spark, sf).select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("poll"))
    volume = F.col("volume_24h_usd") * F.when(F.col("poll") == 0, 0.5).otherwise(1.0)
    item = F.struct(F.col("token_address").alias("address"), "symbol", "liquidity", volume.alias("volume_24h_usd"), "holder", "trade_24h_count")
    data = F.struct(F.struct(F.array(item).alias("items")).alias("data"))
    at = F.timestamp_micros(F.unix_micros(_now()) + F.col("poll") * 3_600_000_000)
    return rows.select(F.lit("scan").alias("request_key"), at.alias("received_at"), F.to_json(data).alias("response"))


def _scanned(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return jobs.discover(spark, _land(spark, _scan_responses(spark, sf), "scan"), _path(spark, "bronze"))


def discovered(spark: SparkSession, sf: str) -> DataFrame:
    """Valid and quarantined candidates of a day with two scans, one row a token."""
    valid, bad = _scanned(spark, sf)
    columns = ["token_address", "symbol", "volume_24h_usd", "holder"]
    rows = valid.select(*columns, F.lit("valid").alias("outcome")).unionByName(bad.select(*columns, F.col("problem").alias("outcome")))
    return rounded(rows)


def _scan_scores(spark: SparkSession, sf: str) -> DataFrame:
    tier = F.when(F.col("s_nationkey") < 8, "LOW").when(F.col("s_nationkey") < 16, "MODERATE").otherwise("HIGH")
    return views.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("token_address"), F.col("s_nationkey").alias("rug_risk_score"), tier.alias("risk_tier")
    )


def watchlist_scan(spark: SparkSession, sf: str) -> DataFrame:
    """All valid candidates of a day with two scans, decided, ranked, written and read back."""
    valid, _ = _scanned(spark, sf)
    path = _path(spark, "scans")
    jobs.watchlist_scan(valid, _scan_scores(spark, sf), None, None, path, max_to_score=None, scan_time=_now())
    return rounded(tables.read_table(spark, path).select("scan_timestamp", "token_address", "severity", "action", "confidence"))


def landed_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Landed lines that give no envelope: those of every third user are cut short, of every fifth lack the response."""
    rows = views.candle_responses(spark, sf).withColumn("n", F.col("request_key").cast("long"))
    line = F.to_json(F.struct("request_key", "received_at", F.when(F.col("n") % 5 != 0, F.col("response")).alias("response")))
    path = _path(spark, "landed")
    rows.select(F.when(F.col("n") % 3 == 0, F.substring(line, 1, 20)).otherwise(line).alias("value")).write.text(path)
    out = _path(spark, "rejects")
    jobs.ingest(spark, "birdeye", "market", path, _path(spark, "bronze"), rejects_path=out)
    return tables.read_table(spark, out).groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


def _post_responses(docs: DataFrame, most: int = 500) -> DataFrame:
    """Landed responses of news posts, each of one language and of ids in a range of ``most``."""
    post = F.struct(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("title"))
    rows = docs.groupBy("lang", F.floor(F.col("doc_id") / most).alias("part")).agg(F.collect_list(post).alias("results"))
    return rows.select(F.col("lang").alias("request_key"), _now().alias("received_at"), F.to_json(F.struct("results")).alias("response"))


def news_posts(spark: SparkSession, sf: str) -> DataFrame:
    """documents as news posts, whole texts in bounded responses of a language: none is lost."""
    responses = _post_responses(views.table(spark, sf, "documents"))
    found = _ingested(spark, "cryptopanic", "news", responses)
    return found.select("token_address", F.get_json_object("payload", "$._post_id").cast("long").alias("doc_id"))


def _feed(spark: SparkSession, items: DataFrame, per_file: int = 500) -> str:
    """Rows (doc_id, item) as RSS files of a feed."""
    path = _path(spark, "feed")
    part = F.floor(F.col("doc_id") / per_file).alias("part")
    listed = items.groupBy(part).agg(F.sort_array(F.collect_list(F.struct("doc_id", "item")))["item"].alias("items"))
    text = F.concat(F.lit("<rss><channel>"), F.array_join("items", "\n"), F.lit("</channel></rss>"))
    listed.select("part", text.alias("value")).write.partitionBy("part").text(path)
    return path


def rss_items(spark: SparkSession, sf: str) -> DataFrame:
    """documents as two RSS feeds, written as XML, read, cut to the first items of each and brought into envelopes."""
    text = F.regexp_replace("text", r"[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]", "")  # not allowed in XML
    text = F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    item = F.concat(
        F.lit("<item><title>n"), F.col("doc_id").cast("string"), F.lit("</title><description>"), F.coalesce(text, F.lit("")),
        F.lit("</description><link>https://x.example/"), F.col("doc_id").cast("string"),
        F.lit("</link><pubDate>"), F.date_format(F.timestamp_seconds(F.col("doc_id") * 60), "EEE, dd MMM yyyy HH:mm:ss 'GMT'"), F.lit("</pubDate></item>"),
    )
    docs = views.table(spark, sf, "documents").withColumn("item", item)
    paths = {feed: _feed(spark, docs.where(F.col("doc_id") % 2 == rank)) for rank, feed in enumerate(K.DEFAULT_FEEDS)}
    items = feeds.read_feeds(spark, paths)
    rows = feeds.feed_envelopes(items, None, 10, _now())
    title = F.get_json_object("payload", "$.title")
    return micros(rows.select("source", "token_address", "event_timestamp", F.substr(title, F.lit(2)).cast("long").alias("doc_id")))


def feed_times(spark: SparkSession, sf: str) -> DataFrame:
    """RFC-822 dates of the events, parsed."""
    text = F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss '+0000'")
    return micros(views.table(spark, sf, "events").select("event_id", feed_time(text).alias("time")))


def news_report(spark: SparkSession, sf: str) -> DataFrame:
    """The job over a feed of documents: all items that fit the limit, classified."""
    docs = views.table(spark, sf, "documents").withColumn("title", F.concat(F.lit("n"), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 3 == 0, " hacked").otherwise("")))
    path = _feed(spark, docs.withColumn("item", F.concat(F.lit("<item><title>"), F.col("title"), F.lit("</title></item>"))))
    report = jobs.news_report(spark, {"coindesk.com": path}, None, 1_000_000_000)
    return report.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def exchanged_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """Envelopes as NDJSON and as keyed messages, read back: the counts and keys stay."""
    events = views.market_events(spark, sf)
    path = _path(spark, "ndjson")
    tables.write_ndjson(events, path)
    read = spark.read.schema(K.ENVELOPE_SCHEMA).json(path)
    keyed = ingest.keyed_messages(read).groupBy("key").agg(F.count(F.lit(1)).alias("messages"))
    ids = read.groupBy(F.col("token_address").alias("key")).agg(F.count_distinct("event_id").alias("ids"))
    return keyed.join(ids, "key").withColumnRenamed("key", "token_address")


def dead_letter_table(spark: SparkSession, sf: str) -> DataFrame:
    """Messages through the file stream: what is no tick ends in the dead-letter table."""
    run = _path(spark, "messages")
    views.tick_messages(spark, sf).write.text(f"{run}/in")
    decoded = ingest.decode(ingest.file_messages(pin_utc(spark), f"{run}/in"))
    ingest.start_table_sink(ingest.dead_letters(decoded), f"{run}/dead", f"{run}/checkpoint", None).awaitTermination()
    return spark.read.schema("value string, problem string").parquet(f"{run}/dead").groupBy("problem").agg(F.count(F.lit(1)).alias("messages"))


def _trained(spark: SparkSession, sf: str, kind: models.ModelKind) -> tuple[DataFrame, models.Training]:
    gold = cut(features.token_features(views.candles(spark, sf)))
    return gold, models.train(gold, kind)


def train_counts(spark: SparkSession, sf: str, kind: models.ModelKind) -> DataFrame:
    _, trained = _trained(spark, sf, kind)
    done = trained.models.select("token_address", "converged")
    runs = trained.runs.join(done, "token_address")
    return rounded(runs.select("token_address", "model_type", "n_train", "n_test", "positive_rate_train", "positive_rate_test", "converged"))


def train_entry_counts(spark: SparkSession, sf: str) -> DataFrame:
    return train_counts(spark, sf, models.ENTRY)


def train_exit_counts(spark: SparkSession, sf: str) -> DataFrame:
    return train_counts(spark, sf, models.EXIT)


def fit_optimality(spark: SparkSession, sf: str) -> DataFrame:
    """The largest gradient of each entry model's objective at its stored weights, from the model table."""
    kind = models.ENTRY
    gold, trained = _trained(spark, sf, kind)
    split = labels.chronological_split(models.labelled(gold, kind))
    fitted = trained.models.select("token_address", "mean", "scale", "coef", "intercept")
    rows = score(split.where("is_train"), fitted, kind.features).where("probability is not null").join(fitted, "token_address")
    error = F.col("probability") - F.col(kind.label)
    z = [(F.col(f).cast("double") - F.col("mean")[i]) / F.col("scale")[i] for i, f in enumerate(kind.features)]
    sums = rows.groupBy("token_address").agg(
        F.sum(error).alias("g"), *[F.sum(error * c).alias(f"g{i}") for i, c in enumerate(z)], F.first("coef").alias("coef")
    )
    whole = [F.col("g"), *[F.col(f"g{i}") + F.col("coef")[i] for i in range(len(z))]]
    return sums.select("token_address", (F.round(F.greatest(*[F.abs(c) for c in whole]), 4) + 0.0).alias("gradient"))


def score_champion(spark: SparkSession, sf: str) -> DataFrame:
    """Rows scored by the champions' models after two training runs: one row in, one out."""
    gold = cut(features.token_features(views.candles(spark, sf)))
    stored, runs = _path(spark, "models"), _path(spark, "runs")
    for _ in range(2):
        trained = models.train(gold, models.ENTRY)
        trained.models.write.mode("append").partitionBy("model_type").parquet(stored)
        trained.runs.write.mode("append").partitionBy("model_type").parquet(runs)
    jobs.promote(spark, runs, None, _path(spark, "champions"))
    champions = models.latest_runs(tables.read_table(spark, runs))
    chosen = models.models_of(tables.read_table(spark, stored), champions, models.ENTRY)
    scored = score(gold, chosen, models.ENTRY.features)
    return scored.groupBy("token_address").agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.col("probability").between(0, 1)).alias("has_model")
    )


def ema_long_series(spark: SparkSession, sf: str) -> DataFrame:
    """EMA and MACD over one long series a kind of event, whose blocks carry values on."""
    rows = views.ticks(spark, sf).withColumnRenamed("price", "close").withColumn("volume", F.lit(1.0))
    return rounded(features.add_ema_macd(rows).select("event_id", "ema_fast", "ema_slow", "macd", "macd_signal"))


def prices_as_of_all(spark: SparkSession, sf: str) -> DataFrame:
    """For every tick of every token, the price of the tick at or before a minute earlier."""
    ticks = views.ticks(spark, sf)
    asks = ticks.select(F.col("event_id").alias("request_id"), "token_address", (F.col("event_timestamp") - F.expr("interval 1 minute")).alias("event_timestamp"))
    return rounded(prices.prices_as_of(asks, ticks).select("request_id", "token_address", "price"))


def scan_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows received by each scan and outcomes of its candidates."""
    envelopes = landed.screened_tokens(_scan_responses(spark, sf))
    return micros(discovery.scan_counts(discovery.parse_candidates(envelopes)))


def decision_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return decided(spark, sf).select("token_address", F.array_join("reasons", "; ").alias("reasons"))


def promotion_reasons(spark: SparkSession, sf: str) -> DataFrame:
    made = models.promotion_decisions(models.latest_runs(views.model_runs(spark, sf)), views.champions(spark, sf))
    return made.select("token_address", "model_type", F.array_join("reasons", "; ").alias("reasons"))


def position_values(spark: SparkSession, sf: str) -> DataFrame:
    """What every open position is worth at the newest price of its token."""
    quotes = views.position_events(spark, sf).where(F.col("event_type") == "price")
    state = jobs.positions(views.position_events(spark, sf))
    return rounded(jobs.open_positions_view(state, quotes).select("position_id", "position_value"))


LAKE = {
    f.__name__: f
    for f in (
        bronze_table, silver_table, silver_quarantine_table, silver_counts, gold_table, backtest_table, positions_table,
        sales_table, rejections_table, position_changes, holder_report, held_amounts, outflow_report_job, security_report,
        security_metadata, discovered, watchlist_scan, landed_rejects, news_posts, rss_items, feed_times, news_report,
        exchanged_envelopes, dead_letter_table, train_entry_counts, train_exit_counts, fit_optimality, score_champion,
        ema_long_series, prices_as_of_all, scan_counts, decision_reasons,
        promotion_reasons, position_values,
    )
}
