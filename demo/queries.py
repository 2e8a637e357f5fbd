"""Every registered query: the operators over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demo import views
from tickloom import constants as K
from tickloom.functions.canonical import event_id
from tickloom.functions.news import classify, credibility, mentions, url_domain
from tickloom.functions.rules import mint_flags
from tickloom.operators import backtest as bt
from tickloom.operators import discovery, features, holders, labels, ledger, prices, silver, wallets, watchlist
from tickloom.operators.logistic import fit_models
from tickloom.operators.scoring import classifier_metrics, score
from tickloom.operators.series import lay_out
from tickloom.plans import jobs, models, signals
from tickloom.session import checkpoint_root, cut, pin_utc
from tickloom.sources import backfill, feeds, landed, tables
from tickloom.streaming import alerts, ingest

ALERT_WINDOW = timedelta(hours=6)
RETURNS = ("return_1h", "return_4h", "return_24h")


def micros(df: DataFrame) -> DataFrame:
    """Times as microseconds since 1970, for comparison."""
    return df.withColumns({n: F.unix_micros(n) for n, kind in df.dtypes if kind == "timestamp"})


def rounded(df: DataFrame, exact: tuple[str, ...] = ()) -> DataFrame:
    """Doubles to six places, times as microseconds since 1970, for comparison.

    ``exact`` names columns that are one division away from the data: they are compared as they are.
    """
    changed = {}
    for name, kind in df.dtypes:
        if name in exact:
            continue
        if kind == "double":
            changed[name] = F.round(name, 6)
        elif kind == "timestamp":
            changed[name] = F.unix_micros(name)
    return df.withColumns(changed) if changed else df


def silver_valid(spark: SparkSession, sf: str) -> DataFrame:
    valid, _ = silver.split(silver.mark(views.market_events(spark, sf)))
    return rounded(valid.select("token_address", "event_timestamp", "open", "high", "low", "close", "volume", "currency"))


def silver_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = silver.split(silver.mark(views.market_events(spark, sf)))
    reasons = F.array_join("quarantine_reasons", ",").alias("reasons")
    return rounded(bad.select("token_address", "event_timestamp", "low", "close", reasons))


def event_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = silver.dedup(views.market_events(spark, sf))
    return rounded(kept.select("token_address", "event_timestamp", "ingestion_timestamp"))


def event_id_hash(spark: SparkSession, sf: str) -> DataFrame:
    payload = F.concat(F.lit('{"type": "'), F.col("event_type"), F.lit('", "props": '), F.col("props"), F.lit("}"))
    key = event_id(F.lit("demo"), F.col("user_id").cast("string"), F.col("ts"), payload)
    return views.table(spark, sf, "events").select(F.col("event_id").alias("row_id"), key.alias("event_key"))


def bronze_partition_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = tables.partition_counts(views.market_events(spark, sf))
    return counts.withColumn("dt", F.col("dt").cast("string"))


def latest_partition(spark: SparkSession, sf: str) -> DataFrame:
    events = views.table(spark, sf, "events").withColumn("dt", F.to_date("ts"))
    return rounded(tables.latest_partition(events).select("event_id", F.col("dt").cast("string").alias("dt"), "value"))


def _series(spark: SparkSession, sf: str):
    return lay_out(views.candles(spark, sf))


def returns(spark: SparkSession, sf: str) -> DataFrame:
    df = features.add_returns(views.candles(spark, sf), [1, 4, 24])
    return df.select("event_id", *RETURNS)


def sma(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.add_sma(views.candles(spark, sf), 20).select("event_id", "sma_20"))


def volatility(spark: SparkSession, sf: str) -> DataFrame:
    df = features.with_window_features(_series(spark, sf)).frame()
    return rounded(df.select("event_id", "volatility_20"))


def rsi(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.add_rsi(views.candles(spark, sf)).select("event_id", "rsi_14"))


def ema_macd(spark: SparkSession, sf: str) -> DataFrame:
    df = features.add_ema_macd(views.candles(spark, sf))
    return rounded(df.select("event_id", "ema_fast", "ema_slow", "macd", "macd_signal"))


def token_features(spark: SparkSession, sf: str) -> DataFrame:
    df = features.token_features(views.candles(spark, sf))
    return rounded(df.select("event_id", "token_address", "event_timestamp", "close", "volume", *K.ENTRY_FEATURES), RETURNS)


def _signals(spark: SparkSession, sf: str):
    return features.with_window_features(_series(spark, sf)).rows(bt.add_rsi_signals)


def rsi_signals(spark: SparkSession, sf: str) -> DataFrame:
    return _signals(spark, sf).frame().select("event_id", "signal")


def positions_latch(spark: SparkSession, sf: str) -> DataFrame:
    df = bt.with_positions(_signals(spark, sf)).frame()
    return df.select("event_id", "signal", F.col("position").cast("long").alias("position"))


def equity_curve(spark: SparkSession, sf: str) -> DataFrame:
    df = bt.simulate(_signals(spark, sf)).frame()
    return rounded(df.select("event_id", "cost", "strategy_return", "equity", "buy_hold_equity", "drawdown"))


def backtest_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(jobs.flagship(views.candles(spark, sf)))


def triple_barrier(spark: SparkSession, sf: str) -> DataFrame:
    return labels.with_entry_label(_series(spark, sf)).frame().select("event_id", "label")


def exit_label(spark: SparkSession, sf: str) -> DataFrame:
    return labels.with_exit_label(_series(spark, sf)).frame().select("event_id", "exit_label")


def simulated_position_features(spark: SparkSession, sf: str) -> DataFrame:
    df = labels.with_position_features(_series(spark, sf)).frame()
    held = F.col("periods_held").cast("long").alias("periods_held")
    return df.select("event_id", "unrealized_return", held, "drawdown_from_high")


def chronological_split(spark: SparkSession, sf: str) -> DataFrame:
    return labels.chronological_split(views.candles(spark, sf)).select("event_id", "is_train")


def training_ready(spark: SparkSession, sf: str) -> DataFrame:
    series = labels.with_entry_label(features.with_window_features(_series(spark, sf)))
    rows = labels.drop_incomplete(series.frame(), ("return_24h", "sma_20", "volatility_20", "rsi_14"), "label")
    return labels.trainable(labels.chronological_split(rows), "label")


def classifier_report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(classifier_metrics(views.scored_events(spark, sf), "label"))


def _train(spark: SparkSession, sf: str, kind: models.ModelKind) -> DataFrame:
    runs = models.train(cut(features.token_features(views.candles(spark, sf))), kind).runs
    return rounded(runs.select("token_address", "model_type", "n_train", "n_test", *models.METRICS))


def train_entry(spark: SparkSession, sf: str) -> DataFrame:
    return _train(spark, sf, models.ENTRY)


def train_exit(spark: SparkSession, sf: str) -> DataFrame:
    return _train(spark, sf, models.EXIT)


def fit_model(spark: SparkSession, sf: str) -> DataFrame:
    """A one-feature model per user: does ``k`` divide by three, given the price?"""
    rows = views.candles(spark, sf).withColumn("label", (F.col("volume") % 3 == 0).cast("double"))
    fitted = fit_models(rows, ["close"], "label")
    first = {n: F.col(n)[0].alias(n) for n in ("mean", "scale", "coef")}
    return rounded(fitted.select("token_address", *first.values(), "intercept", "n_train"), ("mean",)).withColumn("mean", F.round("mean", 9))


def score_model(spark: SparkSession, sf: str) -> DataFrame:
    scored = score(views.candles(spark, sf), views.simple_models(spark, sf), ("close", "volume"))
    return rounded(scored.select("event_id", "probability"))


def _promotions(spark: SparkSession, sf: str) -> DataFrame:
    latest = models.latest_runs(views.model_runs(spark, sf))
    return models.promotion_decisions(latest, views.champions(spark, sf))


def promotion_decisions(spark: SparkSession, sf: str) -> DataFrame:
    decided = _promotions(spark, sf)
    return rounded(decided.select("token_address", "model_type", "run_id", "roc_auc", "promote", F.size("reasons").alias("n_reasons")))


def champion_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(models.next_champions(views.champions(spark, sf), _promotions(spark, sf)))


def holder_concentration(spark: SparkSession, sf: str) -> DataFrame:
    return holders.concentration(views.holdings(spark, sf))


def holder_tiers(spark: SparkSession, sf: str) -> DataFrame:
    judged = holders.verdicts(holders.concentration(views.holdings(spark, sf)), views.supply(spark, sf))
    return rounded(judged.select("token_address", "verdict_share", "verdict_basis", "verdict_tier", "supply_tier"))


def _outflows(spark: SparkSession, sf: str) -> DataFrame:
    moves = wallets.transfers(views.wallet_transactions(spark, sf), sent=True)
    return wallets.outflows(moves, F.lit(views.NOW).cast("timestamp"), views.RECENCY_HOURS)


def wallet_outflows(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_outflows(spark, sf))


def mint_authority(spark: SparkSession, sf: str) -> DataFrame:
    mint, freeze = mint_flags(F.col("payload"))
    return views.mint_documents(spark, sf).select("token_address", mint.alias("mint_active"), freeze.alias("freeze_active"))


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    parts = views.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("token_address"),
        F.concat(F.lit("src"), (F.col("p_partkey") % 23).cast("string")).alias("symbol"),
    )
    tiers = signals.supply_tiers(views.supply(spark, sf))
    flags = _outflows(spark, sf).groupBy("token_address").agg(F.bool_or("has_recent_outflow").alias("dev_outflow"))
    mints = signals.mint_signals(views.mint_documents(spark, sf))
    return signals.security_scores(parts, tiers, flags, mints)


def rug_score(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(spark, sf).select(
        "token_address",
        F.col("rug_risk_score").cast("long").alias("rug_risk_score"),
        "risk_tier",
        F.array_join("reasons", "; ").alias("reasons"),
        F.array_join("data_gaps", "; ").alias("data_gaps"),
    )


def news_events(spark: SparkSession, sf: str) -> DataFrame:
    keywords = F.array_join("matched_keywords", ",").alias("matched_keywords")
    return classify(views.news_items(spark, sf)).select("doc_id", "event_type", keywords)


def news_credibility(spark: SparkSession, sf: str) -> DataFrame:
    return views.news_items(spark, sf).select("doc_id", credibility(F.col("domain")).alias("credibility"))


def url_domains(spark: SparkSession, sf: str) -> DataFrame:
    return views.table(spark, sf, "pages").select("page_id", url_domain(F.col("url")).alias("domain"))


def news_signal(spark: SparkSession, sf: str) -> DataFrame:
    return signals.news_signals(views.news_items(spark, sf))


def screen_candidates(spark: SparkSession, sf: str) -> DataFrame:
    page = discovery.screen(
        views.candidates(spark, sf),
        discovery.ScreenFilters(max_liquidity=900_000, min_holder=20, limit=25, offset=5),
    )
    return rounded(page)


def candidate_quality(spark: SparkSession, sf: str) -> DataFrame:
    judged = discovery.judge(views.candidates(spark, sf))
    return judged.select("token_address", F.coalesce("problem", F.lit("valid")).alias("outcome"))


def candidate_counts(spark: SparkSession, sf: str) -> DataFrame:
    return discovery.quality_counts(views.candidates(spark, sf))


def momentum(spark: SparkSession, sf: str) -> DataFrame:
    return discovery.with_momentum(views.candidates(spark, sf)).select("token_address", "momentum_tier")


def top_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(discovery.top_by_volume(views.candidates(spark, sf)).select("token_address", "volume_24h_usd"))


def decided(spark: SparkSession, sf: str) -> DataFrame:
    probabilities = views.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("token_address"),
        F.when(F.col("p_partkey") % 4 != 0, (F.col("p_partkey") * 37 % 100) / 100.0).alias("probability"),
    )
    moved = views.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("token_address"),
        F.when(F.col("p_size") % 3 == 0, "STRONG").when(F.col("p_size") % 3 == 1, "MODERATE").alias("momentum_tier"),
    )
    return signals.decisions(_scores(spark, sf), signals.news_signals(views.news_items(spark, sf)), probabilities, moved)


def decisions(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        decided(spark, sf).select(
            "token_address",
            "action",
            "confidence",
            "override_triggered",
            F.size("reasons").cast("long").alias("n_reasons"),
            F.array_join("risks", "; ").alias("risks"),
        )
    )


def watchlist_ranked(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(watchlist.rank(decided(spark, sf)).select("rank", "token_address", "severity", "confidence"))


def watchlist_union(spark: SparkSession, sf: str) -> DataFrame:
    manual = views.table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("token_address"))
    valid, _ = discovery.split_candidates(views.candidates(spark, sf))
    return discovery.merge_watchlist(manual, valid)


def _replayed(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.replay(views.position_events(spark, sf))


def position_ledger(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ledger.positions(_replayed(spark, sf)))


def position_sales(spark: SparkSession, sf: str) -> DataFrame:
    sold = ledger.sales(_replayed(spark, sf))
    return rounded(sold.select("position_id", "event_id", "sell_fraction", "amount_sold", "realized_pnl", "remaining_size"))


def position_rejections(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.rejections(_replayed(spark, sf)).select("position_id", "event_id", "reason")


def open_positions_pnl(spark: SparkSession, sf: str) -> DataFrame:
    quotes = views.position_events(spark, sf).where(F.col("event_type") == "price").where(F.col("token_address") != "token-3")
    view = jobs.open_positions_view(ledger.positions(_replayed(spark, sf)), quotes)
    return rounded(view.select("position_id", "remaining_size", "current_price", "unrealized_pnl", "unrealized_pnl_pct"))


def prices_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Price of the ``view`` token when each ``purchase`` happened."""
    events = views.ticks(spark, sf)
    quotes = events.where(F.col("token_address") == "view")
    asks = events.where(F.col("token_address") == "purchase").select(
        F.col("event_id").alias("request_id"), F.lit("view").alias("token_address"), "event_timestamp"
    )
    return rounded(prices.prices_as_of(asks, quotes).select("request_id", "price"))


def price_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return micros(prices.price_alerts(views.ticks(spark, sf), ALERT_WINDOW))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/tickloom-{name}/{uuid.uuid4().hex}"


def _fed(spark: SparkSession, sf: str, order: tuple[int, ...], run: str, start: Callable) -> None:
    """Lands the four time slices of the ticks in ``order`` and lets the stream catch up after each, from its checkpoint."""
    slices = views.tick_slices(spark, sf)
    ticks = slices.drop("slice")
    for part in order:
        slices.where(F.col("slice") == part).drop("slice").write.mode("append").parquet(f"{run}/in")
        start(pin_utc(spark).readStream.schema(ticks.schema).parquet(f"{run}/in")).awaitTermination()


def price_alerts_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same alerts from a stream that gets the ticks in four parts and is started again for each."""
    run = _scratch(spark, "stream")

    def start(ticks: DataFrame):
        return ingest.start_table_sink(alerts.price_alerts(ticks, ALERT_WINDOW), f"{run}/alerts", f"{run}/checkpoint", None)

    _fed(spark, sf, (0, 1, 2, 3), run, start)
    return micros(spark.read.schema(alerts.ALERT_SCHEMA).parquet(f"{run}/alerts"))


def late_ticks(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks that come too late when the third of four parts comes last, by token."""
    run = _scratch(spark, "late")
    _fed(spark, sf, (0, 1, 3, 2), run, lambda ticks: alerts.count_late(ticks, run, f"{run}/checkpoint", every=None))
    late = tables.read_table(spark, f"{run}/late")
    return late.groupBy("token_address").agg(F.count(F.lit(1)).alias("late"))


def backfill_chunks(spark: SparkSession, sf: str) -> DataFrame:
    spans = (
        views.table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").cast("string").alias("token_address"))
        .agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))
    )
    return backfill.request_chunks(spans, "4H")


def landed_candles(spark: SparkSession, sf: str) -> DataFrame:
    rows = landed.candles(views.candle_responses(spark, sf))
    close = F.get_json_object("payload", "$.c").try_cast("double").alias("close")
    return micros(rows.select("source", "domain", "token_address", "event_timestamp", close))


def landed_prices(spark: SparkSession, sf: str) -> DataFrame:
    rows = landed.latest_prices(views.price_responses(spark, sf))
    price = F.get_json_object("payload", "$.value").try_cast("double").alias("price")
    return micros(rows.select("token_address", "event_timestamp", price))


def screened_tokens(spark: SparkSession, sf: str) -> DataFrame:
    rows = landed.screened_tokens(views.screener_responses(spark, sf))
    return micros(rows.select("domain", "token_address", "event_timestamp", "payload"))


def decoded_ticks(spark: SparkSession, sf: str) -> DataFrame:
    decoded = ingest.decode(views.tick_messages(spark, sf))
    return micros(decoded.select("event_id", "token_address", "event_timestamp", "price", "problem"))


def feed_items(spark: SparkSession, sf: str) -> DataFrame:
    """Of the first ten items of each feed, those that mention a topic."""
    first = feeds.first_items(views.feed_items(spark, sf), 10)
    return first.where(mentions(F.lit("EN"), F.col("title"), F.col("summary"))).select("doc_id", "feed", "item_rank")


def latest_prices(spark: SparkSession, sf: str) -> DataFrame:
    return micros(prices.latest_prices(views.ticks(spark, sf)))


def latest_runs(spark: SparkSession, sf: str) -> DataFrame:
    rows = models.latest_runs(views.model_runs(spark, sf))
    return rounded(rows.select("token_address", "model_type", "run_id", "start_time", "roc_auc", "brier_score"))


def outflow_report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(wallets.outflow_report(views.monitored_wallets(spark, sf), _outflows(spark, sf)))


def candidate_lines(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(discovery.display_rows(views.candidates(spark, sf)))


def watchlist_records(spark: SparkSession, sf: str) -> DataFrame:
    record = watchlist.flat_record(watchlist.with_severity(decided(spark, sf)), F.lit(views.NOW).cast("timestamp"))
    return rounded(record.drop("reasons"))


def watchlist_view(spark: SparkSession, sf: str) -> DataFrame:
    """Nations and the busiest valid candidates, with latest price and recommendation where known."""
    manual = views.table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("token_address"))
    valid, _ = discovery.split_candidates(views.candidates(spark, sf))
    quotes = views.candles(spark, sf).withColumnRenamed("close", "price")
    view = jobs.watchlist_view(manual, discovery.top_by_volume(valid), quotes, decided(spark, sf))
    return view.select("token_address", "source", "price", "action")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        silver_valid,
        silver_quarantine,
        event_dedup,
        event_id_hash,
        bronze_partition_counts,
        latest_partition,
        returns,
        sma,
        volatility,
        rsi,
        ema_macd,
        token_features,
        rsi_signals,
        positions_latch,
        equity_curve,
        backtest_metrics,
        triple_barrier,
        exit_label,
        simulated_position_features,
        chronological_split,
        training_ready,
        train_entry,
        train_exit,
        fit_model,
        score_model,
        promotion_decisions,
        champion_upsert,
        holder_concentration,
        holder_tiers,
        wallet_outflows,
        rug_score,
        news_events,
        news_credibility,
        url_domains,
        news_signal,
        screen_candidates,
        candidate_quality,
        candidate_counts,
        momentum,
        top_candidates,
        decisions,
        watchlist_ranked,
        watchlist_union,
        position_ledger,
        position_sales,
        position_rejections,
        open_positions_pnl,
        prices_as_of,
        price_alerts,
        price_alerts_stream,
        late_ticks,
        backfill_chunks,
        landed_candles,
        landed_prices,
        screened_tokens,
        decoded_ticks,
        feed_items,
        latest_prices,
        latest_runs,
        outflow_report,
        candidate_lines,
        watchlist_records,
        watchlist_view,
    )
} | {"classifier_metrics": classifier_report, "mint_flags": mint_authority}
