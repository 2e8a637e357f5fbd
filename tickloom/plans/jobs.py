"""End-to-end jobs: each reads tables, declares one plan and writes tables.

Jobs take paths. Every write is an append or a replacement of whole partitions that is seen whole or
not at all, so a job can be run again after a failure and readers always find a whole table.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom import constants as K
from tickloom.functions.news import classify
from tickloom.operators import backtest as bt
from tickloom.operators import discovery, holders, ledger, prices, wallets, watchlist
from tickloom.operators.features import token_features, with_window_features
from tickloom.operators.series import lay_out
from tickloom.operators.silver import mark
from tickloom.plans import models, signals
from tickloom.session import cut, cuts_removed
from tickloom.sources import feeds, keyed, landed, tables, versions


#: Monitored wallets, some dozen bytes each, that are broadcast at most.
MAX_WATCHED = 1_000_000


def ingest(
    spark: SparkSession,
    source: str,
    domain: str,
    landed_path: str,
    bronze_path: str,
    by_token: bool = False,
    rejects_path: str | None = None,
) -> None:
    """Landed responses of one source to bronze; lines that give no envelope to ``rejects_path`` with their reason."""
    lines = landed.read_landed(spark, landed_path)
    tables.write_bronze(landed.ADAPTERS[(source, domain)](lines), bronze_path, by_token)
    if rejects_path is not None:
        tables.write_parquet(landed.rejects(lines), rejects_path)


def silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    partition_by: Sequence[str] = ("event_date",),
    days: tuple[str, str] | None = None,
) -> dict[str, int]:
    """Bronze market events to silver; valid and quarantined rows go out in one pass and are counted on the way.

    ``days`` (first and last, inclusive) reads and replaces only those days: copies of an event share
    its time, so they are on the same day and deduplication stays exact.

    Pass ``("token_address", "event_date")`` for folders per token; the default keeps the number of
    folders independent of the number of tokens and sorts by token, so reads skip by file statistics.
    """
    events = tables.read_bronze(spark, bronze_path).where(F.col("domain") == "market")
    if days is not None:
        events = events.where(F.col("dt").between(*[F.lit(d).cast("date") for d in days]))
    seen = Observation()
    marked = mark(events.drop("dt", "token")).observe(
        seen, F.count_if("is_valid").alias("valid"), F.count_if(~F.col("is_valid")).alias("quarantined")
    )
    rows = marked.withColumn(tables.QUALITY, F.when(F.col("is_valid"), "valid").otherwise("quarantine"))
    only = None
    if days is not None:
        first, last = map(date.fromisoformat, days)
        only = ("event_date", [str(first + timedelta(days=i)) for i in range((last - first).days + 1)])
    tables.write_partitioned(
        rows.drop("is_valid"),
        silver_path,
        [tables.QUALITY, *partition_by],
        sort_by=["token_address", "event_timestamp"],
        only=only,
    )
    return seen.get


def features(
    spark: SparkSession, silver_path: str, gold_path: str, partition_by: Sequence[str] = ("event_date",)
) -> dict[str, int]:
    """Silver to the gold feature table."""
    seen = Observation()
    gold = token_features(tables.read_silver(spark, silver_path), deal=True).observe(seen, F.count(F.lit(1)).alias("rows"))
    tables.write_partitioned(gold, gold_path, partition_by, sort_by=["token_address", "event_timestamp"])
    return seen.get


def backtest(
    spark: SparkSession,
    gold_path: str,
    out_path: str,
    oversold: float = 30.0,
    overbought: float = 70.0,
    fee_bps: float = 10.0,
) -> DataFrame:
    """Backtest rows to ``out_path``; returns the metrics per token read from them."""
    rows = bt.run_backtest(tables.read_gold(spark, gold_path), oversold, overbought, fee_bps)
    tables.write_partitioned(rows, out_path, ["event_date"], sort_by=["token_address", "event_timestamp"])
    return bt.metrics(tables.read_table(spark, out_path))


def train(spark: SparkSession, gold_path: str, models_path: str, runs_path: str) -> None:
    """Entry and exit models of every token to the model table, their metrics to the runs table; a call's rows share
    a ``run_id`` in both. ``models.models_of`` picks the models of champions or runs."""
    gold = tables.read_gold(spark, gold_path)
    for kind in (models.ENTRY, models.EXIT):
        with cuts_removed(spark):
            result = models.train(gold, kind)
            result.models.write.mode("append").partitionBy("model_type").parquet(models_path)
            result.runs.write.mode("append").partitionBy("model_type").parquet(runs_path)


def promote(spark: SparkSession, runs_path: str, champions: DataFrame | None, out_path: str) -> DataFrame:
    """Decide on the newest run of every token and model type and write the next champion snapshot."""
    challengers = models.latest_runs(tables.read_table(spark, runs_path))
    if champions is None:
        champions = challengers.select("token_address", "model_type", "run_id", *models.METRICS).where(F.lit(False))
    decided = models.promotion_decisions(challengers, champions)
    models.next_champions(champions, decided).write.mode("errorifexists").parquet(out_path)
    return decided


def newest_snapshots(envelopes: DataFrame) -> DataFrame:
    """The newest envelope of each token."""
    return tables.latest_versions(envelopes, ["token_address"], F.struct("event_timestamp", "event_id"))


def holder_report(holder_envelopes: DataFrame) -> DataFrame:
    """Concentration and verdict of every token that has a holder envelope, from its newest one."""
    holder_envelopes = newest_snapshots(holder_envelopes)
    sample = holders.concentration(holders.explode_holders(holder_envelopes), holder_envelopes)
    return holders.verdicts(sample, holders.supply_figures(holder_envelopes))


def outflow_report(
    wallet_envelopes: DataFrame, monitored: DataFrame, now: Column, recency_hours: float = 24.0
) -> DataFrame:
    """Outflows of every monitored (wallet, token_address)."""
    # Histories of other wallets are neither parsed nor shuffled, if the monitored ones can be sent to every executor.
    watched = cut(monitored.select(F.col("wallet").alias("token_address")).distinct())
    if watched.count() <= MAX_WATCHED:
        wallet_envelopes = wallet_envelopes.join(F.broadcast(watched), "token_address", "left_semi")
    moves = wallets.transfers(wallets.parse_transactions(wallet_envelopes), sent=True)
    return wallets.outflow_report(monitored, wallets.outflows(moves, now, recency_hours))


def security_report(
    tokens: DataFrame,
    holder_envelopes: DataFrame,
    wallet_envelopes: DataFrame,
    mint_envelopes: DataFrame,
    monitored: DataFrame,
    now: Column,
) -> DataFrame:
    """Rug-risk score of every token from raw envelopes; ``monitored`` pairs tokens with wallets to watch."""
    tiers = holder_report(holder_envelopes)
    seen = wallet_envelopes.select(F.col("token_address").alias("wallet")).distinct()
    answered = monitored.join(seen, "wallet", "left_semi")
    flags = signals.dev_outflow_flags(answered, outflow_report(wallet_envelopes, answered, now))
    return signals.security_scores(tokens, tiers, flags, signals.mint_signals(mint_envelopes))


def news_report(
    spark: SparkSession, feed_paths: dict[str, str], topic: str | None = None, limit_per_feed: int = 10
) -> DataFrame:
    """Recent items of the feeds, classified by title."""
    rows = feeds.feed_envelopes(feeds.read_feeds(spark, feed_paths), topic, limit_per_feed)
    fields = ("title", "summary", "domain", "link")
    return classify(rows.withColumns({f: F.get_json_object("payload", f"$.{f}") for f in fields}))


def discover(spark: SparkSession, landed_path: str, bronze_path: str) -> tuple[DataFrame, DataFrame]:
    """Screener responses to bronze, then (valid, quarantined) candidates of the newest day."""
    ingest(spark, "birdeye", "discovery", landed_path, bronze_path)
    return latest_candidates(spark, bronze_path)


def latest_candidates(spark: SparkSession, bronze_path: str) -> tuple[DataFrame, DataFrame]:
    events = tables.read_bronze(spark, bronze_path).where(F.col("domain") == "discovery")
    return discovery.split_candidates(discovery.newest(discovery.parse_candidates(tables.latest_partition(events))))


def watchlist_scan(
    candidates: DataFrame,
    scores: DataFrame,
    news: DataFrame | None,
    probabilities: DataFrame | None,
    out_path: str | None = None,
    max_to_score: int | None = 10,
    scan_time: Column | None = None,
) -> DataFrame:
    """Busiest valid candidates (all with ``max_to_score`` None), decided and ranked, one row a token; optionally
    written under dt / run_id."""
    chosen = discovery.with_momentum(discovery.top_by_volume(discovery.newest(candidates), max_to_score))
    base = chosen.join(scores.select("token_address", "rug_risk_score", "risk_tier"), "token_address", "left")
    decided = signals.decisions(base, news, probabilities)
    when = F.current_timestamp() if scan_time is None else scan_time
    ranked = watchlist.rank(decided)
    if out_path is not None:
        record = watchlist.flat_record(ranked, when)
        stamped = record.withColumns(
            {"dt": F.to_date("scan_timestamp"), "run_id": F.date_format("scan_timestamp", "HHmmss")}
        )
        stamped.write.mode("append").partitionBy("dt", "run_id").parquet(out_path)
    return ranked


def watchlist_view(manual: DataFrame, discovered: DataFrame, ticks: DataFrame, decided: DataFrame) -> DataFrame:
    """Watchlist tokens with source, latest price and recommendation (null where unknown)."""
    merged = discovery.merge_watchlist(manual, discovered)
    return merged.join(prices.latest_prices(ticks), "token_address", "left").join(decided, "token_address", "left")


def manual_watchlist(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t in K.MANUAL_WATCHLIST], "token_address string")


def positions(events: DataFrame, out_path: str | None = None) -> DataFrame:
    """Fold position events into the tables of ``out_path``; returns the positions that they touch.

    Call it with new events only: a position goes on from its stored state, and only positions with events are written.
    Events that are not later than the last of their position (late ones, or ones sent again) make it be replayed from
    its events in the event table, where an event counts once; its older sales and rejections no longer count then.
    Tables are read with ``current_positions``, ``sale_history`` and ``rejected_events``. A call that failed can be
    repeated: states are written last.
    """
    if out_path is None:
        return ledger.positions(ledger.replay(events))
    spark = events.sparkSession
    names = {n: f"{out_path.rstrip('/')}/{n}" for n in ("events", "states", "sales", "rejections")}
    run = keyed.next_run(spark, names["states"])
    with cuts_removed(spark):
        new = cut(events.dropDuplicates(["position_id", "event_id"]))
        touched = new.groupBy("position_id").agg(F.min(F.struct("event_timestamp", "event_id")).alias("first"))
        known = versions.numbers(spark, names["states"])
        if known:
            old = cut(_states(spark, out_path).join(touched, "position_id"))
            carried, again = old.where(F.col("first") > F.col("last")), old.where(F.col("first") <= F.col("last"))
        history = new.hint("rebalance").sortWithinPartitions("position_id")
        versions.append(history, names["events"])
        if not known:
            replayed = cut(ledger.replay(new))
            states = ledger.states(replayed).withColumn("since", F.lit(run))
        else:
            replayed = cut(ledger.replay(new.join(again, "position_id", "left_anti"), carried))
            since = carried.select("position_id", "since")
            states = ledger.states(replayed, carried).join(since, "position_id", "left")
            states = states.withColumn("since", F.coalesce("since", F.lit(run)))
            if not again.isEmpty():
                whole = versions.read(spark, names["events"]).join(again.select("position_id"), "position_id", "left_semi")
                late = cut(ledger.replay(whole.dropDuplicates(["position_id", "event_id"])))
                states = states.unionByName(ledger.states(late).withColumn("since", F.lit(run)))
                replayed = replayed.unionByName(late)
        for name, rows, keys in (
            ("sales", ledger.sales(replayed), ["position_id", "event_id"]),
            ("rejections", ledger.rejections(replayed), ["position_id", "event_id"]),
            ("states", states, ["position_id"]),
        ):
            keyed.put(rows.withColumn("version", F.lit(run)), names[name], keys, "version")
    return ledger.positions_of(_states(spark, out_path).where(F.col("version") == run))


def _states(spark: SparkSession, out_path: str) -> DataFrame:
    return keyed.read(spark, f"{out_path.rstrip('/')}/states", ["position_id"], "version")


def current_positions(spark: SparkSession, out_path: str) -> DataFrame:
    """The newest state of every position ever written by ``positions``; filter on status or position_id."""
    return ledger.positions_of(_states(spark, out_path))


def _of_positions(spark: SparkSession, out_path: str, name: str) -> DataFrame:
    """Rows of a position's events that hold since it was last replayed."""
    rows = keyed.read(spark, f"{out_path.rstrip('/')}/{name}", ["position_id", "event_id"], "version")
    since = _states(spark, out_path).select("position_id", "since")
    return rows.join(since, "position_id").where(F.col("version") >= F.col("since")).drop("version", "since")


def sale_history(spark: SparkSession, out_path: str) -> DataFrame:
    """Every sale that holds, once."""
    return _of_positions(spark, out_path, "sales")


def rejected_events(spark: SparkSession, out_path: str) -> DataFrame:
    """Every rejected event that holds, once."""
    return _of_positions(spark, out_path, "rejections")


def open_positions_view(state: DataFrame, ticks: DataFrame) -> DataFrame:
    return ledger.mark_to_market(state.where(F.col("status") == "OPEN"), prices.latest_prices(ticks))


def price_moves(ticks: DataFrame, window: timedelta = timedelta(minutes=5)) -> DataFrame:
    return prices.price_alerts(ticks, window)


def flagship(candles: DataFrame, fee_bps: float = 10.0) -> DataFrame:
    """Candles to performance metrics per token: features, RSI signals, backtest, in one shuffle."""
    series = with_window_features(lay_out(candles)).rows(bt.add_rsi_signals).keep("return_1h", "signal")
    return bt.metrics(bt.simulate(series, fee_bps).frame())

