"""Queries that run the jobs that go on from where they stood: the same tables in several runs as in one."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demo import views
from demo.lake import _path, _silver, micros, rounded
from demo.lake_oracles import _ENTRY, _EXIT, LAKE_ORACLES, _from_silver
from demo.oracles import _ENTRY as _ENTRY_LABEL
from demo.oracles import _LABEL, ORACLES, _micros, _sql
from demo.queries import ALERT_WINDOW, RETURNS
from demo.queries import rounded as rounded_but
from tickloom import constants as K
from tickloom.operators import features
from tickloom.plans import daily, jobs
from tickloom.sources import keyed, tables, versions
from tickloom.streaming import alerts, as_of, ingest
from tickloom.streaming import silver as silver_stream


def _span(df: DataFrame, column: str) -> tuple[date, date] | None:
    low, high = df.agg(F.min(F.to_date(column)), F.max(F.to_date(column))).first()
    return None if low is None else (low, high)


def _runs(span: tuple[date, date]) -> list[tuple[date, date]]:
    """Days of each run: most of them at once, then days in smaller parts, and one of these again."""
    first, last = span
    some = max((last - first).days * 2 // 3, 0)
    cuts = sorted({min(first + timedelta(days=some + i), last) for i in (0, 4, 5, 9)} | {last})
    begins = [first, *[c + timedelta(days=1) for c in cuts[:-1]]]
    runs = list(zip(begins, cuts, strict=True))
    return [*runs, runs[len(runs) // 2]]


def silver_streamed(spark: SparkSession, sf: str) -> str:
    """Bronze lands in four parts by ingestion time, so that copies of an event are often in different ones; the stream
    runs after each. Half an hour after an event its state is gone: its second copy, an hour late, is found in silver."""
    events = views.market_events(spark, sf)
    bronze, path, checkpoint = (_path(spark, n) for n in ("bronze", "silver", "checkpoint"))
    at = F.unix_micros("ingestion_timestamp")
    low, high = events.agg(F.min(at), F.max(at)).first()
    for part in range(4):
        if low is not None:
            place = F.floor((at - low) * 4 / (high - low + 1))
            tables.write_bronze(events.where(place == part), bronze)
        elif part == 0:
            tables.write_bronze(events, bronze)
        query = silver_stream.start(spark, bronze, path, checkpoint, timedelta(minutes=30), F.col("ingestion_timestamp"), every=None)
        query.awaitTermination()
    return path


def silver_stream_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.read_silver(spark, silver_streamed(spark, sf))
    return rounded(rows.select("token_address", "event_timestamp", "event_date", "open", "high", "low", "close", "volume", "currency"))


def silver_stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.read_silver(spark, silver_streamed(spark, sf), "quarantine")
    return rounded(rows.select("token_address", "event_timestamp", "low", "close", F.array_join("quarantine_reasons", ",").alias("reasons")))


def _daily_gold(spark: SparkSession, sf: str) -> tuple[str, list[tuple[date, date]]]:
    silver, gold, tails = _silver(spark, sf), _path(spark, "gold"), _path(spark, "tails")
    span = _span(tables.read_silver(spark, silver), "event_date")
    runs = _runs(span) if span else [(date(2000, 1, 1), date(2000, 1, 1))]
    for first, last in runs:
        daily.features(spark, silver, gold, tails, first, last)
    return gold, runs


def gold_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Features in runs over a few days each, one of them done again."""
    rows = tables.read_gold(spark, _daily_gold(spark, sf)[0])
    return rounded(rows.select("token_address", "event_timestamp", "close", *K.ENTRY_FEATURES))


def backtest_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics from the summaries of days, made in several runs, one of them twice."""
    gold, runs = _daily_gold(spark, sf)
    parts = _path(spark, "parts")
    for i, (first, last) in enumerate(runs):
        daily.backtest(spark, gold, parts, first if i else None, last)
    return rounded(daily.metrics(spark, parts))


def _folded(spark: SparkSession, sf: str) -> str:
    """Position events in three calls by time; those of every tenth position come a call late, some are sent twice."""
    path, events = _path(spark, "positions"), views.position_events(spark, sf)
    at = F.unix_micros("event_timestamp")
    low, high = events.agg(F.min(at), F.max(at)).first()
    if low is None:
        jobs.positions(events, path)
        return path
    place = F.floor((at - low) * 3 / (high - low + 1))
    late = (F.col("position_id") % 10 == 3) & (F.col("event_type") == "sell")
    due = F.least(place + F.when(late, 1).otherwise(0), F.lit(2))
    for call in range(3):
        again = (place == call - 1) & (F.col("position_id") % 7 == 1)
        jobs.positions(events.where((due == call) | again), path)
    return path


def positions_folded(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(jobs.current_positions(spark, _folded(spark, sf)))


def sales_folded(spark: SparkSession, sf: str) -> DataFrame:
    sold = jobs.sale_history(spark, _folded(spark, sf))
    return rounded(sold.select("position_id", "event_id", "sell_fraction", "amount_sold", "realized_pnl", "remaining_size"))


def rejections_folded(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.rejected_events(spark, _folded(spark, sf)).select("position_id", "event_id", "reason")


def positions_upserted(spark: SparkSession, sf: str) -> DataFrame:
    """Positions of all events, upserted twenty times by a part of the positions and then read back: runs stay few."""
    state, path = jobs.positions(views.position_events(spark, sf)), _path(spark, "keyed")
    state = state.withColumn("version", F.lit(0))
    keyed.put(state.withColumn("remaining_size", F.lit(-1.0)), path, ["position_id"], "version")
    for i in range(1, 21):
        part = state.where(F.pmod(F.col("position_id"), F.lit(10)) == i % 10)
        keyed.put(part.withColumn("version", F.lit(i)), path, ["position_id"], "version")
    count = sum(len(r) for r in keyed.runs(versions.current(spark, path)).values())
    rows = keyed.read(spark, path, ["position_id"], "version").drop("version")
    return rounded(rows).withColumn("few_runs", F.lit(count <= 3 * (keyed.FANOUT - 1)))


def bronze_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Fifty batches land in bronze and are compacted: rows stay, and a day has one file."""
    events, path = views.market_events(spark, sf), _path(spark, "bronze")
    batch = F.pmod(F.xxhash64("event_id"), F.lit(50))
    events = events.withColumn("batch", batch).persist()
    for i in range(50):
        tables.write_bronze(events.where(F.col("batch") == i).drop("batch"), path)
    events.unpersist()
    landed = len(versions.current(spark, path).files)
    versions.compact(spark, path, sort_by=["token_address", "event_timestamp"])
    days = tables.read_bronze(spark, path).groupBy("domain", "dt").agg(F.count(F.lit(1)).alias("events"), F.count_distinct("event_id").alias("ids"))
    files = versions.current(spark, path).files
    small = len(files) <= len({tuple(sorted(f.partition.items())) for f in files}) < max(landed, 1)
    return micros(days.withColumn("one_file_a_day", F.lit(small)))


def labels_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Labels closed run by run, and the rows still open at the end."""
    gold, runs = _daily_gold(spark, sf)
    path, waiting = _path(spark, "labels"), _path(spark, "open")
    for first, last in runs[:-1]:
        for _ in range(2):  # a run again changes nothing
            daily.labels(spark, gold, path, waiting, first, last)
    rows = tables.read_table(spark, path).unionByName(tables.read_table(spark, waiting), allowMissingColumns=True)
    return micros(rows.select("token_address", "event_timestamp", "label", "exit_label"))


def prices_as_of_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks land in four parts, with a request for each a minute earlier; a last tick moves time past all of them."""
    run = _path(spark, "as-of")
    slices = views.tick_slices(spark, sf)
    ask = (F.col("event_timestamp") - F.expr("interval 1 minute")).alias("event_timestamp")
    kinds = {"ticks": slices.drop("slice"), "asks": slices.select(F.col("event_id").alias("request_id"), "token_address", ask)}
    end = slices.agg(F.lit("end").alias("event_id"), F.lit("~").alias("token_address"), (F.max("event_timestamp") + F.expr("interval 1 day")).alias("event_timestamp"), F.lit(0.0).alias("price"))

    def serve() -> None:
        ticks, asks = (spark.readStream.schema(df.schema).parquet(f"{run}/{name}") for name, df in kinds.items())
        found = as_of.prices_as_of(asks, ticks, "2 minutes")
        ingest.start_table_sink(found, f"{run}/out", f"{run}/checkpoint", None).awaitTermination()

    for part in range(4):
        here = slices.where(F.col("slice") == part)
        here.select(kinds["ticks"].columns).write.mode("append").parquet(f"{run}/ticks")
        here.select(F.col("event_id").alias("request_id"), "token_address", ask).write.mode("append").parquet(f"{run}/asks")
        serve()
    end.select(kinds["ticks"].columns).write.mode("append").parquet(f"{run}/ticks")
    serve()
    return rounded(spark.read.schema(as_of.AS_OF_SCHEMA).parquet(f"{run}/out").select("request_id", "token_address", "price"))


def _alert_job(spark: SparkSession, sf: str) -> str:
    """The alert job over messages that land in four parts; every ninth tick also sends a message that is none."""
    run = _path(spark, "alert-job")
    time = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    fields = (("event_id", F.col("event_id")), ("token_address", F.col("token_address")), ("event_timestamp", time))
    message = F.to_json(F.struct(*[c.alias(n) for n, c in fields], F.struct(F.col("price").cast("string").alias("value")).alias("payload")))
    ninth = F.pmod(F.col("event_id").cast("long"), F.lit(9)) == 0
    slices = views.tick_slices(spark, sf).select("slice", F.explode(F.when(ninth, F.array(message, F.lit("junk"))).otherwise(F.array(message))).alias("value"))
    for part in range(4):
        slices.where(F.col("slice") == part).drop("slice").write.mode("append").text(f"{run}/in")
        for query in alerts.run_alert_stream(ingest.file_messages(spark, f"{run}/in"), f"{run}/out", f"{run}/checkpoint", ALERT_WINDOW, None):
            query.awaitTermination()
    return f"{run}/out"


def alert_job(spark: SparkSession, sf: str) -> DataFrame:
    return micros(spark.read.schema(alerts.ALERT_SCHEMA).parquet(f"{_alert_job(spark, sf)}/alerts"))


def alert_job_rejects(spark: SparkSession, sf: str) -> DataFrame:
    dead = spark.read.schema("value string, problem string").parquet(f"{_alert_job(spark, sf)}/dead_letters")
    return dead.groupBy("value", "problem").agg(F.count(F.lit(1)).alias("messages"))


def train_job(spark: SparkSession, sf: str) -> DataFrame:
    """The training job over a gold table, read back: the models of both kinds with the counts of their runs."""
    gold, stored, runs = (_path(spark, n) for n in ("gold", "models", "runs"))
    tables.write_partitioned(features.token_features(views.candles(spark, sf)).withColumn("event_date", F.to_date("event_timestamp")), gold, ["event_date"])
    jobs.train(spark, gold, stored, runs)
    done = tables.read_table(spark, stored).select("token_address", "model_type", "run_id", "converged")
    rows = tables.read_table(spark, runs).join(done, ["token_address", "model_type", "run_id"])
    return rounded(rows.select("token_address", "model_type", "n_train", "n_test", "positive_rate_train", "positive_rate_test", "converged"))


def token_features_split(spark: SparkSession, sf: str) -> DataFrame:
    """All features with every series of more than thirty rows cut into segments."""
    df = features.token_features(views.candles(spark, sf), max_rows=30, segment_rows=20)
    return rounded_but(df.select("event_id", "token_address", "event_timestamp", "close", "volume", *K.ENTRY_FEATURES), RETURNS)


DAILY = {
    "silver_stream_table": silver_stream_table,
    "silver_stream_quarantine": silver_stream_quarantine,
    "gold_daily": gold_daily,
    "backtest_daily": backtest_daily,
    "positions_folded": positions_folded,
    "sales_folded": sales_folded,
    "rejections_folded": rejections_folded,
    "positions_upserted": positions_upserted,
    "bronze_compacted": bronze_compacted,
    "labels_daily": labels_daily,
    "prices_as_of_stream": prices_as_of_stream,
    "alert_job": alert_job,
    "alert_job_rejects": alert_job_rejects,
    "train_job": train_job,
    "token_features_split": token_features_split,
}

#: The same rows as in one run.
DAILY_ORACLES = {
    "silver_stream_table": LAKE_ORACLES["silver_table"],
    "silver_stream_quarantine": LAKE_ORACLES["silver_quarantine_table"],
    "gold_daily": LAKE_ORACLES["gold_table"],
    "backtest_daily": LAKE_ORACLES["backtest_table"],
    "positions_folded": LAKE_ORACLES["positions_table"],
    "sales_folded": LAKE_ORACLES["sales_table"],
    "rejections_folded": LAKE_ORACLES["rejections_table"],
    "positions_upserted": f"SELECT *, true AS few_runs FROM ({LAKE_ORACLES['positions_table']})",
    "bronze_compacted": """SELECT 'market' AS domain, strftime(ts, '%Y-%m-%d') AS dt, 2 * count(*) AS events, count(*) AS ids,
        true AS one_file_a_day FROM events GROUP BY ALL""",
    "labels_daily": _from_silver(
        _sql(
            "lagged",
            f"""SELECT token_address, {_micros("event_timestamp")}, {_ENTRY_LABEL}, CASE WHEN lead(rn, 6) OVER w IS NOT NULL THEN
                CAST(CASE WHEN (least(lead(close, 1) OVER w, lead(close, 2) OVER w, lead(close, 3) OVER w) - close) / close <= -0.01
                     THEN 1 ELSE 0 END AS DOUBLE) END AS exit_label FROM lagged {_LABEL}""",
        )
    ),
    "prices_as_of_stream": LAKE_ORACLES["prices_as_of_all"],
    "alert_job": ORACLES["price_alerts"],
    "alert_job_rejects": "SELECT 'junk' AS value, 'token' AS problem, count(*) AS messages FROM events WHERE event_id % 9 = 0",
    "train_job": f"SELECT * FROM ({_ENTRY}) UNION ALL SELECT * FROM ({_EXIT})",
    "token_features_split": ORACLES["token_features"],
}
