"""Latest and as-of prices, and rolling price-move alerts over a tick table."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.rules import move_severity
from tickloom.operators.series import Running, lay_out


def latest_prices(ticks: DataFrame) -> DataFrame:
    newest = F.struct("event_timestamp", "event_id")
    return (
        ticks.where(F.col("price").isNotNull())
        .groupBy("token_address")
        .agg(F.max_by("price", newest).alias("price"), F.max("event_timestamp").alias("price_time"))
    )


def prices_as_of(requests: DataFrame, ticks: DataFrame, **layout) -> DataFrame:
    """Price of the last tick at or before each request (request_id, token_address, event_timestamp).

    Ticks and requests are one series and the price is the running last value, so nothing is
    joined on a range.
    """
    tick = ticks.where(F.col("price").isNotNull()).select(
        "token_address", "event_timestamp", F.lit(0).alias("_kind"), F.col("event_id").cast("string").alias("_id"), "price"
    )
    ask = requests.select(
        "token_address",
        "event_timestamp",
        F.lit(1).alias("_kind"),
        F.col("request_id").cast("string").alias("_id"),
        F.lit(None).cast("double").alias("price"),
    )
    series = lay_out(tick.unionByName(ask), order=("event_timestamp", "_kind", "_id"), **layout)
    return (
        series.running(as_of=Running("last", F.col("price")))
        .frame()
        .where(F.col("_kind") == 1)
        .select(F.col("_id").alias("request_id"), "token_address", "event_timestamp", F.col("as_of").alias("price"))
    )


def price_alerts(ticks: DataFrame, window: timedelta = timedelta(minutes=5), **layout) -> DataFrame:
    """Alert when a price moved 2 % or more against the oldest tick of the trailing window.

    Every tick also asks a question at its own time minus the window: which tick comes next? Read
    from late to early, the answer is the last tick seen, so a running last value serves any tick
    density; a sliding range frame would hold the whole window for every row. The window edge is
    inclusive; of ticks at the same time the smallest event id counts as the oldest.
    """
    seen = ticks.where(F.col("price").isNotNull())
    at = F.unix_micros("event_timestamp")
    micros = int(window.total_seconds() * 1_000_000)
    marks = F.array(
        F.struct((-at).alias("when"), F.lit(0).alias("question")),
        F.struct((-at + micros).alias("when"), F.lit(1).alias("question")),
    )
    rows = seen.select("token_address", "event_id", "event_timestamp", "price", F.explode(marks).alias("m")).select(
        "token_address",
        "event_id",
        "event_timestamp",
        "price",
        F.col("m.when").alias("_when"),
        F.col("m.question").alias("_question"),
    )
    if "counted" not in layout:  # the key counts of the ticks are half those of the doubled rows
        layout = {**layout, "counted": (seen, 2)}
    series = lay_out(rows, order=("_when", "_question", "-event_id"), **layout)
    tick = F.when(F.col("_question") == 0, F.struct("event_timestamp", "price"))
    found = series.running(base=Running("last", tick)).frame().where(F.col("_question") == 1)
    change = F.try_divide(F.col("price") - F.col("base.price"), F.col("base.price"))
    return (
        found.withColumn("pct_change", change)
        .withColumn("severity", move_severity(F.col("pct_change")))
        .where(F.col("severity").isNotNull())
        .select(
            "token_address",
            "event_id",
            "severity",
            "pct_change",
            F.col("base.price").alias("window_start_price"),
            F.col("price").alias("current_price"),
            F.col("base.event_timestamp").alias("window_start_time"),
            F.col("event_timestamp").alias("alert_time"),
        )
    )
