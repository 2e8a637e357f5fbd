"""Position ledger: a table of open, sell and price events folded into positions.

Events: position_id, token_address, event_type (open | sell | price), event_timestamp, event_id,
price, size, sell_fraction. Each sell takes a fraction of what is left, so the size left is the
opening size times a running product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.constants import CLOSED_SIZE
from tickloom.operators.series import Running, lay_out


def _kind(name: str) -> Column:
    return F.coalesce(F.col("event_type") == name, F.lit(False))


def _in(value: str, test: Column) -> Column:
    return F.coalesce(test & ~F.isnan(value), F.lit(False))


def replay(events: DataFrame, carried: DataFrame | None = None, **layout) -> DataFrame:
    """Every event with the state of its position and, if it was not accepted, the reason.

    With ``carried`` (rows of ``states``) positions go on from there; the events must be later than the states' last.
    """
    good_open = _kind("open") & _in("price", F.col("price") > 0) & _in("size", F.col("size") > 0)
    fraction = F.col("sell_fraction")
    good_sell = _kind("sell") & _in("sell_fraction", (fraction > 0) & (fraction <= 1)) & _in("price", F.col("price").isNotNull())
    opening = F.struct("event_id", "token_address", "price", "size", "event_timestamp")
    seed = events.select(opening.alias("_o")).schema["_o"].dataType
    if carried is None:
        events = events.withColumns({"_seed_open": F.lit(None).cast(seed), "_seed_left": F.lit(None).cast("double"), "_seed": F.lit(False)})
    else:
        # The last event of a position stands for all before it; its columns beside these are null.
        before = carried.select(
            "position_id",
            F.col("last.event_timestamp").alias("event_timestamp"),
            F.col("last.event_id").alias("event_id"),
            F.col("opening").cast(seed).alias("_seed_open"),
            F.col("left").alias("_seed_left"),
            F.lit(True).alias("_seed"),
        )
        events = events.withColumn("_seed", F.lit(False)).unionByName(before, allowMissingColumns=True)
    series = lay_out(events, ("position_id",), ("event_timestamp", "event_id"), **layout)
    series = series.running(_open=Running("first", F.coalesce("_seed_open", F.when(good_open, opening))))
    selling = good_sell & F.col("_open").isNotNull()
    series = series.running(_left=Running("product", F.coalesce("_seed_left", F.when(selling, 1 - fraction))))
    series = series.bounded(lambda d, w: d.withColumn("_left_before", F.lag("_left", 1).over(w)), before=1)

    size = F.col("_open.size")
    before = size * F.coalesce(F.col("_left_before"), F.lit(1.0))
    closed = F.col("_left_before").isNotNull() & (before <= CLOSED_SIZE)
    is_opening = F.col("event_id") == F.col("_open.event_id")
    rejected = (
        F.when(_kind("open") & ~good_open, "bad_open")
        .when(_kind("open") & ~is_opening, "already_open")
        .when(F.col("_open").isNull(), "no_position")
        .when(_kind("sell") & ~good_sell, "bad_sell")
        .when(closed, "closed")
    )
    sold = F.when(_kind("sell") & F.col("rejected").isNull(), before * fraction)
    return (
        series.frame()
        .where(~F.col("_seed"))
        .withColumn("rejected", rejected)
        .withColumn("amount_sold", sold)
        .withColumns(
            {
                "entry_price": F.col("_open.price"),
                "realized_pnl": F.col("amount_sold") * (F.col("price") - F.col("_open.price")),
                "remaining_size": F.greatest(
                    F.coalesce(before - F.col("amount_sold"), before), F.lit(0.0)
                ),
            }
        )
        .drop("_left_before", "_seed", "_seed_open", "_seed_left")
    )


def sales(replayed: DataFrame) -> DataFrame:
    """Sale history: one row per accepted sell. It is a table, so a position may have any number."""
    return replayed.where(F.col("amount_sold").isNotNull()).select(
        "position_id",
        "event_timestamp",
        "event_id",
        "sell_fraction",
        "amount_sold",
        F.col("price").alias("sell_price"),
        "realized_pnl",
        "remaining_size",
    )


def rejections(replayed: DataFrame) -> DataFrame:
    return replayed.where(F.col("rejected").isNotNull()).select(
        "position_id", "event_id", "event_type", "event_timestamp", F.col("rejected").alias("reason")
    )


def states(replayed: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """What later events need to know of each position, also of one that has no accepted event yet."""
    accepted, is_sale = F.col("rejected").isNull(), F.col("amount_sold").isNotNull()
    seen = F.when(accepted & _kind("price") & _in("price", F.col("price").isNotNull()), F.col("price"))
    at = F.struct("event_timestamp", "event_id")
    state = replayed.groupBy("position_id").agg(
        F.max(at).alias("last"),
        F.min("_open").alias("opening"),
        F.max_by("_left", at).alias("left"),
        F.min(F.when(is_sale, F.col("remaining_size"))).alias("remaining"),
        F.max(seen).alias("high"),
        F.coalesce(F.sum(F.when(accepted, F.col("realized_pnl"))), F.lit(0.0)).alias("realized_pnl"),
        F.count(F.when(is_sale, 1)).alias("sales"),
    )
    if carried is None:
        return state
    old = carried.select("position_id", *[F.col(c).alias(f"_old_{c}") for c in ("remaining", "high", "realized_pnl", "sales")])
    return state.join(old, "position_id", "left").select(
        "position_id",
        "last",
        "opening",
        "left",
        F.least("remaining", "_old_remaining").alias("remaining"),
        F.greatest("high", "_old_high").alias("high"),
        (F.coalesce("_old_realized_pnl", F.lit(0.0)) + F.col("realized_pnl")).alias("realized_pnl"),
        (F.coalesce("_old_sales", F.lit(0)) + F.col("sales")).alias("sales"),
    )


def positions(replayed: DataFrame) -> DataFrame:
    """Current state of each position."""
    return positions_of(states(replayed))


def positions_of(state: DataFrame) -> DataFrame:
    """Positions from their states; one that was never opened is none."""
    closed = F.col("remaining").isNotNull() & (F.col("remaining") <= CLOSED_SIZE)
    return state.where(F.col("opening").isNotNull()).select(
        "position_id",
        F.col("opening.token_address").alias("token_address"),
        F.col("opening.price").alias("entry_price"),
        F.col("opening.event_timestamp").alias("entry_timestamp"),
        F.col("opening.size").alias("initial_size"),
        F.coalesce("remaining", "opening.size").alias("remaining_size"),
        F.greatest("opening.price", "high").alias("highest_price"),
        "realized_pnl",
        "sales",
        F.when(closed, "CLOSED").otherwise("OPEN").alias("status"),
    )


def mark_to_market(positions: DataFrame, prices: DataFrame) -> DataFrame:
    """Positions with their latest price; without one the row stays and the P&L is null."""
    gain = F.col("current_price") - F.col("entry_price")
    current = prices.select("token_address", F.col("price").alias("current_price"))
    return positions.join(current, "token_address", "left").withColumns(
        {
            "unrealized_pnl": F.col("remaining_size") * gain,
            "unrealized_pnl_pct": F.try_divide(gain, F.col("entry_price")),
            "position_value": F.col("remaining_size") * F.col("current_price"),
        }
    )
