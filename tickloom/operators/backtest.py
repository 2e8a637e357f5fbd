"""Cost-aware long/flat backtest of every token at once."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.constants import HOURS_PER_YEAR
from tickloom.operators.series import Running, Series, lay_out


def rsi_signal(oversold: float = 30.0, overbought: float = 70.0) -> Column:
    return (
        F.when(F.col("rsi_14") < oversold, "BUY").when(F.col("rsi_14") > overbought, "SELL").otherwise("HOLD")
    )


def add_rsi_signals(df: DataFrame, oversold: float = 30.0, overbought: float = 70.0) -> DataFrame:
    return df.withColumn("signal", rsi_signal(oversold, overbought))


_WORK = ("_late_1", "_late_2", "_late_position", "_peak")


def with_positions(series: Series) -> Series:
    """Position 1 after a BUY until a SELL, effective on the row after the signal.

    The latch is the last signal that was not HOLD, read one row late. ``_late_position`` is the
    same latch two rows late, the position of the row before.
    """
    side = F.when(F.col("signal") == "BUY", 1).when(F.col("signal") == "SELL", 0)
    series = series.bounded(
        lambda d, w: d.withColumns({"_late_1": F.lag(side, 1).over(w), "_late_2": F.lag(side, 2).over(w)}), before=2
    ).running(position=Running("last", F.col("_late_1")), _late_position=Running("last", F.col("_late_2")))
    return series.with_columns({n: F.coalesce(F.col(n), F.lit(0)) for n in ("position", "_late_position")})


def with_equity(series: Series, fee_bps: float = 10.0, initial_capital: float = 1000.0) -> Series:
    """Cost on every position change, strategy return, equity and buy-and-hold curves."""
    held = F.coalesce(F.col("return_1h"), F.lit(0.0))
    changed = F.col("position") != F.col("_late_position")
    cost = F.when(changed, fee_bps / 10_000).otherwise(0.0)
    strategy = F.col("position") * held - cost
    series = series.with_columns({"position_changed": changed, "cost": cost, "strategy_return": strategy}).running(
        equity=Running("product", 1 + F.col("strategy_return")), buy_hold_equity=Running("product", 1 + held)
    )
    return series.with_columns({n: F.col(n) * initial_capital for n in ("equity", "buy_hold_equity")})


def with_drawdown(series: Series) -> Series:
    """Distance of equity below its running peak; also drops the work columns of the steps before."""
    peak = F.col("_peak")
    series = series.running(_peak=Running("max", F.col("equity")))
    return series.rows(lambda d: d.withColumn("drawdown", F.try_divide(F.col("equity") - peak, peak)).drop(*_WORK))


def _annualised(mean: Column, deviation: Column) -> Column:
    ratio = F.when(deviation > 0, mean / deviation * math.sqrt(HOURS_PER_YEAR))
    return F.coalesce(ratio, F.lit(0.0))


def metrics(df: DataFrame, keys=("token_address",), order=("event_timestamp", "event_id"), initial_capital: float = 1000.0) -> DataFrame:
    """Ten performance figures per token, from rows with equity and drawdown."""
    r = F.col("strategy_return")
    active = F.col("position") == 1
    at = F.struct(*order)
    base = df.groupBy(*keys).agg(
        F.max_by("equity", at).alias("_equity"),
        F.max_by("buy_hold_equity", at).alias("_hold"),
        F.avg(r).alias("_mean"),
        F.stddev_samp(r).alias("_std"),
        F.stddev_samp(F.when(r < 0, r)).alias("_down"),
        F.min("drawdown").alias("max_drawdown"),
        F.count(F.when(active, 1)).alias("num_active_periods"),
        F.count(F.when(active & (r > 0), 1)).alias("_wins"),
        F.count(F.when(active & (r < 0), 1)).alias("_losses"),
        F.coalesce(F.sum(F.when(active & (r > 0), r)), F.lit(0.0)).alias("_won"),
        F.coalesce(F.sum(F.when(active & (r < 0), r)), F.lit(0.0)).alias("_lost"),
    )
    return _figures(base, keys, initial_capital)


def _figures(base: DataFrame, keys, initial_capital: float) -> DataFrame:
    total = F.col("_equity") / initial_capital - 1
    hold = F.col("_hold") / initial_capital - 1
    return base.select(
        *keys,
        total.alias("total_return"),
        hold.alias("buy_hold_return"),
        (total - hold).alias("return_vs_buy_hold"),
        _annualised(F.col("_mean"), F.col("_std")).alias("sharpe_ratio"),
        _annualised(F.col("_mean"), F.col("_down")).alias("sortino_ratio"),
        "max_drawdown",
        F.coalesce(F.try_divide(F.col("_wins"), F.col("num_active_periods")), F.lit(0.0)).alias("win_rate"),
        F.when((F.col("_losses") > 0) & (F.col("_lost") != 0), F.col("_won") / F.abs("_lost"))
        .when(F.col("_wins") > 0, F.lit(float("inf")))
        .otherwise(0.0)
        .alias("profit_factor"),
        F.col("_mean").alias("expected_value_per_period"),
        "num_active_periods",
    )


def simulate(series: Series, fee_bps: float = 10.0, initial_capital: float = 1000.0) -> Series:
    """Positions, equity and drawdown for a series that has ``signal`` and ``return_1h``."""
    return with_drawdown(with_equity(with_positions(series), fee_bps, initial_capital))


def run_backtest(
    gold: DataFrame,
    oversold: float = 30.0,
    overbought: float = 70.0,
    fee_bps: float = 10.0,
    initial_capital: float = 1000.0,
    **layout,
) -> DataFrame:
    """Backtest rows of every token in a table that has ``rsi_14`` and ``return_1h``."""
    series = lay_out(add_rsi_signals(gold, oversold, overbought), **layout)
    return simulate(series, fee_bps, initial_capital).frame()


#: What a part of a series tells of itself, for one way of entering it.
_SUMMARY = (
    "exit", "growth", "top", "low", "drop", "hold", "n", "mean", "m2", "dn", "dmean", "dm2", "active", "wins", "losses", "won", "lost"
)


def summarise(
    gold: DataFrame, part: str = "event_date", oversold: float = 30.0, overbought: float = 70.0, fee_bps: float = 10.0, **layout
) -> DataFrame:
    """One row for each token and part (a day) of a series, from the rows of that part alone: ``entries``, a summary for
    each of the four ways to enter it.

    A part is entered with a position held on the row before it and a position that it begins with: entry
    ``2 * held + begins``. Each summary says how the part is left (``exit``, the entry of the next one), how capital of 1
    grew, its highest, lowest and largest fall, and counts, means and squared deviations of returns. Summaries of parts
    in order compose (``fold``), so a changed day is summarised anew by itself.
    """
    begins, held = F.col("entry") % 2, F.floor(F.col("entry") / 2).cast("int")
    rows = add_rsi_signals(gold, oversold, overbought).select(
        "token_address", part, "event_timestamp", "event_id", "signal", "return_1h", F.explode(F.array(*map(F.lit, range(4)))).alias("entry")
    )
    keys = ("token_address", part, "entry")
    side = F.when(F.col("signal") == "BUY", 1).when(F.col("signal") == "SELL", 0)
    series = lay_out(rows, keys, **layout).bounded(
        lambda d, w: d.withColumns(
            {"_late_1": F.lag(side, 1).over(w), "_late_2": F.lag(side, 2).over(w), "_first": F.lag("event_id", 1).over(w).isNull()}
        ),
        before=2,
    )
    series = series.running(
        position=Running("last", F.col("_late_1")), _late_position=Running("last", F.col("_late_2")), _side=Running("last", side)
    )
    series = series.with_columns(
        {
            "position": F.coalesce("position", begins),
            "_late_position": F.when(F.col("_first"), held).otherwise(F.coalesce("_late_position", begins)),
            "_side": F.coalesce("_side", begins),
        }
    )
    done = with_drawdown(with_equity(series, fee_bps, 1.0)).frame()
    r, active, at = F.col("strategy_return"), F.col("position") == 1, F.struct("event_timestamp", "event_id")
    fell = F.when(r < 0, r)

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0.0))

    def count(test: Column) -> Column:
        return F.count(F.when(test, 1)).cast("double")

    figures = done.groupBy(*keys).agg(
        F.max_by(2 * F.col("position") + F.col("_side"), at).cast("int").alias("exit"),
        F.max_by("equity", at).alias("growth"),
        F.max("equity").alias("top"),
        F.min("equity").alias("low"),
        F.min("drawdown").alias("drop"),
        F.max_by("buy_hold_equity", at).alias("hold"),
        F.count(r).cast("double").alias("n"),
        F.coalesce(F.avg(r), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(r) * F.count(r), F.lit(0.0)).alias("m2"),
        F.count(fell).cast("double").alias("dn"),
        F.coalesce(F.avg(fell), F.lit(0.0)).alias("dmean"),
        F.coalesce(F.var_pop(fell) * F.count(fell), F.lit(0.0)).alias("dm2"),
        count(active).alias("active"),
        count(active & (r > 0)).alias("wins"),
        count(active & (r < 0)).alias("losses"),
        total(F.when(active & (r > 0), r)).alias("won"),
        total(F.when(active & (r < 0), r)).alias("lost"),
    )
    entries = F.transform(F.sort_array(F.collect_list(F.struct("entry", F.struct(*_SUMMARY).alias("s")))), lambda e: e["s"])
    return figures.groupBy("token_address", part).agg(entries.alias("entries"))


def _moments(n: Column, mean: Column, m2: Column, part: tuple[Column, Column, Column]) -> tuple[Column, Column, Column]:
    """Count, mean and squared deviations of two sets of values together."""
    n2, mean2, m22 = part
    both, apart = n + n2, mean2 - mean
    share = F.when(both > 0, n2 / both).otherwise(F.lit(0.0))
    return both, mean + apart * share, m2 + m22 + apart * apart * n * share


def fold(parts: DataFrame, part: str = "event_date") -> DataFrame:
    """The ten figures of ``metrics`` per token from the summaries of its parts; no row of the series is read.

    A token's summaries are folded in one row: some hundred bytes a day. Growth is taken to be positive, as it is for
    prices above zero and a fee below the fall that would end a series.
    """
    start = F.struct(
        *[
            (F.lit(0).cast("int") if n == "exit" else F.lit(None).cast("double") if n in ("top", "drop") else F.lit(1.0) if n in ("growth", "hold") else F.lit(0.0)).alias(n)
            for n in _SUMMARY
            if n != "low"
        ]
    )

    def step(so_far: Column, day: Column) -> Column:
        s = day["entries"][so_far["exit"]]
        n, mean, m2 = _moments(so_far["n"], so_far["mean"], so_far["m2"], (s["n"], s["mean"], s["m2"]))
        dn, dmean, dm2 = _moments(so_far["dn"], so_far["dmean"], so_far["dm2"], (s["dn"], s["dmean"], s["dm2"]))
        below = F.try_divide(so_far["growth"] * s["low"] - so_far["top"], so_far["top"])
        new = {
            "exit": s["exit"],
            "growth": so_far["growth"] * s["growth"],
            "top": F.greatest(so_far["top"], so_far["growth"] * s["top"]),
            "drop": F.least(so_far["drop"], s["drop"], below),
            "hold": so_far["hold"] * s["hold"],
            "n": n, "mean": mean, "m2": m2, "dn": dn, "dmean": dmean, "dm2": dm2,
        }
        new |= {c: so_far[c] + s[c] for c in ("active", "wins", "losses", "won", "lost")}
        return F.struct(*[new[c].alias(c) for c in _SUMMARY if c != "low"])

    days = F.sort_array(F.collect_list(F.struct(part, "entries")))
    folded = parts.groupBy("token_address").agg(days.alias("days")).select("token_address", F.aggregate("days", start, step).alias("s"))
    base = folded.select(
        "token_address",
        F.col("s.growth").alias("_equity"),
        F.col("s.hold").alias("_hold"),
        F.when(F.col("s.n") > 0, F.col("s.mean")).alias("_mean"),
        F.when(F.col("s.n") > 1, F.sqrt(F.col("s.m2") / (F.col("s.n") - 1))).alias("_std"),
        F.when(F.col("s.dn") > 1, F.sqrt(F.col("s.dm2") / (F.col("s.dn") - 1))).alias("_down"),
        F.col("s.drop").alias("max_drawdown"),
        F.col("s.active").cast("long").alias("num_active_periods"),
        F.col("s.wins").alias("_wins"),
        F.col("s.losses").alias("_losses"),
        F.col("s.won").alias("_won"),
        F.col("s.lost").alias("_lost"),
    )
    return _figures(base, ("token_address",), 1.0)
