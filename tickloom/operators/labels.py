"""Forward labels, simulated position features, chronological split and training guards.

Labels are the only place that looks ahead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tickloom import constants as K
from tickloom.operators.series import Series, lay_out


def _ahead(w: WindowSpec, horizon: int) -> Column:
    """True where ``horizon`` later rows exist."""
    return F.lead(F.lit(1), horizon).over(w).isNotNull()


def triple_barrier(w: WindowSpec, horizon: int, upper_pct: float, lower_pct: float, price: str = "close") -> Column:
    """1 if the first barrier reached in the next rows is the upper one, else 0; null near the end."""
    now = F.col(price)
    upper, lower = now * (1 + upper_pct), now * (1 - lower_pct)
    later = [F.lead(price, k).over(w) for k in range(1, horizon + 1)]
    first = F.coalesce(*[F.when(p >= upper, 1.0).when(p <= lower, 0.0) for p in later], F.lit(0.0))
    return F.when(_ahead(w, horizon), first)


def exit_label(w: WindowSpec, horizon: int, decline_threshold: float, price: str = "close") -> Column:
    """1 if the lowest of the next rows is at least the threshold below now, else 0; null near the end."""
    now = F.col(price)
    lowest = F.min(price).over(w.rowsBetween(1, horizon))
    fell = F.try_divide(lowest - now, now) <= -decline_threshold
    return F.when(_ahead(w, horizon), F.when(fell, 1.0).otherwise(0.0))


def position_features(w: WindowSpec, holding_period: int = K.EXIT_HOLDING_PERIOD) -> dict[str, Column]:
    """Features of a position opened ``holding_period`` rows ago."""
    entry = F.lag("close", holding_period).over(w)
    high = F.max("close").over(w.rowsBetween(1 - holding_period, 0))
    return {
        "unrealized_return": F.try_divide(F.col("close") - entry, entry),
        "periods_held": F.lit(holding_period),
        "drawdown_from_high": F.try_divide(F.col("close") - high, high),
    }


def with_entry_label(
    series: Series,
    horizon: int = K.ENTRY_HORIZON,
    upper_pct: float = K.ENTRY_UPPER_PCT,
    lower_pct: float = K.ENTRY_LOWER_PCT,
) -> Series:
    return series.bounded(
        lambda d, w: d.withColumn("label", triple_barrier(w, horizon, upper_pct, lower_pct)), after=horizon
    )


def with_exit_label(
    series: Series, horizon: int = K.EXIT_HORIZON, decline_threshold: float = K.EXIT_DECLINE_THRESHOLD
) -> Series:
    return series.bounded(
        lambda d, w: d.withColumn("exit_label", exit_label(w, horizon, decline_threshold)), after=horizon
    )


def with_position_features(series: Series, holding_period: int = K.EXIT_HOLDING_PERIOD) -> Series:
    return series.bounded(lambda d, w: d.withColumns(position_features(w, holding_period)), before=holding_period)


def drop_incomplete(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Rows whose features and label are all known (null and NaN both count as unknown)."""
    return df.na.drop(subset=[*features, label])


def chronological_split(
    df: DataFrame,
    test_fraction: float = 0.2,
    keys: Sequence[str] = ("token_address",),
    order: Sequence[str] = ("event_timestamp", "event_id"),
    **layout,
) -> DataFrame:
    """Add ``is_train``: the first int(n * (1 - test_fraction)) rows of each key."""
    sized = lay_out(df, keys, order, **layout).index("_at").size("_n").frame()
    return sized.withColumn("is_train", F.col("_at") <= F.floor(F.col("_n") * (1 - test_fraction))).drop("_at", "_n")


def trainable(split: DataFrame, label: str, keys: Sequence[str] = ("token_address",), min_rows: int = K.MIN_TRAINING_ROWS) -> DataFrame:
    """Keys with at least ``min_rows`` rows and two label classes among the train rows."""
    train_label = F.when(F.col("is_train"), F.col(label))
    return (
        split.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if("is_train").alias("n_train"),
            (F.min(train_label) < F.max(train_label)).alias("_two_classes"),
        )
        .where((F.col("n_rows") >= min_rows) & F.col("_two_classes"))
        .drop("_two_classes")
    )
