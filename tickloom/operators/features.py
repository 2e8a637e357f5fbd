"""Look-ahead-free features of a candle series: every value uses the row itself and rows before it."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.canonical import is_digest, packed, unpacked
from tickloom.operators.series import Series, lay_out

# An EMA forgets: after this many e-folds the weight of older rows is below 1e-30.
_EFOLDS = math.log(1e30)

#: Rows of a series that features of later rows look back on, besides the averages carried in the last of them.
TAIL_ROWS = 24
#: Before the names of averages that a row brings instead of its own.
SEED = "_seed_"
_CARRIED = ("ema_fast", "ema_slow", "macd_signal")
#: What later rows need of a row in a tail, besides the averages; all window features come from closes.
_TAIL = ("token_address", "event_timestamp", "event_id", "close")
_PACKED = _TAIL[:-1]


def _trailing(w: WindowSpec, rows: int) -> WindowSpec:
    return w.rowsBetween(1 - rows, 0)


def _full(value: Column, source: Column, w: WindowSpec, rows: int) -> Column:
    """``value`` only where the trailing window holds ``rows`` non-null inputs."""
    return F.when(F.count(source).over(_trailing(w, rows)) >= rows, value)


def returns(w: WindowSpec, periods: Sequence[int]) -> dict[str, Column]:
    prior = {p: F.lag("close", p).over(w) for p in periods}
    return {f"return_{p}h": F.try_divide(F.col("close") - c, c) for p, c in prior.items()}


def sma(w: WindowSpec, rows: int) -> dict[str, Column]:
    close = F.col("close")
    return {f"sma_{rows}": _full(F.avg(close).over(_trailing(w, rows)), close, w, rows)}


def volatility(w: WindowSpec, rows: int) -> dict[str, Column]:
    r = F.col("return_1h")
    return {f"volatility_{rows}": _full(F.stddev_samp(r).over(_trailing(w, rows)), r, w, rows)}


def change(w: WindowSpec) -> dict[str, Column]:
    """Price change since the row before; the first row counts as no change."""
    return {"_change": F.coalesce(F.col("close") - F.lag("close", 1).over(w), F.lit(0.0))}


def rsi(w: WindowSpec, rows: int = 14) -> dict[str, Column]:
    """RSI with simple-mean smoothing, from ``change``; a flat window gives 0."""
    moved = F.col("_change")
    up = F.avg(F.greatest(moved, F.lit(0.0))).over(_trailing(w, rows))
    down = F.avg(F.greatest(-moved, F.lit(0.0))).over(_trailing(w, rows))
    strength = up / F.when(down == 0, F.lit(1e-9)).otherwise(down)
    return {f"rsi_{rows}": _full(100 - 100 / (1 + strength), moved, w, rows)}


def _block_rows(spans: Sequence[int]) -> int:
    """Rows per block so that two whole blocks forget everything older, for the slowest span."""
    slowest = max(spans)
    rows = math.ceil(_EFOLDS / 2 / -math.log(1 - 2 / (slowest + 1))) if slowest > 1 else 1
    fastest = min(s for s in spans if s > 1) if slowest > 1 else 3
    if rows * -math.log(1 - 2 / (fastest + 1)) > 600:
        raise ValueError(f"EMA spans {tuple(spans)} are too far apart for one pass")
    return rows


def ema_reach(spans: Sequence[int]) -> int:
    """Rows back after which an EMA of any of ``spans`` no longer sees a value."""
    return 3 * _block_rows(spans)


def _ema(df: DataFrame, inputs: dict[str, tuple[str, int]], key: list[str], order: list[str], one_block: bool) -> DataFrame:
    """EMAs over rows that carry ``_block`` and ``_at`` (position in the block, from 0).

    ema[0] = x[0] and ema[t] = a x[t] + (1 - a) ema[t-1], as a weighted sum inside each block plus
    the decayed sums of the two blocks before. ``inputs`` maps output name to (column, span).
    """
    in_block = Window.partitionBy(*key, "_block").orderBy(*order)
    so_far = in_block.rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*key).orderBy("_block", *order).rowsBetween(Window.unboundedPreceding, -1)
    at, is_start = F.col("_at"), (F.col("_block") == 0) & (F.col("_at") == 0)
    local, decay = {}, {}
    for name, (column, span) in inputs.items():
        a = 2.0 / (span + 1)
        keep = F.lit(1.0 - a)
        weight = F.when(is_start, F.lit(1.0)).otherwise(F.lit(a))
        if span == 1:
            local[name] = F.col(column)
        else:
            local[name] = F.sum(weight * F.col(column) * F.pow(keep, -at)).over(so_far) * F.pow(keep, at)
        decay[name] = keep
    df = df.withColumns(local)
    if one_block:
        return df
    at_end = F.col("_at") == F.col("_block_rows") - 1
    one = {f"_one_{n}": F.last(F.when(at_end, F.col(n)), ignorenulls=True).over(earlier) for n in inputs}
    df = df.withColumns(one)
    two = {
        f"_two_{n}": F.last(
            F.when(at_end, F.col(n) + F.pow(decay[n], F.col("_block_rows")) * F.coalesce(F.col(f"_one_{n}"), F.lit(0.0))),
            ignorenulls=True,
        ).over(earlier)
        for n in inputs
    }
    df = df.withColumns(two)
    return df.withColumns(
        {n: F.col(n) + F.pow(decay[n], at + 1) * F.coalesce(F.col(f"_two_{n}"), F.lit(0.0)) for n in inputs}
    ).drop(*one, *two)


def ema_macd(
    df: DataFrame, key: list[str], order: list[str], fast: int, slow: int, signal: int, longest: int | None = None
) -> DataFrame:
    """EMA of close (fast, slow), MACD and its signal, in window order. Silver has no null ``close``; one is an error."""
    no_price = F.raise_error(F.lit("close must not be null")).cast("double")
    df = df.withColumn("close", F.coalesce("close", no_price))
    rows = _block_rows((fast, slow, signal))
    one_block = longest is not None and longest <= rows
    number = F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1
    df = df.withColumn("_number", number).withColumns(
        {
            "_block": F.floor(F.col("_number") / rows),
            "_at": (F.col("_number") % rows).cast("double"),
            "_block_rows": F.lit(float(rows)),
        }
    )
    if one_block:
        df = df.withColumn("_block", F.lit(0))
    # A first row that stands for a series so far brings the averages up to it in place of its own values.
    seeds = [c for c in df.columns if c.startswith(SEED)]

    def source(name: str, value: str) -> Column:
        return F.coalesce(SEED + name, value) if SEED + name in seeds else F.col(value)

    df = df.withColumns({"_x_fast": source("ema_fast", "close"), "_x_slow": source("ema_slow", "close")})
    df = _ema(df, {"ema_fast": ("_x_fast", fast), "ema_slow": ("_x_slow", slow)}, key, order, one_block)
    df = df.withColumn("macd", F.col("ema_fast") - F.col("ema_slow")).withColumn("_x_macd", source("macd_signal", "macd"))
    df = _ema(df, {"macd_signal": ("_x_macd", signal)}, key, order, one_block)
    return df.drop("_number", "_block", "_at", "_block_rows", "_x_fast", "_x_slow", "_x_macd", *seeds)


def _spec_columns(series: Series, df: DataFrame) -> list[str]:
    return [*series.keys, *(["_segment"] if "_home_segment" in df.columns else [])]


def add_returns(df: DataFrame, periods: Sequence[int], **layout) -> DataFrame:
    return lay_out(df, **layout).bounded(lambda d, w: d.withColumns(returns(w, periods)), before=max(periods)).frame()


def add_sma(df: DataFrame, window: int, **layout) -> DataFrame:
    return lay_out(df, **layout).bounded(lambda d, w: d.withColumns(sma(w, window)), before=window).frame()


def add_volatility(df: DataFrame, window: int, **layout) -> DataFrame:
    """Needs ``return_1h``."""
    return lay_out(df, **layout).bounded(lambda d, w: d.withColumns(volatility(w, window)), before=window).frame()


def add_rsi(df: DataFrame, window: int = 14, **layout) -> DataFrame:
    series = lay_out(df, **layout)
    return series.bounded(
        lambda d, w: d.withColumns(change(w)).withColumns(rsi(w, window)).drop("_change"), before=window
    ).frame()


def add_ema_macd(df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, **layout) -> DataFrame:
    return with_ema_macd(lay_out(df, **layout), fast, slow, signal).frame()


def with_ema_macd(series: Series, fast: int = 12, slow: int = 26, signal: int = 9) -> Series:
    order = list(series.order)
    spans = (fast, slow, signal)

    def step(d: DataFrame, w: WindowSpec) -> DataFrame:
        longest = None if series.hot is not None else series.longest
        return ema_macd(d, _spec_columns(series, d), order, fast, slow, signal, longest)

    return series.bounded(step, before=ema_reach(spans) * 2)


def with_window_features(series: Series) -> Series:
    """Returns over 1, 4 and 24 rows, 20-row average and volatility, 14-row RSI: one sort for all."""

    def step(d: DataFrame, w: WindowSpec) -> DataFrame:
        d = d.withColumns({**returns(w, (1, 4, 24)), **sma(w, 20), **change(w)})
        return d.withColumns({**volatility(w, 20), **rsi(w, 14)}).drop("_change")

    return series.bounded(step, before=24)


def token_features(df: DataFrame, **layout) -> DataFrame:
    """The gold feature table of all tokens."""
    return with_ema_macd(with_window_features(lay_out(df, **layout))).frame()


def features_after(df: DataFrame, tails: DataFrame, **layout) -> DataFrame:
    """Features of rows whose series go on after ``tails`` (see ``series_tails``): those of the whole series.

    All rows of a series must be later than its tail. What is read and sorted is these rows and the tails alone. Packed
    tails (see ``packed_tails``) stay so until they are dealt by series.
    """
    if "closes" in tails.columns:
        before = tails.select(*_PACKED, "closes", *[F.col(n).alias(SEED + n) for n in _CARRIED])

        def arrived(rows: DataFrame) -> DataFrame:
            rows = _spread(rows)
            rows = rows.withColumns({SEED + n: F.when(F.col("_at") == 0, F.col(SEED + n)) for n in _CARRIED})
            return rows.withColumn("place", F.col("_at") + 1).drop("_at")

        layout = {**layout, "arrived": arrived}
    else:
        carried = {SEED + n: F.when(F.col("place") == 1, F.col(n)) for n in _CARRIED}
        before = tails.select(*_TAIL, "place", *[c.alias(n) for n, c in carried.items()])
    rows = df.unionByName(before, allowMissingColumns=True)
    series = with_window_features(lay_out(rows, **layout))
    # Averages start from the last row of the tail; the others have served their turn.
    series = series.rows(lambda d: d.where(F.col("place").isNull() | (F.col("place") == 1)))
    return with_ema_macd(series).frame().where(F.col("place").isNull()).drop("place")


def series_tails(features: DataFrame, tails: DataFrame | None = None) -> DataFrame:
    """The last ``TAIL_ROWS`` rows of each series with what later rows need of them and ``place`` from the end, from the
    rows of some days and the tails before them; series without new rows keep theirs. A packed tail is older than all
    new rows of its series: it is one row among them until these are counted."""
    columns = (*_TAIL, *_CARRIED)
    rows = features.select(*columns)
    is_packed = tails is not None and "closes" in tails.columns
    if is_packed:
        rows = rows.unionByName(tails.select(*_PACKED, *_CARRIED, "closes"), allowMissingColumns=True)
    elif tails is not None:
        rows = rows.unionByName(tails.select(*columns))
    # Packed ids have the order of the ids if all of them are digests.
    if rows.where(~is_digest(F.col("event_id"))).isEmpty():
        rows = packed(rows)
    last = Window.partitionBy("token_address").orderBy(F.desc("event_timestamp"), F.desc("event_id"))
    rows = unpacked(rows.withColumn("place", F.row_number().over(last)).where(F.col("place") <= TAIL_ROWS))
    if not is_packed:
        return rows
    rows = _spread(rows).withColumn("place", F.col("place") + F.coalesce("_at", F.lit(0)))
    alone = {n: F.when(F.coalesce("_at", F.lit(0)) == 0, F.col(n)) for n in _CARRIED}
    return rows.withColumns(alone).where(F.col("place") <= TAIL_ROWS).drop("_at")


def _spread(rows: DataFrame) -> DataFrame:
    """Packed tails, rows with ``closes``, as their rows with ``_at`` from the last; other rows stay and have none. Rows before
    the last of a series have times a microsecond apart and no id: they keep their order, which is all that later rows see."""
    rows = rows.select("*", F.posexplode_outer("closes").alias("_at", "_close")).drop("closes")
    before = F.col("_at") > 0
    return rows.withColumns(
        {
            "event_timestamp": F.timestamp_micros(F.unix_micros("event_timestamp") - F.coalesce("_at", F.lit(0))),
            "event_id": F.when(before, F.lit(None)).otherwise(F.col("event_id")),
            "close": F.when(F.col("_at").isNull(), F.col("close")).otherwise(F.col("_close")),
        }
    ).drop("_close")


def packed_tails(tails: DataFrame) -> DataFrame:
    """Tails as one row a series: its last row, and the closes of the tail, newest first."""
    newest = F.first(F.when(F.col("place") == 1, F.struct("event_timestamp", "event_id", *_CARRIED)), ignorenulls=True)
    closes = F.transform(F.sort_array(F.collect_list(F.struct("place", "close"))), lambda r: r["close"])
    return tails.groupBy("token_address").agg(newest.alias("_last"), closes.alias("closes")).select("token_address", "_last.*", "closes")


def unpacked_tails(tails: DataFrame) -> DataFrame:
    """Tails from their packed rows."""
    rows = _spread(tails.withColumn("close", F.lit(None).cast("double")))
    alone = {n: F.when(F.col("_at") == 0, F.col(n)) for n in _CARRIED}
    return rows.withColumns({**alone, "place": F.col("_at") + 1}).drop("_at")
