"""Rolling price-move alerts on a stream, with the same answers as the batch operator.

Ticks are read in event time. A tick later than the watermark is dropped by Spark (``count_late`` keeps such ticks);
any other tick sees every accepted tick of its window, whatever the micro-batches. State is in RocksDB, per token and
time bucket; a timer clears it once the watermark has passed the bucket. Inside a bucket ticks are kept by short slots of
time: a tick asks for the oldest one of its window, so it reads the slot in which its window starts, or the next that
has ticks, and a new tick rewrites its own slot alone.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tickloom.constants import MOVE_SEVERITIES
from tickloom.session import pin_utc, ship
from tickloom.sources import versions
from tickloom.streaming import ingest

ship(__name__)

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ALERT_SCHEMA = (
    "token_address string, event_id string, severity string, pct_change double, window_start_price double, "
    "current_price double, window_start_time timestamp, alert_time timestamp"
)
#: A time bucket is as long as so many windows; a tick near its end is also kept for the next.
BUCKET_WINDOWS = 4
#: Slots of a window; state is read and written by slot.
WINDOW_SLOTS = 64
SLOT_STATE = "at array<bigint>, event_id array<string>, price array<double>"
TICK = ["at", "event_id", "price"]


def moves(fresh: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
    """Alerts for the ticks in ``fresh``, each against the tick in the same row of ``base``.

    Both have at (microseconds), event_id, price.
    """
    start, price = base["price"].to_numpy(), fresh["price"].to_numpy()
    with np.errstate(divide="ignore", invalid="ignore"):
        change = np.where(start != 0, (price - start) / start, 0.0)
    size = np.abs(change)
    severity = np.select([size >= t for t, _ in MOVE_SEVERITIES], [s for _, s in MOVE_SEVERITIES], default="")
    out = pd.DataFrame(
        {
            "event_id": fresh["event_id"].to_numpy(),
            "severity": severity,
            "pct_change": change,
            "window_start_price": start,
            "current_price": price,
            "window_start_time": pd.to_datetime(base["at"].to_numpy(), unit="us"),
            "alert_time": pd.to_datetime(fresh["at"].to_numpy(), unit="us"),
        }
    )
    return out[out["severity"] != ""]


class MoveTracker(StatefulProcessor):
    """State of one token and time bucket: its ticks, and those of the window before it, by slot."""

    def __init__(self, window: timedelta):
        self.window_micros = int(window.total_seconds() * 1_000_000)
        self.bucket_micros = BUCKET_WINDOWS * self.window_micros
        self.slot_micros = max(self.window_micros // WINDOW_SLOTS, 1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.slots = handle.getMapState("ticks", "slot bigint", SLOT_STATE)
        self.held = handle.getValueState("held", "slots array<bigint>")

    def _slot(self, number: int) -> pd.DataFrame:
        """The ticks of a slot, oldest first."""
        return pd.DataFrame(dict(zip(TICK, self.slots.getValue((number,)), strict=True)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        came = pd.concat(list(rows))  # one bucket's ticks of one micro-batch
        new = pd.DataFrame(
            {
                "at": came["event_timestamp"].astype("datetime64[us]").astype("int64").to_numpy(),
                "event_id": came["event_id"].to_numpy(),
                "price": came["price"].astype("float64").to_numpy(),
                "own": came["own"].to_numpy(),
            }
        ).sort_values(["at", "event_id"], ignore_index=True)
        held = set(self.held.get()[0]) if self.held.exists() else set()
        if not held:
            self.handle.registerTimer((int(key[1]) + 1) * self.bucket_micros // 1000 + 1)
        known: dict[int, pd.DataFrame] = {}
        for number, ticks in new.groupby(new["at"] // self.slot_micros):
            number, ticks = int(number), ticks[TICK]
            if number in held:
                ticks = pd.concat([self._slot(number), ticks]).sort_values(["at", "event_id"], ignore_index=True)
            known[number] = ticks.reset_index(drop=True)
            self.slots.updateValue((number,), tuple(ticks[c].tolist() for c in TICK))
        if not known.keys() <= held:
            held |= known.keys()
            self.held.update((sorted(held),))
        alerts = self._alerts(new[new["own"]][TICK], sorted(held), known)
        alerts.insert(0, "token_address", key[0])
        yield alerts

    def _alerts(self, fresh: pd.DataFrame, held: list[int], known: dict[int, pd.DataFrame]) -> pd.DataFrame:
        """Each tick against the oldest of its window: in the slot where the window starts, or the next that is held."""

        def slot(number: int) -> pd.DataFrame:
            if number not in known:
                known[number] = self._slot(number)
            return known[number]

        bases = []
        starts = fresh["at"].to_numpy() - self.window_micros
        for number in np.unique(starts // self.slot_micros):
            here = starts[starts // self.slot_micros == number]
            after = held[bisect_right(held, number) :]
            ticks = slot(int(number)) if bisect_left(held, number) < len(held) - len(after) else None
            place = np.searchsorted(ticks["at"].to_numpy(), here, side="left") if ticks is not None else np.zeros(len(here), int)
            inside = place < len(ticks) if ticks is not None else np.zeros(len(here), bool)
            if inside.any():
                bases.append(ticks.iloc[place[inside]])
            if not inside.all():
                # The tick itself is held, so there is a next slot; starts are in order, and so are the bases.
                bases.append(slot(after[0]).iloc[[0] * int((~inside).sum())])
        base = pd.concat(bases) if bases else fresh.iloc[:0]
        return moves(fresh, base)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.slots.clear()  # no tick of this bucket can come any more
        self.held.clear()
        return iter([])

    def close(self) -> None:
        pass


def in_buckets(ticks: DataFrame, window: timedelta) -> DataFrame:
    """Each tick in its own time bucket and, if a later bucket's window reaches it, there as well (``own`` false)."""
    micros = int(window.total_seconds() * 1_000_000)
    size = BUCKET_WINDOWS * micros
    at = F.unix_micros("event_timestamp")
    bucket = F.floor(at / size)
    late = at >= (bucket + 1) * size - micros
    places = F.when(late, F.array(bucket, bucket + 1)).otherwise(F.array(bucket))
    spread = ticks.select("token_address", "event_timestamp", "event_id", "price", F.posexplode(places).alias("copy", "bucket"))
    return spread.withColumn("own", F.col("copy") == 0).drop("copy")


def price_alerts(ticks: DataFrame, window: timedelta = timedelta(minutes=5), lateness: str = "1 minute") -> DataFrame:
    """Streaming alerts of a tick stream (token_address, event_timestamp, event_id, price).

    A token's history is split by time, so buckets of a busy token are separate tasks and separate states.
    """
    spark = pin_utc(ticks.sparkSession)  # state compares tick times with the watermark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return (
        in_buckets(ticks.withWatermark("event_timestamp", lateness), window)
        .groupBy("token_address", "bucket")
        .transformWithStateInPandas(
            statefulProcessor=MoveTracker(window), outputStructType=ALERT_SCHEMA, outputMode="Append", timeMode="EventTime"
        )
    )


#: Micro-batches after which the table of late ticks is compacted and old versions of it go.
TIDY_BATCHES = 10


def count_late(ticks: DataFrame, path: str, checkpoint: str, lateness: timedelta = timedelta(minutes=1), every: str | None = "20 seconds") -> StreamingQuery:
    """Late ticks to the table ``path/late``: those more than ``lateness`` older than the newest tick of all earlier
    micro-batches.

    The newest time is a note of the table, committed with a micro-batch's rows, so one that is run again changes
    nothing, and nothing is kept for a micro-batch without late ticks. Spark moves its watermark by the same rule, but
    drops a tick only once the watermark has stood for a whole micro-batch, so what it drops is always counted here.
    """
    spark, where = ticks.sparkSession, f"{path}/late"
    micros = int(lateness.total_seconds() * 1_000_000)

    def keep(batch: DataFrame, number: int) -> None:
        version = versions.current(spark, where)
        notes = version.notes if version else {}
        if int(notes.get("batch", -1)) >= number:
            return
        at, before = F.unix_micros("event_timestamp"), notes.get("newest")
        edge = F.lit(None if before is None else int(before) - micros).cast("long")
        newest, late = batch.agg(F.max(at), F.count(F.when(at < edge, 1))).first()
        times = [t for t in (before and int(before), newest) if t is not None]
        more = {"newest": str(max(times))} if times else {}
        rows = batch.where(at < edge).withColumn("batch", F.lit(number).cast("long"))
        if late or version is None:
            versions.append(rows, where, note=("batch", str(number)), more=more)
        else:
            versions.take_note(spark, where, {"batch": str(number), **more})
        if number % TIDY_BATCHES == TIDY_BATCHES - 1:
            versions.compact(spark, where)
            versions.vacuum(spark, where)

    return ingest.start_foreach(ticks, keep, checkpoint, every)


def run_alert_stream(
    messages: DataFrame,
    out_path: str,
    checkpoint: str,
    window: timedelta = timedelta(minutes=5),
    every: str | None = "20 seconds",
) -> tuple[StreamingQuery, StreamingQuery]:
    """Alerts to ``out_path/alerts`` and messages that are no ticks to ``out_path/dead_letters``."""
    decoded = ingest.decode(messages)
    alerts = ingest.start_table_sink(
        price_alerts(ingest.ticks(decoded), window), f"{out_path}/alerts", f"{checkpoint}/alerts", every
    )
    dead = ingest.start_table_sink(ingest.dead_letters(decoded), f"{out_path}/dead_letters", f"{checkpoint}/dead_letters", every)
    return alerts, dead
