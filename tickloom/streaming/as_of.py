"""Prices as of a time, on two streams: each request is answered once every quote at or before it must have come.

Requests and quotes of a token wait in its state until the watermark has passed them; then they are taken in order of time,
a quote before a request of the same time, as in the batch operator. What stays is the last price, so the state of a token is
what came within the lateness and one price. Rows wait in lots, and a token has one timer, so that the calls to the state
store follow the batches and not the rows. A request or quote later than the watermark is dropped by Spark; the last
requests of a stream are answered once later ticks have moved the watermark past them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.session import pin_utc, ship
from tickloom.streaming.alerts import ROCKSDB

ship(__name__)

AS_OF_SCHEMA = "request_id string, token_address string, event_timestamp timestamp, price double"
PACKED = [("at", pa.int64()), ("kind", pa.int32()), ("id", pa.string()), ("price", pa.float64())]
#: Rows of a lot at most, where lots are made anew, and of a frame that is given out.
LOT = 100_000
QUOTE, REQUEST = 0, 1


def answer(waiting: pd.DataFrame, last: float | None) -> tuple[pd.DataFrame, float | None]:
    """Requests among rows in order of time with the price before each, and the last price."""
    prices = waiting["price"].where(waiting["kind"] == QUOTE)
    running = prices.ffill()
    if last is not None:
        running = running.fillna(last)
    final = running.iloc[-1] if len(running) else last
    asked = waiting["kind"] == REQUEST
    found = pd.DataFrame({"request_id": waiting["id"][asked], "at": waiting["at"][asked], "price": running[asked]})
    return found, None if final is None or pd.isna(final) else float(final)


def packed(rows: pd.DataFrame) -> bytes:
    """Rows as one value of state: a call to the state store takes many rows, not one."""
    table = pa.table({n: pa.array(rows[n].to_numpy(), from_pandas=True, type=kind) for n, kind in PACKED}, schema=pa.schema(PACKED))
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def unpacked(lots: Iterable[bytes]) -> pd.DataFrame:
    return pa.concat_tables([pa.ipc.open_stream(lot).read_all() for lot in lots]).to_pandas()


class AsOf(StatefulProcessor):
    """State of one token: rows that the watermark has not passed, in lots, the last price before them, and the time of the
    one timer, which is that of the first row."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("lots", "rows binary")
        self.last = handle.getValueState("last", "price double")
        self.timer = handle.getValueState("timer", "at bigint")

    def wake(self, first: int) -> None:
        """See that a timer goes off after the second of ``first``, microseconds."""
        due = (first // 1_000_000 + 1) * 1000
        known = self.timer.get()[0] if self.timer.exists() else None
        if known is None or due < known:
            if known is not None:
                self.handle.deleteTimer(known)
            self.handle.registerTimer(due)
            self.timer.update((due,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for came in rows:
            at = came["event_timestamp"].astype("datetime64[us]").astype("int64")
            self.waiting.appendValue((packed(came.assign(at=at)),))
            first = int(at.min()) if first is None else min(first, int(at.min()))
        if first is not None:
            self.wake(first)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        edge = timerValues.getCurrentWatermarkInMs() * 1000
        self.timer.clear()
        lots = [lot for (lot,) in self.waiting.get()]
        if not lots:
            return
        rows = unpacked(lots)
        due = rows["at"] < edge
        if due.any():
            found, last = answer(rows[due].sort_values(["at", "kind", "id"], ignore_index=True), self.last.get()[0] if self.last.exists() else None)
            if last is not None:
                self.last.update((last,))
            rows = rows[~due]
            self.waiting.clear()
            for start in range(0, len(rows), LOT):
                self.waiting.appendValue((packed(rows.iloc[start : start + LOT]),))
            for start in range(0, len(found), LOT):
                some = found.iloc[start : start + LOT]
                # Plain objects: frames of Arrow strings are chunked when Spark joins them, which it then refuses.
                names = some["request_id"].astype(object)
                yield pd.DataFrame(
                    {
                        "request_id": names.where(names.notna(), None).to_numpy(),
                        "token_address": pd.Series([key[0]] * len(some), dtype=object).to_numpy(),
                        "event_timestamp": pd.to_datetime(some["at"].to_numpy(), unit="us"),
                        "price": some["price"].astype("float64").to_numpy(),
                    }
                ).astype({"request_id": object, "token_address": object})
        if len(rows):
            self.wake(int(rows["at"].min()))

    def close(self) -> None:
        pass


def prices_as_of(requests: DataFrame, ticks: DataFrame, lateness: str = "1 minute") -> DataFrame:
    """Answers to a stream of requests (request_id, token_address, event_timestamp) from a stream of ticks."""
    spark = pin_utc(ticks.sparkSession)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    common = ("token_address", "event_timestamp")
    quotes = ticks.where(F.col("price").isNotNull()).select(
        *common, F.lit(QUOTE).alias("kind"), F.col("event_id").cast("string").alias("id"), F.col("price").cast("double").alias("price")
    )
    asks = requests.select(*common, F.lit(REQUEST).alias("kind"), F.col("request_id").cast("string").alias("id"), F.lit(None).cast("double").alias("price"))
    return (
        quotes.unionByName(asks)
        .withWatermark("event_timestamp", lateness)
        .groupBy("token_address")
        .transformWithStateInPandas(statefulProcessor=AsOf(), outputStructType=AS_OF_SCHEMA, outputMode="Append", timeMode="EventTime")
    )
