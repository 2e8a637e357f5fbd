from __future__ import annotations

import json
import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from tickloom.operators.prices import price_alerts
from tickloom.streaming import alerts, ingest

TICK = "token_address string, event_id string, event_timestamp timestamp, price double"


def ticks(rows):
    """rows: (token, offset seconds, price)"""
    return [(t, f"{i:04d}", at(s), None if p is None else float(p)) for i, (t, s, p) in enumerate(rows)]


CASES = {
    "single": [(0, 100)],
    "small": [(0, 100), (10, 100.5)],
    "watch": [(0, 100), (10, 102.5)],
    "warning": [(0, 100), (10, 106)],
    "critical": [(0, 100), (10, 125)],
    "high": [(0, 100), (10, 88)],
    "pruned": [(0, 100), (600, 200)],
    "edge": [(0, 100), (300, 110)],
    "past_edge": [(0, 100), (300.001, 110)],
    "zero": [(0, 0), (10, 5)],
    "tie": [(0, 100), (0, 150)],
    "gap": [(0, 100), (5, None), (10, 103)],
}
EXPECT = {"watch": "WATCH", "warning": "WARNING", "critical": "CRITICAL", "high": "HIGH", "edge": "HIGH", "tie": "CRITICAL", "gap": "WATCH"}


@pytest.mark.parametrize("layout", [{}, {"max_rows": 1, "segment_rows": 1}])
def test_batch_alerts(spark, layout):
    rows = ticks([(name, s, p) for name, series in CASES.items() for s, p in series])
    got = price_alerts(spark.createDataFrame(rows, TICK), **layout).collect()
    assert {r["token_address"]: r["severity"] for r in got} == EXPECT
    high = next(r for r in got if r["token_address"] == "high")
    assert high["pct_change"] == pytest.approx(-0.12) and high["window_start_price"] == 100
    assert (high["alert_time"] - high["window_start_time"]) == timedelta(seconds=10)


def message(token, seconds, price, **extra):
    return json.dumps({"token_address": token, "event_timestamp": at(seconds).isoformat().replace("+00:00", "Z"), "payload": {"value": price}, **extra})


def test_decode(spark):
    bad = [message("A", 0, None), json.dumps({"token_address": "A", "event_timestamp": "soon", "payload": {"value": 1}}), "{broken", json.dumps({"payload": {"value": 1}, "event_timestamp": at(0).isoformat()})]
    good = [message("A", 0, 1.5), json.dumps({"token_address": "B", "event_timestamp": "2026-08-01T12:00:00", "payload": {"value": "2"}})]
    decoded = ingest.decode(spark.createDataFrame([(m,) for m in good + bad], "value string"))
    rows = {r["token_address"]: r for r in ingest.ticks(decoded).collect()}
    assert rows["A"]["price"] == 1.5 and rows["B"]["price"] == 2.0 and rows["A"]["event_timestamp"] == rows["B"]["event_timestamp"]
    assert [r["problem"] for r in ingest.dead_letters(decoded).collect()] == ["price", "time", "token", "token"]


def test_keyed_messages(spark):
    df = spark.createDataFrame([("A", 1)], "token_address string, x int")
    row = ingest.keyed_messages(df).first()
    assert row["key"] == "A" and json.loads(row["value"]) == {"token_address": "A", "x": 1}


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    """Three batches in order, each a restart from the checkpoint, give the batch answer."""
    rng = __import__("random").Random(11)
    series = sorted(((t, rng.uniform(0, 3000), rng.uniform(90, 110)) for t in ("A", "B", "C") for _ in range(120)), key=lambda r: r[1])
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    third = len(series) // 3
    for i in range(3):
        part = series[i * third : (i + 1) * third]
        lines = [message(t, s, p, event_id=f"{i * third + j:04d}") for j, (t, s, p) in enumerate(part)] + ["junk"]
        (folder / f"{i}.txt").write_text("\n".join(lines))
        for q in alerts.run_alert_stream(ingest.file_messages(spark, str(folder)), out, str(tmp_path / "cp"), every=None):
            q.awaitTermination()
    rows = [(t, f"{i:04d}", at(s), p) for i, (t, s, p) in enumerate(series)]
    want = price_alerts(spark.createDataFrame(rows, TICK))
    got = spark.read.schema(alerts.ALERT_SCHEMA).parquet(f"{out}/alerts")

    def key(df):
        return sorted((r["event_id"], r["severity"], round(r["pct_change"], 9), r["window_start_time"]) for r in df.collect())

    assert key(got) == key(want) and len(key(got)) > 50
    assert spark.read.parquet(f"{out}/dead_letters").agg(F.count("*")).first()[0] == 3


def test_late_ticks_are_dropped(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    batches = [[("A", 0, 100), ("A", 1000, 100)], [("B", 1001, 5)], [("A", 10, 200), ("A", 990, 103)]]
    for i, batch in enumerate(batches):
        (folder / f"{i}.txt").write_text("\n".join(message(*m) for m in batch))
        for q in alerts.run_alert_stream(ingest.file_messages(spark, str(folder)), out, str(tmp_path / "cp"), every=None):
            q.awaitTermination()
    assert spark.read.schema(alerts.ALERT_SCHEMA).parquet(f"{out}/alerts").count() == 0


def test_state_of_idle_tokens_is_cleared(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, batch in enumerate([[("A", 0, 100), ("A", 100, 100)], [("B", 1000, 5)], [("C", 4000, 5)]]):
        (folder / f"{i}.txt").write_text("\n".join(message(*m) for m in batch))
        for q in alerts.run_alert_stream(ingest.file_messages(spark, str(folder)), str(tmp_path / "out"), str(tmp_path / "cp"), every=None):
            q.awaitTermination()
    state = spark.read.format("statestore").option("path", str(tmp_path / "cp" / "alerts")).option("stateVarName", "ticks").load()
    assert {r["key"]["token_address"] for r in state.collect()} == {"C"}


class Held:
    """State in memory that counts the rows read from it."""

    def __init__(self):
        self.rows, self.map, self.value, self.timers = 0, {}, None, []

    def getMapState(self, *_):  # noqa: N802
        return self

    def getValueState(self, *_):  # noqa: N802
        return Value()

    def registerTimer(self, at):  # noqa: N802
        self.timers.append(at)

    def getValue(self, key):  # noqa: N802
        self.rows += len(self.map[key][0])
        return self.map[key]

    def updateValue(self, key, value):  # noqa: N802
        self.map[key] = value


class Value:
    held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value


def test_state_read_for_a_tick_does_not_grow_with_the_bucket():
    import random

    import pandas as pd

    window = timedelta(minutes=5)
    rng, read = random.Random(1), []
    tracker, state = alerts.MoveTracker(window), Held()
    tracker.init(state)
    all_ticks, got = [], []
    for batch in range(60):
        ticks = [(batch * 20_000_000 + i * 500_000, f"{batch:03d}-{i:02d}", rng.uniform(90, 110)) for i in range(40) if batch % 7 != 3]
        ticks.append((batch * 20_000_000 + 1, f"{batch:03d}-zz", 100.0))
        rng.shuffle(ticks)
        all_ticks += ticks
        frame = pd.DataFrame(ticks, columns=["at", "event_id", "price"])
        frame["event_timestamp"], frame["own"] = pd.to_datetime(frame["at"], unit="us"), True
        before = state.rows
        for out in tracker.handleInputRows(("A", 0), iter([frame.iloc[:5], frame.iloc[5:]]), None):
            got += list(out[["event_id", "pct_change"]].itertuples(index=False, name=None))
        read.append(state.rows - before)
    want = []
    ordered = sorted(all_ticks)
    for at_, event, price in ordered:
        batch_end = (int(event[:3]) + 1) * 20_000_000
        base = next(t for t in ordered if t[0] >= at_ - 300_000_000 and t[0] < batch_end)
        if abs(price / base[2] - 1) >= 0.02:
            want.append((event, price / base[2] - 1))
    assert [e for e, _ in sorted(got)] == [e for e, _ in sorted(want)]
    assert [c for _, c in sorted(got)] == pytest.approx([c for _, c in sorted(want)])
    held = sum(len(v[0]) for v in state.map.values())
    assert state.timers and held > 2000 and max(read[40:]) <= 80 and max(read[40:]) <= max(read[16:40]) + 12


def test_late_ticks_leave_few_files(spark, tmp_path, monkeypatch):
    from tickloom.sources import versions

    folder, run = tmp_path / "in", str(tmp_path / "run")
    folder.mkdir()
    monkeypatch.setattr(alerts, "TIDY_BATCHES", 5)
    for i in range(24):
        rows = [{"token_address": "A", "event_timestamp": at(100 * i).isoformat()}]
        rows += [{"token_address": "B", "event_timestamp": at(100 * (i - 3)).isoformat()}] if i in (5, 6, 11) else []
        file = folder / f"{i:02d}.json"
        file.write_text("\n".join(json.dumps(r) for r in rows))
        os.utime(file, (1_700_000_000 + 10 * i,) * 2)  # files are taken in this order
    stream = spark.readStream.schema("token_address string, event_timestamp timestamp").option("maxFilesPerTrigger", 1).json(str(folder))
    alerts.count_late(stream, run, f"{run}/check", every=None).awaitTermination()
    late = versions.read(spark, f"{run}/late")
    assert sorted((r["token_address"], r["batch"]) for r in late.collect()) == [("B", 5), ("B", 6), ("B", 11)]
    assert len(versions.numbers(spark, f"{run}/late")) <= 2 + 5 and len(versions.current(spark, f"{run}/late").files) <= 2
    assert versions.current(spark, f"{run}/late").notes["batch"] == "23"
    alerts.count_late(stream, run, f"{run}/check", every=None).awaitTermination()
    assert versions.read(spark, f"{run}/late").count() == 3


def test_as_of_stream_equals_batch(spark, tmp_path):
    import random

    from tickloom.operators.prices import prices_as_of
    from tickloom.streaming import as_of

    rng = random.Random(4)
    quotes = sorted((rng.randrange(0, 900), t, None if rng.random() < 0.1 else rng.uniform(1, 9)) for t in "AB" for _ in range(60))
    quotes = [(t, at(s), f"q{i:03d}", p) for i, (s, t, p) in enumerate(quotes)]
    asks = sorted((rng.randrange(0, 900), t) for t in "ABC" for _ in range(40))
    asks = [(f"r{i:03d}", t, at(s)) for i, (s, t) in enumerate(asks)]
    q_schema, a_schema = "token_address string, event_timestamp timestamp, event_id string, price double", "request_id string, token_address string, event_timestamp timestamp"
    for part in range(4):
        span = [r for r in quotes if at(300 * part) <= r[1] < at(300 * part + 300)] + ([("Z", at(90_000), "end", 1.0)] if part == 3 else [])
        spark.createDataFrame(span, q_schema).write.mode("append").parquet(str(tmp_path / "q"))
        spark.createDataFrame([r for r in asks if at(300 * part) <= r[2] < at(300 * part + 300)], a_schema).write.mode("append").parquet(str(tmp_path / "a"))
        found = as_of.prices_as_of(spark.readStream.schema(a_schema).parquet(str(tmp_path / "a")), spark.readStream.schema(q_schema).parquet(str(tmp_path / "q")))
        ingest.start_table_sink(found, str(tmp_path / "out"), str(tmp_path / "check"), None).awaitTermination()

    def key(df):
        return sorted((r["request_id"], r["token_address"], r["price"]) for r in df.select("request_id", "token_address", F.coalesce("price", F.lit(-1.0)).alias("price")).collect())

    want = prices_as_of(spark.createDataFrame(asks, a_schema), spark.createDataFrame(quotes, q_schema))
    assert key(spark.read.schema(as_of.AS_OF_SCHEMA).parquet(str(tmp_path / "out"))) == key(want)


class _Kept:
    """A state variable and the calls to it."""

    def __init__(self):
        self.rows, self.calls = [], 0

    def exists(self):
        return bool(self.rows)

    def get(self):
        self.calls += 1
        return self.rows[0] if len(self.rows) == 1 and self.kind == "value" else iter(list(self.rows))

    def appendValue(self, row):
        self.calls += 1
        self.rows.append(row)

    def update(self, row):
        self.rows = [row]

    def clear(self):
        self.rows = []


class _Handle:
    def __init__(self):
        self.made, self.timers = {}, set()

    def _make(self, name, kind):
        self.made[name] = _Kept()
        self.made[name].kind = kind
        return self.made[name]

    def getListState(self, name, schema):
        return self._make(name, "list")

    def getValueState(self, name, schema):
        return self._make(name, "value")

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class _Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_as_of_state_takes_lots_and_one_timer(monkeypatch):
    """Many rows of many seconds: a few calls to the state and one timer, and what is not due waits."""
    import pandas as pd

    from tickloom.streaming import as_of

    monkeypatch.setattr(as_of, "LOT", 100)
    handle, job = _Handle(), as_of.AsOf()
    job.init(handle)
    n = 1000
    time = pd.to_datetime([1_000_000_000 + i * 1_000_000 for i in range(n)], unit="us")
    rows = pd.DataFrame({"event_timestamp": time, "kind": [i % 2 for i in range(n)], "id": [f"i{i}" for i in range(n)], "price": [None if i % 2 else float(i) for i in range(n)]})
    assert list(job.handleInputRows(("A",), iter([rows[500:], rows[:500]]), None)) == []
    assert handle.timers == {1_001_000} and job.waiting.calls == 2

    handle.timers.clear()
    found = list(job.handleExpiredTimer(("A",), _Watermark(1_600_000), None))
    assert max(map(len, found)) <= 100
    found = pd.concat(found)
    assert found["request_id"].tolist() == [f"i{i}" for i in range(1, 600, 2)]
    assert found["price"].tolist() == [float(i - 1) for i in range(1, 600, 2)]
    assert handle.timers == {1_601_000} and job.waiting.calls == 2 + 1 + 4 and job.last.get() == (598.0,)

    handle.timers.clear()
    found = pd.concat(job.handleExpiredTimer(("A",), _Watermark(9_000_000), None))
    assert len(found) == 200 and not handle.timers and not job.waiting.exists()
