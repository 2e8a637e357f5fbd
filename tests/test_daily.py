"""Jobs in several runs against one run: features, backtest summaries, positions, the silver stream, keyed tables."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import CANDLE, at
from tickloom.constants import ENVELOPE_SCHEMA
from tickloom.functions import canonical
from tickloom.operators import backtest as bt
from tickloom.operators import features as ft
from tickloom.operators import ledger, series, silver
from tickloom.plans import daily, jobs
from tickloom.sources import keyed, tables, versions
from tickloom.streaming import silver as silver_stream


def candles(spark, seed=0, tokens=("A", "B", "C"), rows=400):
    rng = random.Random(seed)
    out = []
    for t in tokens:
        price, seconds = 100.0, 0
        for i in range(rows if t != "C" else 5):
            price = max(1.0, price * (1 + rng.gauss(0, 0.03)))
            seconds += rng.choice([0, 600, 3600, 9000, 200_000])
            out.append((f"{t}{i:05d}", t, at(seconds), price if i % 50 else 100.0, 5.0))
    out.append(("D1", "D", at(seconds), 7.0, 1.0))
    return spark.createDataFrame(out, CANDLE).withColumn("event_date", F.to_date("event_timestamp"))


def table(df):
    """Rows by event, their values by name."""
    return {r["event_id"]: [r[n] for n in sorted(df.columns)] for r in df.collect()}


def same_rows(got, want):
    assert got.keys() == want.keys()
    for k, row in want.items():
        assert got[k] == [pytest.approx(v, rel=1e-7, abs=1e-9) if isinstance(v, float) else v for v in row], k


@pytest.mark.parametrize("layout", [{}, {"max_rows": 60, "segment_rows": 25}])
def test_features_go_on_after_tails(spark, layout):
    rows = candles(spark)
    days = sorted(r[0] for r in rows.select("event_date").distinct().collect())
    cuts = [days[len(days) // 3], days[len(days) // 3 + 1], days[-1]]
    got, tails, last = {}, None, None
    for cut in cuts:
        part = rows.where((F.col("event_date") <= cut) & (F.lit(True) if last is None else F.col("event_date") > last))
        made = ft.token_features(part, **layout) if tails is None else ft.features_after(part, tails, **layout)
        made = spark.createDataFrame(made.collect(), made.schema)
        got |= table(made)
        tails = ft.series_tails(made, tails.drop("place") if tails is not None else None)
        tails = spark.createDataFrame(tails.collect(), tails.schema)
        last = cut
    same_rows(got, table(ft.token_features(rows)))
    assert tails.groupBy("token_address").count().agg(F.max("count")).first()[0] == ft.TAIL_ROWS


def test_a_day_reads_one_day_and_the_tails(spark, tmp_path):
    silver_path, gold, tails = (str(tmp_path / n) for n in ("silver", "gold", "tails"))
    rows = candles(spark, 3, rows=120)
    columns = [c.split(" ")[0] for c in tables.SILVER_SCHEMA.split(", ")]
    missing = {c: F.lit(None).cast(k) for c, k in (x.split(" ") for x in tables.SILVER_SCHEMA.split(", ")) if c not in rows.columns}
    full = rows.withColumns(missing).select(*columns).withColumns({tables.QUALITY: F.lit("valid"), "quarantine_reasons": F.array().cast("array<string>")})
    tables.write_partitioned(full, silver_path, [tables.QUALITY, "event_date"])
    days = sorted(r[0] for r in rows.select("event_date").distinct().collect())
    read = tables.read_silver(spark, silver_path, keep=tables.within("event_date", days[5], days[5]))
    assert {p.split("event_date=")[1].split("/")[0] for p in read.inputFiles()} == {str(days[5])}
    middle = days[len(days) // 2]
    done = daily.features(spark, silver_path, gold, tails, days[0], middle)
    assert done["first"] is None and done["last"] == middle
    for day in days[days.index(middle) + 1 :]:
        done = daily.features(spark, silver_path, gold, tails, day, day, kept=3)
    assert len(daily.tail_days(spark, tails)) == 3
    same_rows(table(tables.read_gold(spark, gold)), table(ft.token_features(tables.read_silver(spark, silver_path))))
    # A late row comes to an older day: that day and those after it are done again.
    late = full.where("event_id = 'A00001'").withColumns({"event_id": F.lit("late"), "event_date": F.lit(days[-2]), "event_timestamp": F.lit(days[-2]).cast("timestamp")})
    tables.write_partitioned(late, silver_path, [tables.QUALITY, "event_date"], append=True)
    done = daily.features(spark, silver_path, gold, tails, days[-2], days[-2], kept=3)
    assert done["last"] == days[-1]
    got = table(tables.read_gold(spark, gold))
    assert "late" in got
    same_rows(got, table(ft.token_features(tables.read_silver(spark, silver_path))))


@pytest.mark.parametrize("layout", [{}, {"max_rows": 10, "segment_rows": 7}])
def test_folded_summaries_equal_metrics(spark, layout):
    rows = ft.token_features(candles(spark, 5))
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    want = {r["token_address"]: r.asDict() for r in bt.metrics(bt.run_backtest(rows, 45.0, 55.0, 10.0)).collect()}
    for part in (F.to_date("event_timestamp"), F.lit(1), F.xxhash64("event_id") * 0 + F.unix_micros("event_timestamp")):
        parts = bt.summarise(rows.withColumn("part", part), "part", 45.0, 55.0, 10.0, **layout)
        got = {r["token_address"]: r.asDict() for r in bt.fold(parts, "part").collect()}
        assert got.keys() == want.keys()
        for t, figures in want.items():
            assert got[t] == {k: pytest.approx(v, rel=1e-7, abs=1e-9) if isinstance(v, float) else v for k, v in figures.items()}, t


EVENT = "position_id long, event_type string, price double, x double, seconds long, event_id string"


def position_events(spark, rows):
    df = spark.createDataFrame(rows, EVENT)
    return df.select(
        "position_id",
        F.concat(F.lit("T"), F.col("position_id").cast("string")).alias("token_address"),
        "event_type",
        F.timestamp_seconds("seconds").alias("event_timestamp"),
        "event_id",
        "price",
        F.when(F.col("event_type") == "open", F.col("x")).alias("size"),
        F.when(F.col("event_type") == "sell", F.col("x")).alias("sell_fraction"),
    )


def rounded_rows(df):
    names = sorted(df.columns)
    return sorted((tuple(round(r[n], 6) if isinstance(r[n], float) else r[n] for n in names) for r in df.collect()), key=str)


def test_positions_fold_on(spark, tmp_path):
    rng, path = random.Random(11), str(tmp_path / "p")
    rows = []
    for p in range(30):
        for i in range(rng.randint(1, 25)):
            kind = rng.choice(["open", "sell", "price", "price"])
            x = {"open": 10.0, "sell": rng.choice([0.1, 0.5, 1.0, 1.5]), "price": None}[kind]
            rows.append((p, kind, rng.choice([1.0, 2.5, 7.0]), x, rng.randint(0, 300), f"{p}-{i:03d}"))
    late = [r for r in rows if r[0] % 5 == 2 and r[4] < 100]
    calls = [[r for r in rows if lo <= r[4] < lo + 100 and r not in late] for lo in (0, 100, 200)]
    calls[1] += calls[0][:4]  # sent again
    calls[2] += late
    for i, part in enumerate(calls):
        touched = jobs.positions(position_events(spark, part), path)
        assert {r[0] for r in touched.select("position_id").collect()} <= {r[0] for r in part}
        so_far = list(dict.fromkeys(r for c in calls[: i + 1] for r in c))
        whole = ledger.replay(position_events(spark, so_far))
        assert rounded_rows(jobs.current_positions(spark, path)) == rounded_rows(ledger.positions(whole))
        assert rounded_rows(jobs.sale_history(spark, path)) == rounded_rows(ledger.sales(whole))
        assert rounded_rows(jobs.rejected_events(spark, path)) == rounded_rows(ledger.rejections(whole))
    # One event writes one state.
    before = versions.current(spark, f"{path}/states").files
    jobs.positions(position_events(spark, [(1, "price", 9.0, None, 900, "z")]), path)
    new = [f for f in versions.current(spark, f"{path}/states").files if f not in before]
    written = versions.read_files(spark, f"{path}/states", new, versions.current(spark, f"{path}/states").schema)
    assert written.where("level = 0").count() <= 1
    assert jobs.current_positions(spark, path).where("position_id = 1 and highest_price = 9").count() <= 1


def test_positions_without_events(spark, tmp_path):
    path = str(tmp_path / "p")
    for _ in range(2):
        assert jobs.positions(position_events(spark, []), path).count() == 0
    jobs.positions(position_events(spark, [(1, "sell", 1.0, 0.5, 10, "b")]), path)
    assert jobs.current_positions(spark, path).count() == 0
    jobs.positions(position_events(spark, [(1, "open", 2.0, 10.0, 5, "a")]), path)  # late: the sell now counts
    assert jobs.current_positions(spark, path).first()["remaining_size"] == 5
    assert jobs.rejected_events(spark, path).count() == 0


def test_keyed_runs_stay_few(spark, tmp_path):
    path = str(tmp_path / "k")
    rng, want = random.Random(2), {}
    for i in range(22):
        changed = {rng.randrange(40): rng.random() for _ in range(8)}
        want |= changed
        keyed.put(spark.createDataFrame([(k, v, i) for k, v in changed.items()], "k long, v double, version int"), path, ["k"], "version")
        found = keyed.runs(versions.current(spark, path))
        assert all(len(r) < keyed.FANOUT for r in found.values()) and max(found) <= 2
    assert {r["k"]: r["v"] for r in keyed.read(spark, path, ["k"], "version").collect()} == want
    assert versions.read(spark, path).count() <= 40 * sum(len(r) for r in found.values())


def envelopes(spark, rows):
    """(event id, seconds of the event, seconds of arrival, close)"""
    payload = F.format_string('{"o":1,"h":1,"l":1,"c":%s,"v":1}', F.col("c").cast("string"))
    df = spark.createDataFrame(rows, "event_id string, e long, i long, c double")
    return df.select(
        "event_id", F.lit("s").alias("source"), F.lit("1").alias("schema_version"), F.timestamp_seconds("i").alias("ingestion_timestamp"),
        F.timestamp_seconds("e").alias("event_timestamp"), F.lit("A").alias("token_address"), F.lit("market").alias("domain"), payload.alias("payload"),
    ).select(*[c.split(" ")[0] for c in ENVELOPE_SCHEMA.split(", ")])


def test_silver_stream_takes_each_event_once_and_forgets(spark, tmp_path):
    bronze, path, checkpoint = (str(tmp_path / n) for n in ("bronze", "silver", "check"))
    day = 86_400
    rows = lambda d: [(f"e{d}-{i}", d * day + i, d * day + 60 + i, 1.0 if i % 9 else -1.0) for i in range(50)]
    parts = [
        rows(1) + rows(1)[:20],
        rows(2) + [(e, t, i + 3600, c) for e, t, i, c in rows(1)[:30]],  # copies a day later
        rows(9) + [(e, t, 9 * day, c) for e, t, _, c in rows(1)] + [("old", day, 9 * day, 2.0)],  # copies long after the state went
        rows(10),
    ]
    totals = []
    for part in parts:
        tables.write_bronze(envelopes(spark, part), bronze)
        query = silver_stream.start(spark, bronze, path, checkpoint, timedelta(days=2), F.col("ingestion_timestamp"), every=None)
        query.awaitTermination()
        states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        totals.append(states[-1])
    ids = [r[0] for q in ("valid", "quarantine") for r in tables.read_silver(spark, path, q).select("event_id").collect()]
    assert sorted(ids) == sorted({r[0] for p in parts for r in p})
    # After two days the state holds what came within two days, not what came before.
    assert totals[1] == 100 and totals[-1] <= 160
    # What compaction rewrites does not come again, and a batch that was written is not written twice.
    versions.compact(spark, bronze)
    query = silver_stream.start(spark, bronze, path, checkpoint, timedelta(days=2), F.col("ingestion_timestamp"), every=None)
    query.awaitTermination()
    assert tables.read_silver(spark, path).count() + tables.read_silver(spark, path, "quarantine").count() == len(ids)


def test_silver_stream_by_time_of_files(spark, tmp_path):
    bronze, path, checkpoint = (str(tmp_path / n) for n in ("bronze", "silver", "check"))
    for _ in range(2):
        tables.write_bronze(envelopes(spark, [("a", 5, 60, 1.0), ("b", 6, 61, 0.0)]), bronze)
        silver_stream.start(spark, bronze, path, checkpoint, every=None).awaitTermination()
    assert tables.read_silver(spark, path).count() == 1 and tables.read_silver(spark, path, "quarantine").count() == 1


def test_labels_become_final_once(spark, tmp_path):
    from tickloom.operators import labels as lb
    from tickloom.operators.series import lay_out

    gold, path, waiting = (str(tmp_path / n) for n in ("gold", "labels", "open"))
    rows = ft.token_features(candles(spark, 8, rows=90))
    missing = {c: F.lit(None).cast(k) for c, k in (x.split(" ") for x in tables.GOLD_SCHEMA.split(", ")) if c not in rows.columns}
    rows = rows.withColumns(missing).select(*[c.split(" ")[0] for c in tables.GOLD_SCHEMA.split(", ")])
    tables.write_partitioned(rows, gold, ["event_date"])
    days = sorted(r[0] for r in rows.select("event_date").distinct().collect())
    cuts = [days[3], days[4], days[len(days) // 2], days[-1]]
    first, final = days[0], 0
    for last in cuts:
        seen = daily.labels(spark, gold, path, waiting, first, last)
        final += seen["final"]
        assert daily.labels(spark, gold, path, waiting, first, last)["final"] == 0
        assert tables.read_table(spark, path).count() == final
        first = last + timedelta(days=1)
    with pytest.raises(ValueError, match="final up to"):
        daily.labels(spark, gold, path, waiting, days[0], days[1])
    want = lb.with_exit_label(lb.with_entry_label(lay_out(tables.read_gold(spark, gold)))).frame().where("label is not null")
    columns = ("event_id", "label", "exit_label")
    assert rounded_rows(tables.read_table(spark, path).select(*columns)) == rounded_rows(want.select(*columns))
    assert seen["open"] == rows.count() - final


def test_tails_are_one_narrow_row_a_series(spark, tmp_path):
    """What a later run reads is a row with the closes, and goes on as the whole tail does, also where a time repeats."""
    rows = candles(spark, 3, rows=60)
    rows = rows.withColumn("event_timestamp", F.date_trunc("day", "event_timestamp"))
    days = sorted(r[0] for r in rows.select("event_date").distinct().collect())
    early, late = rows.where(F.col("event_date") < days[-1]), rows.where(F.col("event_date") == days[-1])
    tails = ft.series_tails(ft.token_features(early))
    packed = ft.packed_tails(tails)
    assert packed.columns == ["token_address", "event_timestamp", "event_id", "ema_fast", "ema_slow", "macd_signal", "closes"]
    assert packed.count() == rows.select("token_address").distinct().count()
    again = ft.unpacked_tails(packed)
    key = lambda df: sorted((r["token_address"], r["place"], r["close"]) for r in df.collect())
    assert key(again) == key(tails)
    same_rows(table(ft.features_after(late, again)), table(ft.features_after(late, tails)))
    ends = [ft.series_tails(ft.features_after(late, t), t) for t in (again, tails)]
    assert key(ends[0]) == key(ends[1])


def test_ids_are_packed_in_shuffles(spark):
    """Half the bytes for digests, the same ids behind the shuffle, whatever they are."""
    digest = "0123456789abcdef" * 4
    ids = [digest, digest.upper(), digest + "\n", digest[:-1], digest + "0", "g" * 64, "x" * 31, "x" * 32, "x" * 33, "é" * 16, "\x00", "", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "n int, event_id string")
    packed = canonical.packed(df)
    sizes = [r[0] for r in packed.orderBy("n").select(F.length("event_id")).collect()]
    assert sizes[0] == 32 and 32 not in sizes[1:] and packed.select("event_id").distinct().count() == len(ids)
    assert [r["event_id"] for r in canonical.unpacked(packed).orderBy("n").collect()] == ids
    plans = {
        "RepartitionByExpression": series.dealt(df, ["n"]),
        "RebalancePartitions": canonical.unpacked(canonical.packed(df).hint("rebalance", "n")),
        "Window": silver.dedup(envelopes(spark, [("a", 5, 60, 1.0)])),
    }
    for shuffled, made in plans.items():
        above, below = made._jdf.queryExecution().optimizedPlan().toString().split(shuffled, 1)
        assert "hex(" in above and "unhex(" not in above and "unhex(" in below, shuffled


def test_dedup_tells_ids_apart_as_texts(spark):
    digest = "ab" * 32
    rows = [(e, 5, i, float(i)) for i, e in enumerate([digest, digest.upper(), digest, "x", "x", None, None, "x" * 32], 1)]
    kept = silver.dedup(envelopes(spark, rows))
    assert kept.schema["event_id"].dataType.simpleString() == "string"
    found = {(r["event_id"], r["s"]) for r in kept.select("event_id", F.unix_seconds("ingestion_timestamp").alias("s")).collect()}
    assert found == {(digest, 1), (digest.upper(), 2), ("x", 4), (None, 6), ("x" * 32, 8)}


@pytest.mark.parametrize("layout", [{}, {"max_rows": 30, "segment_rows": 20}])
@pytest.mark.parametrize("digests", [False, True])
def test_packed_tails_are_spread_behind_the_shuffle(spark, layout, digests):
    """Features and next tails from packed tails are those from all their rows, also where a time repeats."""
    rows = candles(spark, 4, rows=60).withColumn("event_timestamp", F.date_trunc("day", "event_timestamp"))
    if digests:
        rows = rows.withColumn("event_id", F.sha2("event_id", 256))
    days = sorted(r[0] for r in rows.select("event_date").distinct().collect())
    early, late = rows.where(F.col("event_date") < days[-2]), rows.where(F.col("event_date") >= days[-2])
    tails = ft.series_tails(ft.token_features(early))
    small = ft.packed_tails(tails)
    made = ft.features_after(late, small, deal=True, **layout)
    same_rows(table(made), table(ft.features_after(late, tails, **layout)))
    key = lambda df: sorted((r["token_address"], r["place"], r["close"], r["ema_slow"] if r["place"] == 1 else 0) for r in df.collect())
    assert key(ft.series_tails(made, small)) == [(t, p, c, pytest.approx(e)) for t, p, c, e in key(ft.series_tails(made, tails))]
    again = {r["token_address"]: r["closes"] for r in ft.packed_tails(ft.series_tails(made, small)).collect()}
    assert again == {r["token_address"]: r["closes"] for r in ft.packed_tails(ft.series_tails(made, tails)).collect()}


def test_labels_are_written_once_and_after_a_failure(spark, tmp_path, monkeypatch):
    """Labels and open rows come from one job without a table in between; a run that broke off between the two goes on."""
    gold, path, waiting = (str(tmp_path / n) for n in ("gold", "labels", "open"))
    rows = ft.token_features(candles(spark, 9, rows=40))
    missing = {c: F.lit(None).cast(k) for c, k in (x.split(" ") for x in tables.GOLD_SCHEMA.split(", ")) if c not in rows.columns}
    rows = rows.withColumns(missing).select(*[c.split(" ")[0] for c in tables.GOLD_SCHEMA.split(", ")])
    tables.write_partitioned(rows, gold, ["event_date"])
    days = sorted(r[0] for r in rows.select("event_date").distinct().collect())
    broken = lambda *a, **k: (_ for _ in ()).throw(RuntimeError("broken"))
    with monkeypatch.context() as m:
        m.setattr(daily, "cut", broken)
        seen = daily.labels(spark, gold, path, waiting, days[0], days[2])
    columns = [c.split(" ")[0] for c in tables.GOLD_SCHEMA.split(", ")]
    assert tables.read_table(spark, waiting).columns == columns and tables.read_table(spark, path).columns == [*columns, "label", "exit_label"]
    assert tables.read_table(spark, waiting).where("event_date is null").isEmpty()
    assert tables.read_table(spark, path).count() == seen["final"] and tables.read_table(spark, waiting).count() == seen["open"]
    with monkeypatch.context() as m:
        m.setattr(daily.versions, "overwrite", broken)
        with pytest.raises(RuntimeError, match="broken"):
            daily.labels(spark, gold, path, waiting, days[3], days[-1])
    count = tables.read_table(spark, path).count()
    seen |= daily.labels(spark, gold, path, waiting, days[3], days[-1])
    assert tables.read_table(spark, path).count() == count and seen["open"] == rows.count() - count
    left = [p.name for p in (tmp_path / "labels" / "files").iterdir()]
    assert all(n.startswith("write_id=a-") for n in left), left


def test_labels_of_rows_all_open_or_none(spark, tmp_path):
    gold, path, waiting = (str(tmp_path / n) for n in ("gold", "labels", "open"))
    rows = ft.token_features(candles(spark, 9, tokens=("C",)))
    missing = {c: F.lit(None).cast(k) for c, k in (x.split(" ") for x in tables.GOLD_SCHEMA.split(", ")) if c not in rows.columns}
    rows = rows.withColumns(missing).select(*[c.split(" ")[0] for c in tables.GOLD_SCHEMA.split(", ")])
    tables.write_partitioned(rows, gold, ["event_date"])
    days = sorted(r[0] for r in rows.select("event_date").distinct().collect())
    empty = days[0] - timedelta(days=3)
    assert daily.labels(spark, gold, path, waiting, empty, empty) == {"final": 0, "open": 0}
    assert daily.labels(spark, gold, path, waiting, days[0], days[-1]) == {"final": 0, "open": 6}
    assert tables.read_table(spark, path).count() == 0
