"""Envelopes, landed responses, bronze and silver tables."""

from __future__ import annotations

import json
import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from tickloom.constants import ENVELOPE_SCHEMA, INTERVAL_SECONDS
from tickloom.functions.canonical import canonical_json, drop_empty_objects, event_id
from tickloom.functions.times import feed_time, iso_time
from tickloom.operators import silver
from tickloom.plans import jobs
from tickloom.sources import backfill, envelope, feeds, landed, tables


def ids(spark, rows):
    df = spark.createDataFrame(rows, "source string, token string, ts timestamp, payload string")
    return [r[0] for r in df.select(event_id(F.col("source"), F.col("token"), F.col("ts"), F.col("payload"))).collect()]


def test_event_id(spark):
    a, b, c, d, e, f = ids(
        spark,
        [
            ("s", "t", at(0), '{"c": 1.1, "n": {"y": 1, "x": 2}}'),
            ("s", "t", at(0), '{"n":{"x":2,"y":1},"c":1.1}'),
            ("s", "t", at(0), '{"c": 1.2, "n": {"y": 1, "x": 2}}'),
            ("s2", "t", at(0), '{"c": 1.1, "n": {"y": 1, "x": 2}}'),
            (None, "t", at(0), "{}"),
            ("t", None, at(0), "{}"),
        ],
    )
    assert a == b and len(a) == 64 and len({a, c, d, e, f}) == 5


def test_canonical_json_and_empty_objects(spark):
    df = spark.createDataFrame([('{"b":{},"a":"{}","c":{"d":{}},"e":1}',), ("not json",)], "p string")
    rows = df.select(canonical_json(F.col("p")), drop_empty_objects(F.col("p"))).collect()
    assert rows[0][0] == '{"a":"{}","b":{},"c":{"d":{}},"e":1}'
    assert json.loads(rows[0][1]) == {"a": "{}", "b": None, "c": {"d": {}}, "e": 1}
    assert rows[1][0] == rows[1][1] == "not json"


def test_unknown_domain(spark):
    df = spark.createDataFrame([("a",)], "x string")
    with pytest.raises(ValueError, match="unknown domain"):
        envelope.to_envelope(df, source="s", domain="weather", token=F.col("x"), event_timestamp=F.current_timestamp(), payload=F.col("x"))


def test_times(spark):
    df = spark.createDataFrame(
        [("2026-08-01T12:00:00Z", "Sat, 01 Aug 2026 12:00:00 GMT"), ("2026-08-01T12:00:00", "1 Aug 2026 14:00:00 +0200"), ("2026-08-01T14:00:00+02:00", "Sat, 01 Aug 2026 12:00:00 UTC"), ("soon", "soon")],
        "iso string, rfc string",
    )
    rows = df.select(F.unix_timestamp(iso_time(F.col("iso"))).alias("i"), F.unix_timestamp(feed_time(F.col("rfc"))).alias("r")).collect()
    want = int(at(0).timestamp())
    assert [r["i"] for r in rows] == [want] * 3 + [None] and [r["r"] for r in rows] == [want] * 3 + [None]


def land(tmp_path, name, *responses):
    path = tmp_path / f"{name}.json"
    lines = [json.dumps({"request_key": k, "received_at": at(60).isoformat(), "response": r}) for k, r in responses]
    path.write_text("\n".join(lines) + "\n{broken")
    return str(path)


def test_adapters(spark, tmp_path):
    def run(source, domain, *responses):
        df = landed.ADAPTERS[(source, domain)](landed.read_landed(spark, land(tmp_path, f"{source}-{domain}", *responses)))
        assert df.columns == [c.split()[0] for c in ENVELOPE_SCHEMA.split(", ")]
        return sorted(df.collect(), key=lambda r: (r["token_address"], r["event_timestamp"]))

    rows = run("birdeye", "market", ("T", {"data": {"items": [{"unixTime": 1785585600, "o": 1, "c": 2}, {"o": 1}]}}), ("U", {"success": False}))
    assert len(rows) == 1 and rows[0]["token_address"] == "T" and rows[0]["domain"] == "market"
    assert json.loads(rows[0]["payload"])["c"] == 2 and rows[0]["event_timestamp"].timestamp() == 1785585600

    rows = run(
        "birdeye", "price",
        ("A", {"data": {"value": 1.5, "updateUnixTime": 1785585600}}), ("B", {"data": {"value": 2, "updateUnixTime": 0}}),
        ("C", {"data": {"updateUnixTime": 5}}), ("D", {"data": {"value": 3}}),
    )
    assert [r["token_address"] for r in rows] == ["A", "B", "D"]
    assert rows[0]["event_timestamp"].timestamp() == 1785585600 and rows[1]["event_timestamp"] == rows[2]["event_timestamp"]

    rows = run("birdeye", "holder", ("A", {"data": {"items": [{"owner": "x", "amount": 1}], "holder": 3, "top10_hold_percent": 1.2}}))
    assert json.loads(rows[0]["payload"])["holder"] == 3
    rows = run("birdeye", "security", ("A", {"data": None}))
    assert rows[0]["payload"] == "{}" and rows[0]["domain"] == "security"
    rows = run("helius", "wallet", ("W", [{"timestamp": 1, "tokenTransfers": []}]))
    assert json.loads(rows[0]["payload"]) == {"transactions": [{"timestamp": 1, "tokenTransfers": []}]}
    rows = run("solana_rpc", "security", ("M", {"error": {"code": -1}}))
    assert json.loads(rows[0]["payload"]) == {"error": {"code": -1}}

    rows = run(
        "birdeye", "discovery",
        ("scan", {"data": {"items": [{"address": "X", "liquidity": 5, "extensions": {}}, {"symbol": "none"}, {"address": ""}]}}), ("scan2", {"data": {}}),
    )
    assert len(rows) == 1 and json.loads(rows[0]["payload"]) == {"address": "X", "liquidity": 5, "extensions": None}

    rows = run(
        "cryptopanic", "news",
        ("SOL", {"results": [
            {"id": 7, "title": "a", "published_at": "2026-08-01T12:00:00Z"}, {"id": 8, "title": "b", "published_at": "", "created_at": "2026-08-01T12:00:30Z"},
            {"id": 9, "title": "c", "published_at": "whenever"}, *({"id": i, "title": "x", "published_at": "2026-08-02T00:00:00Z"} for i in range(30)),
        ]}),
    )
    assert len(rows) == 33  # none is lost; a limit must be asked for
    assert [r["event_timestamp"].timestamp() - at(0).timestamp() for r in rows[:3]] == [0, 30, 60]
    assert json.loads(rows[0]["payload"])["_post_id"] == 7


def test_feeds(spark, tmp_path):
    item = "<item><title>{}</title><description>{}</description><link>https://x/{}</link><pubDate>{}</pubDate></item>"
    for n in (1, 2):
        items = item.format("SOL up", "s", n, "Sat, 01 Aug 2026 12:00:00 GMT") + item.format("Other", "about sol", n, "never")
        (tmp_path / f"f{n}.xml").write_text(f"<rss><channel>{items}</channel></rss>")
    paths = {"one.com": str(tmp_path / "f1.xml"), "gone.com": str(tmp_path / "gone.xml"), "two.com": str(tmp_path / "f2.xml")}
    items = feeds.read_feeds(spark, paths)
    everything = feeds.feed_envelopes(items, received_at=F.lit(at(99))).collect()
    assert len(everything) == 4 and {r["token_address"] for r in everything} == {"one.com", "two.com"}
    assert sorted({r["event_timestamp"].timestamp() - at(0).timestamp() for r in everything}) == [0, 99]
    assert feeds.feed_envelopes(items, "SOL").count() == 4
    first = feeds.feed_envelopes(items, "about", limit_per_feed=1).collect()
    assert first == []  # the limit comes before the topic filter
    report = jobs.news_report(spark, {"one.com": str(tmp_path / "f1.xml")})
    assert {r["title"]: r["event_type"] for r in report.collect()} == {"SOL up": "other", "Other": "other"}


def market(spark, rows):
    """rows: (event_id, token, time, ingested, payload)"""
    data = [(e, "birdeye", "1.0", ing, ts, tok, "market", p if isinstance(p, str) else json.dumps(p)) for e, tok, ts, ing, p in rows]
    return spark.createDataFrame(data, ENVELOPE_SCHEMA)


GOOD = {"o": 1.0, "h": 1.1, "l": 0.9, "c": 1.05, "v": 100}


def test_silver(spark):
    rows = [("good", "T", at(0), at(9), GOOD), ("good", "T", at(0), at(5), GOOD), ("text", "T", at(1), at(9), {**GOOD, "c": "1.5"})]
    broken = {
        "neg": {**GOOD, "c": -5}, "zero": {**GOOD, "o": 0}, "nohigh": {**GOOD, "h": None}, "novol": {k: v for k, v in GOOD.items() if k != "v"},
        "nan": '{"o":1,"h":1,"l":1,"c":"NaN","v":1}', "word": {**GOOD, "l": "low"}, "json": "{nope",
    }
    rows += [(k, "T", at(2), at(9), v) for k, v in broken.items()]
    rows += [("notoken", None, at(3), at(9), GOOD), ("notime", "T", None, at(9), GOOD)]
    marked = silver.mark(market(spark, rows)).cache()
    valid, bad = silver.split(marked)
    assert {r["event_id"] for r in valid.collect()} == {"good", "text"}
    got = {r["event_id"]: r for r in bad.collect()}
    assert set(got) == {*broken, "notoken", "notime"}
    assert got["neg"]["quarantine_reasons"] == ["close_out_of_range"] and got["neg"]["close"] == -5
    assert got["novol"]["quarantine_reasons"] == ["volume_missing"] and got["word"]["quarantine_reasons"] == ["low_missing"]
    assert got["notoken"]["quarantine_reasons"] == ["token_missing"] and got["notime"]["quarantine_reasons"] == ["time_missing"]
    assert math.isnan(got["nan"]["close"])
    assert valid.where("event_id = 'good'").first()["ingestion_timestamp"].timestamp() == at(5).timestamp()
    assert valid.count() + bad.count() == marked.count() == 11


def test_dedup_thins_before_the_shuffle(spark):
    plan = silver.dedup(market(spark, [("a", "T", at(0), at(0), GOOD)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_bronze_is_append_only_and_prunes(spark, tmp_path):
    path = str(tmp_path / "bronze")
    rows = [("a", "A", at(0), at(1), GOOD), ("b", "A", at(1), at(1), GOOD), ("c", "A", at(86400), at(1), GOOD), ("d", "001", at(0), at(1), GOOD)]
    batch = market(spark, rows)
    assert tables.partition_counts(batch).count() == 3
    for _ in range(2):
        tables.write_bronze(batch, path, by_token=True)
    back = tables.read_bronze(spark, path)
    assert back.count() == 8 and {r[0] for r in back.select("token").distinct().collect()} == {"A", "001"}
    assert tables.table_files(back).count() == 6
    newest = tables.latest_partition(back)
    assert {r["event_id"] for r in newest.collect()} == {"c"}
    scan = newest._jdf.queryExecution().executedPlan().toString()
    assert any("FileScan" in line and "= Subquery" in line.split("PartitionFilters")[1] for line in scan.splitlines() if "PartitionFilters" in line)
    assert tables.latest_partition(back.where("false")).count() == 0
    tables.write_bronze(batch.where("false"), path, by_token=True)
    assert tables.read_bronze(spark, path).count() == 8
    flat = str(tmp_path / "flat")
    tables.write_bronze(batch, flat)
    assert tables.read_bronze(spark, flat).where("token = '001'").first()["event_id"] == "d"
    assert tables.table_files(tables.read_bronze(spark, flat)).count() == 2


def test_plain_writers(spark, tmp_path):
    batch = market(spark, [("a", "A", at(0), at(1), GOOD)])
    tables.write_ndjson(batch, str(tmp_path / "nd"))
    assert spark.read.json(str(tmp_path / "nd")).first()["event_id"] == "a"
    with pytest.raises(ValueError, match="nothing to write"):
        tables.write_parquet(batch.where("false"), str(tmp_path / "p"), require_non_empty=True)
    tables.write_parquet(batch, str(tmp_path / "p"), require_non_empty=True)
    assert tables.read_table(spark, str(tmp_path / "p")).count() == 1


def test_versions_and_upsert(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "id int, version int, v string")
    assert {(r["id"], r["v"]) for r in tables.latest_versions(df, ["id"], F.col("version")).collect()} == {(1, "b"), (2, "c")}
    new = spark.createDataFrame([(2, 9, "z"), (3, 1, "n")], df.schema)
    got = tables.upsert(df.where("version = 1"), new, ["id"]).collect()
    assert {(r["id"], r["v"]) for r in got} == {(1, "a"), (2, "z"), (3, "n")}


def test_batch_pipeline(spark, tmp_path):
    """Bronze to silver to features to backtest, each run twice with the same result."""
    bronze, silver_path, gold, out = (str(tmp_path / n) for n in ("bronze", "silver", "gold", "backtest"))
    rows = [
        (f"{t}{i}", t, at(3600 * i), at(9), {**GOOD, "c": 100 + (i * k) % 17}) for t, k in (("A", 5), ("B", 7)) for i in range(60)
    ]
    rows += [("bad", "A", at(0), at(9), {**GOOD, "c": -1})]
    tables.write_bronze(market(spark, rows), bronze)
    tables.write_bronze(market(spark, rows[:30]), bronze)
    for _ in range(2):
        assert jobs.silver(spark, bronze, silver_path) == {"valid": 120, "quarantined": 1}
        assert jobs.features(spark, silver_path, gold) == {"rows": 120}
        metrics = jobs.backtest(spark, gold, out).collect()
        assert {r["token_address"] for r in metrics} == {"A", "B"}
    assert jobs.silver(spark, bronze, silver_path, days=("2026-08-02", "2026-08-03")) == {"valid": 2 * 48, "quarantined": 0}
    assert tables.read_silver(spark, silver_path).count() == 120
    assert tables.read_silver(spark, silver_path, "quarantine").first()["quarantine_reasons"] == ["close_out_of_range"]
    assert tables.read_gold(spark, gold).count() == 120 and tables.read_table(spark, out).count() == 120


def test_backfill_chunks(spark):
    day = 86400
    df = spark.createDataFrame([("A", at(0), at(80 * day)), ("B", at(0), at(0)), ("C", at(0), at(37.5 * day))], "token_address string, start timestamp, end timestamp")
    got = backfill.request_chunks(df, "1H").orderBy("token_address", "chunk").collect()
    a = [r for r in got if r["token_address"] == "A"]
    start = int(at(0).timestamp())
    assert [(r["time_from"] - start, r["time_to"] - start) for r in a] == [(0, 3_240_000), (3_240_000, 6_480_000), (6_480_000, 80 * day)]
    assert len([r for r in got if r["token_address"] == "C"]) == 1 and not [r for r in got if r["token_address"] == "B"]
    assert len(INTERVAL_SECONDS) == 14
    with pytest.raises(ValueError, match="unsupported interval"):
        backfill.request_chunks(df, "2m")


def test_discovery_job(spark, tmp_path):
    items = [{"address": "A", "symbol": "a", "liquidity": 20000, "volume_24h_usd": 50000, "holder": 60, "trade_24h_count": 60, "extensions": {}}, {"address": "W", "liquidity": 1, "volume_24h_usd": 51}]
    valid, bad = jobs.discover(spark, land(tmp_path, "scan", ("scan", {"data": {"items": items}})), str(tmp_path / "bronze"))
    assert [r["token_address"] for r in valid.collect()] == ["A"] and bad.first()["problem"] == "volume_to_liquidity"
    scores = spark.createDataFrame([("A", 0, "LOW")], "token_address string, rug_risk_score int, risk_tier string")
    ranked = jobs.watchlist_scan(valid, scores, None, None, str(tmp_path / "scans"), scan_time=F.lit(at(0)))
    assert ranked.first()["action"] == "HOLD"
    assert spark.read.parquet(str(tmp_path / "scans")).first()["severity"] == "INFO"


def test_news_posts_land_whole_texts_in_bounded_responses(spark):
    from demo import lake

    docs = spark.range(1200).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.repeat(F.lit("word "), 30).alias("text"))
    found = [json.loads(r.response)["results"] for r in lake._post_responses(docs).collect()]
    assert sorted(len(x) for x in found) == [200, 500, 500]
    assert sorted(int(p["id"]) for x in found for p in x) == list(range(1200)) and all(p["title"] == "word " * 30 for x in found for p in x)


def test_first_items_of_long_feeds(spark):
    """Beyond the limit that Spark thins by, a feed is ranked by position, in one task or many."""
    rows = spark.createDataFrame([(f, i) for f, n in (("a", 2500), ("b", 30), ("c", 1)) for i in range(n)], "feed string, place int")
    for layout in ({}, {"max_rows": 100, "segment_rows": 70}):
        found = feeds.first_items(rows.orderBy(F.rand(1)), 1200, **layout)
        assert {(r["feed"], r["n"], r["last"]) for r in found.groupBy("feed").agg(F.count("*").alias("n"), F.max("place").alias("last")).collect()} == {("a", 1200, 1199), ("b", 30, 29), ("c", 1, 0)}
        assert found.where(F.col("item_rank") != F.col("place") + 1).count() == 0
    assert feeds.first_items(rows, 3).count() == 7
