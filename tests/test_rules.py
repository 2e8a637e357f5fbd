from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from tickloom.functions import rules
from tickloom.functions.news import classify, mentions, url_domain
from tickloom.operators import discovery, holders, wallets, watchlist
from tickloom.plans import signals

SIGNALS = "name string, tier string, outflow boolean, mint boolean, freeze boolean"


def rug(spark, rows):
    df = spark.createDataFrame(rows, SIGNALS).withColumns(rules.rug_risk(*[F.col(c) for c in ("tier", "outflow", "mint", "freeze")]))
    return {r["name"]: r for r in df.collect()}


def test_rug_score(spark):
    got = rug(
        spark,
        [
            ("clean", "LOW", False, False, False),
            ("crit", "CRITICAL", None, None, None),
            ("all", "CRITICAL", True, True, True),
            ("none", None, None, None, None),
            ("odd", "STRANGE", False, False, False),
            ("flags", "MODERATE", False, True, True),
        ],
    )
    assert got["clean"]["rug_risk_score"] == 0 and got["clean"]["risk_tier"] == "LOW" and got["clean"]["data_gaps"] == []
    assert got["clean"]["reasons"] == ["No red flags detected in the signals that were available"]
    assert got["crit"]["rug_risk_score"] == 50 and got["crit"]["risk_tier"] == "HIGH" and len(got["crit"]["data_gaps"]) == 3
    assert got["all"]["rug_risk_score"] == 100 and len(got["all"]["reasons"]) == 4 and got["all"]["risk_tier"] == "CRITICAL"
    assert got["none"]["rug_risk_score"] == 0 and len(got["none"]["data_gaps"]) == 4
    assert got["odd"]["rug_risk_score"] == 0 and got["odd"]["data_gaps"] == []
    assert got["flags"]["rug_risk_score"] == 50
    assert got["flags"]["reasons"][0] == "Holder concentration is MODERATE (+15 points)"


def decide(spark, rows):
    schema = "name string, s int, t string, p double, n string, c string, m string"
    df = spark.createDataFrame(rows, schema)
    df = df.withColumns(rules.recommendation(*[F.col(c) for c in "stpncm"]))
    df = watchlist.with_severity(df)
    return {r["name"]: r for r in df.collect()}


def test_decisions(spark):
    got = decide(
        spark,
        [
            ("tier", 90, "CRITICAL", 0.99, None, None, "STRONG"),
            ("news", 0, "LOW", 0.99, "hack", "UNKNOWN", None),
            ("mild_news", 0, "LOW", 0.7, "lawsuit", "HIGH", None),
            ("no_model", 0, "LOW", None, None, None, None),
            ("momentum", 30, "MODERATE", None, None, None, "STRONG"),
            ("momentum_high", 50, "HIGH", None, None, None, "STRONG"),
            ("capped", 0, "LOW", 0.95, None, None, None),
            ("edge_buy", None, None, 0.6, None, None, None),
            ("bear", 0, "LOW", 0.3, None, None, None),
            ("high", 50, "HIGH", 0.9, None, None, None),
            ("mid", 30, "MODERATE", 0.45, None, None, None),
        ],
    )
    expect = {
        "tier": ("AVOID", 0.9, True, "CRITICAL"),
        "news": ("AVOID", 0.75, True, "HIGH"),
        "mild_news": ("BUY", 0.7, False, "WATCH"),
        "no_model": ("HOLD", 0.3, False, "INFO"),
        "momentum": ("WATCHLIST", 0.5, False, "INFO"),
        "momentum_high": ("HOLD", 0.3, False, "INFO"),
        "capped": ("BUY", 0.85, False, "WATCH"),
        "edge_buy": ("BUY", 0.6, False, "INFO"),
        "bear": ("AVOID", 0.6, False, "INFO"),
        "high": ("AVOID", 0.6, False, "INFO"),
        "mid": ("HOLD", 0.4, False, "INFO"),
    }
    for name, want in expect.items():
        r = got[name]
        assert (r["action"], r["confidence"], r["override_triggered"], r["severity"]) == want, name
        assert r["would_emergency_exit_if_held"] is r["override_triggered"]
    assert got["news"]["reasons"][0].startswith("SECURITY OVERRIDE: recent news classified as 'hack' (source credibility: UNKNOWN)")
    assert got["tier"]["risks"] == ["Rug-risk tier: CRITICAL"]
    assert got["bear"]["risks"] == ["Entry model probability is 0.30 (bearish)"]
    assert got["high"]["risks"] == ["Rug-risk tier is HIGH (score 50/100)"] and got["high"]["reasons"] == []
    assert got["mid"]["risks"] == ["Rug-risk tier is MODERATE (score 30/100)"]


def test_ranking_and_flat_record(spark):
    rows = [("buy", "BUY", 0.85, False), ("crit", "AVOID", 0.9, True), ("hold", "HOLD", 0.3, False), ("high", "AVOID", 0.75, True), ("b2", "HOLD", 0.3, False)]
    df = spark.createDataFrame(rows, "token_address string, action string, confidence double, override_triggered boolean")
    df = df.withColumns({"reasons": F.array(F.lit("a"), F.lit("b")), "risks": F.array().cast("array<string>"), "would_emergency_exit_if_held": F.col("override_triggered")})
    ranked = watchlist.rank(df)
    assert [r["token_address"] for r in ranked.orderBy("rank").collect()] == ["crit", "high", "buy", "b2", "hold"]
    far = watchlist.rank(df, max_rows=2, segment_rows=2)
    assert [r["token_address"] for r in far.orderBy("rank").collect()] == ["crit", "high", "buy", "b2", "hold"]
    flat = watchlist.flat_record(ranked, F.lit(at(0))).where("token_address = 'buy'").first()
    assert flat["reasons"] == "a; b" and flat["risks"] == "" and flat["severity"] == "WATCH"


def test_mint_flags(spark):
    def doc(info):
        return json.dumps({"result": {"value": {"data": {"parsed": {"info": info}}}}})

    cases = {
        "both": (doc({"mintAuthority": "x", "freezeAuthority": "y"}), (True, True)),
        "absent": (doc({"decimals": 6}), (False, False)),
        "null": (doc({"mintAuthority": None, "freezeAuthority": None}), (False, False)),
        "one": (doc({"mintAuthority": "x"}), (True, False)),
        "error": (json.dumps({"error": {"code": 1}}), (None, None)),
        "no_account": (json.dumps({"result": {"value": None}}), (None, None)),
        "bad": ("{nope", (None, None)),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in cases.items()], "k string, j string")
    mint, freeze = rules.mint_flags(F.col("j"))
    for r in df.select("k", mint.alias("m"), freeze.alias("f")).collect():
        assert (r["m"], r["f"]) == cases[r["k"]][1], r["k"]


def test_candidates_and_momentum(spark):
    rows = [
        ("ok", 20_000.0, 50_000.0, 60, 60),
        ("wash", 12_884.0, 81_413_719.0, 500, 500),
        ("dry", 0.0, 10.0, 1, 1),
        ("noliq", None, 10.0, 1, 1),
        ("neg", 10.0, -1.0, 1, 1),
        ("novol", 10.0, None, 1, 1),
        ("edge", 100.0, 5000.0, 1, 1),
        ("strong", 25_000.0, 60_000.0, 150, 250),
        ("thin", 500_000.0, 5_000_000.0, 5, 1000),
        ("gap", 25_000.0, 60_000.0, None, 250),
    ]
    df = spark.createDataFrame(rows, "token_address string, liquidity double, volume_24h_usd double, holder long, trade_24h_count long")
    valid, bad = discovery.split_candidates(df)
    assert {r[0] for r in valid.select("token_address").collect()} == {"ok", "edge", "strong", "thin", "gap"}
    assert {r[0]: r[1] for r in bad.select("token_address", "problem").collect()} == {
        "wash": "volume_to_liquidity", "dry": "bad_liquidity", "noliq": "bad_liquidity", "neg": "bad_volume", "novol": "bad_volume",
    }
    line = discovery.display_rows(df.withColumn("symbol", F.lit(None).cast("string"))).where("token_address = 'novol'").first()
    assert tuple(line) == ("novol", "novol", "?", 0.0, 10.0)
    tiers = {r["token_address"]: r["momentum_tier"] for r in discovery.with_momentum(df).collect()}
    assert tiers["strong"] == "STRONG" and tiers["ok"] == "MODERATE" and tiers["thin"] is None and tiers["gap"] is None
    top = discovery.top_by_volume(df, 2).collect()
    assert [r["token_address"] for r in top] == ["wash", "thin"]
    page = discovery.screen(df, discovery.ScreenFilters(min_holder=None, min_trade_24h_count=None, limit=1, offset=1)).collect()
    assert [r["token_address"] for r in page] == ["thin"]
    everything = discovery.ScreenFilters("liquidity", "asc", None, None, None, None, None, 500)
    assert discovery.screen(df, everything).count() == len(rows)
    merged = discovery.merge_watchlist(df.where("token_address = 'ok'"), df.where("token_address in ('ok','edge')"))
    assert {tuple(r) for r in merged.collect()} == {("ok", "manual"), ("edge", "discovered")}


def concentration(spark, lists):
    rows = [(t, f"{i:04d}", float(a)) for t, amounts in lists.items() for i, a in enumerate(amounts)]
    df = spark.createDataFrame(rows, "token_address string, owner string, amount double")
    tokens = spark.createDataFrame([(t,) for t in lists], "token_address string")
    return {r["token_address"]: r for r in holders.concentration(df, tokens).collect()}


def test_concentration(spark):
    tail = [0.7] * 100
    got = concentration(
        spark,
        {
            "empty": [],
            "even": [1.0] * 100,
            "whale": [1_000_000, 1, 1, 1],
            "spread": [3.0] * 10 + tail,
            "lumpy": [21.0] + [1.0] * 9 + tail,
            "zero": [0, 0, 0],
            "three": [50, 30, 20],
            **{f"edge{x}": [x] * 10 + [1.0] * (100 - round(10 * x)) for x in (1.5, 2.5, 5, 7, 9)},
        },
    )
    assert (got["empty"]["holder_count"], got["empty"]["hhi"], got["empty"]["risk_tier"]) == (0, 0, "LOW")
    assert got["even"]["top10_share"] == pytest.approx(0.10) and got["even"]["risk_tier"] == "LOW"
    assert got["whale"]["risk_tier"] == "CRITICAL" and got["whale"]["hhi"] > 0.99
    assert got["spread"]["top10_share"] == pytest.approx(got["lumpy"]["top10_share"])
    assert got["lumpy"]["hhi"] > got["spread"]["hhi"]
    assert got["zero"]["top10_share"] == 0 and got["zero"]["holder_count"] == 3 and got["zero"]["risk_tier"] == "LOW"
    assert got["three"]["top10_share"] == pytest.approx(1.0)
    assert [got[f"edge{x}"]["risk_tier"] for x in (1.5, 2.5, 5, 7, 9)] == ["LOW", "MODERATE", "HIGH", "VERY_HIGH", "CRITICAL"]


def test_top_holders_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", "b", 1.0)], "token_address string, owner string, amount double")
    plan = holders.concentration(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_outflows(spark):
    now = at(0)

    def tx(age_hours, *moves):
        ts = None if age_hours is None else int(now.timestamp() - age_hours * 3600)
        return (ts, [(m, s, r, a) for m, s, r, a in moves])

    cases = {
        "sent": [tx(1, ("T", "sent", "x", 500.0))],
        "received": [tx(1, ("T", "x", "received", 500.0))],
        "other": [tx(1, ("U", "other", "x", 500.0))],
        "sums": [tx(3, ("T", "sums", "x", 100.0)), tx(30, ("T", "sums", "x", 250.0)), tx(2, ("T", "sums", "x", 50.0))],
        "old": [tx(240, ("T", "old", "x", 5.0))],
        "untimed": [tx(None, ("T", "untimed", "x", 5.0))],
        "empty": [tx(1)],
        "null": [tx(1, ("T", "null", "x", None))],
        "future": [tx(-5, ("T", "future", "x", 1.0))],
    }
    df = spark.createDataFrame(list(cases.items()), f"wallet string, transactions {wallets.TRANSACTIONS}")
    monitored = spark.createDataFrame([(w, "T") for w in cases], "wallet string, token_address string")
    flows = wallets.outflows(wallets.transfers(df), F.lit(now))
    got = {r["wallet"]: r for r in wallets.outflow_report(monitored, flows).collect()}
    expect = {
        "sent": (500, 1, True), "received": (0, 0, False), "other": (0, 0, False), "sums": (400, 3, True), "old": (5, 1, False),
        "untimed": (5, 1, False), "empty": (0, 0, False), "null": (0, 1, True), "future": (1, 1, True),
    }
    for w, want in expect.items():
        r = got[w]
        assert (r["total_outflow"], r["outflow_count"], r["has_recent_outflow"]) == want, w
    assert got["untimed"]["latest_outflow"] is None


def test_transfers_of_overlapping_polls(spark):
    """Signed transfers count once however many polls show them; unsigned ones all count, equal ones too."""
    move, other = ("T", "w", "x", 5.0), ("T", "x", "w", 7.0)
    first = [("s1", 10, [move, move, other]), (None, 20, [move, move])]
    again = [("s1", 10, [move, move, other]), ("s2", 10, [move]), (None, 20, [move])]
    df = spark.createDataFrame([("w", first), ("w", again), ("v", first)], f"wallet string, transactions {wallets.SIGNED_TRANSACTIONS}")
    counts = {(r["wallet"], r["sender"]): r["count"] for r in wallets.transfers(df).groupBy("wallet", "sender").count().collect()}
    assert counts == {("w", "w"): 2 + 3 + 1, ("w", "x"): 1, ("v", "w"): 2 + 2, ("v", "x"): 1}
    sent = wallets.transfers(df, sent=True)
    assert {(r["wallet"], r["sender"]): r["count"] for r in sent.groupBy("wallet", "sender").count().collect()} == {("w", "w"): 6}
    plain = wallets.transfers(spark.createDataFrame([("w", [(1, [move, move])])], f"wallet string, transactions {wallets.TRANSACTIONS}"))
    assert plain.count() == 2 and "Exchange" not in plain._jdf.queryExecution().toString()


def test_news_classification(spark):
    rows = [
        ("Exchange hacked amid partnership", "x.com", ""),
        ("Firm probed by the SEC", "www.CoinDesk.com", ""),
        ("Quiet day", "www.www.decrypt.co", "funds drained overnight"),
        ("Nothing here", "reuters.com", None),
        ("Token LISTS on market", "decrypt.co", ""),
    ]
    df = spark.createDataFrame(rows, "title string, domain string, summary string")
    got = {r["title"]: r for r in classify(df, description="summary").collect()}
    assert got["Exchange hacked amid partnership"]["event_type"] == "hack"
    assert got["Exchange hacked amid partnership"]["matched_keywords"] == ["hack", "hacked"]
    assert got["Firm probed by the SEC"]["event_type"] == "regulation" and got["Firm probed by the SEC"]["credibility"] == "HIGH"
    assert got["Quiet day"]["event_type"] == "exploit" and got["Quiet day"]["credibility"] == "UNKNOWN"
    assert got["Nothing here"]["event_type"] == "other" and got["Nothing here"]["matched_keywords"] == []
    assert got["Token LISTS on market"]["event_type"] == "exchange_listing"


def test_urls_and_topics(spark):
    urls = {"https://www.a.com/x": "a.com", "http://b.org:8080/y?z": "b.org:8080", "nonsense": "", "https://www.www.c.io": "www.c.io"}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r[0]: r[1] for r in df.select("u", url_domain(F.col("u"))).collect()} == urls
    hit = spark.createDataFrame([("Big SOL news", "x"), ("y", "all about Sol"), ("z", None)], "t string, s string")
    assert [r[0] for r in hit.select(mentions(F.lit("sol"), F.col("t"), F.col("s"))).collect()] == [True, True, False]


def test_security_and_decision_assembly(spark):
    tokens = spark.createDataFrame([("A", "sa"), ("B", "sb"), ("C", None)], "token_address string, symbol string")
    tiers = spark.createDataFrame([("A", "CRITICAL")], "token_address string, supply_tier string")
    flags = spark.createDataFrame([("A", True)], "token_address string, dev_outflow boolean")
    mints = spark.createDataFrame([("A", True, True), ("B", False, False)], "token_address string, mint_active boolean, freeze_active boolean")
    scores = signals.security_scores(tokens, tiers, flags, mints)
    items = spark.createDataFrame(
        [("sb", "dull", "d", 0, 0), ("sb", "new airdrop", "d", 0, 1), ("sb", "hack!", "reuters.com", 1, 0)],
        "topic string, title string, domain string, feed_rank int, item_rank int",
    )
    news = signals.news_signals(items)
    assert news.first()["news_event_type"] == "token_launch"  # first in reading order, not the most severe
    got = {r["token_address"]: r for r in signals.decisions(scores, news).collect()}
    assert got["A"]["action"] == "AVOID" and got["A"]["override_triggered"]
    assert got["B"]["action"] == "HOLD" and got["C"]["action"] == "HOLD" and got["C"]["confidence"] == 0.3
