"""Reports that start from landed responses."""

from __future__ import annotations

import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from tickloom.operators.holders import explode_holders
from tickloom.plans import jobs, signals
from tickloom.sources import landed, tables


@pytest.fixture
def responses(spark, tmp_path):
    def make(adapter, answers):
        path = tmp_path / f"{adapter.__name__}.json"
        path.write_text("\n".join(json.dumps({"request_key": k, "received_at": at(0).isoformat(), "response": r}) for k, r in answers.items()))
        return adapter(landed.read_landed(spark, str(path)))

    return make


def holders(amounts, share=None, total=None):
    data = {"items": [{"owner": f"o{i}", "amount": a} for i, a in enumerate(amounts)], "holder": total}
    return {"data": data if share is None else {**data, "top10_hold_percent": share}}


def mint(**info):
    return {"result": {"value": {"data": {"parsed": {"info": info}}}}}


@pytest.fixture
def holder_envelopes(responses):
    return responses(
        landed.holders,
        {"A": holders([90, 5, None, 5], 85.0, 3_300_000), "B": holders([1.0] * 100), "C": holders([])},
    )


def test_holder_report(holder_envelopes):
    got = {r["token_address"]: r for r in jobs.holder_report(holder_envelopes).collect()}
    assert got["A"]["verdict_basis"] == "supply" and got["A"]["verdict_tier"] == "CRITICAL" and got["A"]["holder_count"] == 3
    assert got["A"]["total_holders"] == 3_300_000 and got["A"]["top10_share"] == pytest.approx(1.0)
    assert got["B"]["verdict_basis"] == "sample" and got["B"]["verdict_tier"] == "LOW" and got["B"]["supply_tier"] is None
    assert got["C"]["holder_count"] == 0 and got["C"]["verdict_tier"] == "LOW"
    assert explode_holders(holder_envelopes).count() == 103


def test_security_report_and_decisions(spark, responses, holder_envelopes):
    now = at(0)
    sent = {"timestamp": int(now.timestamp()) - 3600, "tokenTransfers": [{"mint": "A", "fromUserAccount": "W", "toUserAccount": "x", "tokenAmount": 5}]}
    wallets = responses(landed.wallet_history, {"W": [sent], "V": []})
    mints = responses(landed.mint_info, {"A": mint(mintAuthority="m", freezeAuthority="f"), "B": mint(), "C": {"error": {"code": 1}}})
    tokens = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "token_address string")
    monitored = spark.createDataFrame([("W", "A"), ("V", "B"), ("unanswered", "C")], "wallet string, token_address string")

    flows = {r["wallet"]: r for r in jobs.outflow_report(wallets, monitored, F.lit(now)).collect()}
    assert flows["W"]["total_outflow"] == 5 and flows["W"]["has_recent_outflow"] and not flows["V"]["has_recent_outflow"]

    report = jobs.security_report(tokens, holder_envelopes, wallets, mints, monitored, F.lit(now))
    got = {r["token_address"]: r for r in report.collect()}
    assert got["A"]["rug_risk_score"] == 100 and got["A"]["risk_tier"] == "CRITICAL" and got["A"]["data_gaps"] == []
    assert got["B"]["rug_risk_score"] == 0 and got["B"]["data_gaps"] == ["holder concentration data unavailable"]
    assert len(got["C"]["data_gaps"]) == 4 and len(got["D"]["data_gaps"]) == 4  # no wallet answer is a gap, not a clean record

    probabilities = spark.createDataFrame([("B", 0.7), ("D", 0.1)], "token_address string, probability double")
    decided = {r["token_address"]: r for r in signals.decisions(report, None, probabilities).collect()}
    assert decided["A"]["override_triggered"] and decided["B"]["action"] == "BUY"
    assert decided["C"]["action"] == "HOLD" and decided["D"]["action"] == "AVOID"


def test_outflow_report_parses_monitored_wallets_alone(spark, responses, monkeypatch):
    """Histories of other wallets are left out before they are parsed, unless too many are monitored to send around."""
    now = at(0)
    sent = [{"signature": "s", "timestamp": int(now.timestamp()), "tokenTransfers": [{"mint": "A", "fromUserAccount": w, "toUserAccount": "x", "tokenAmount": 5}]} for w in "WV"]
    envelopes = responses(landed.wallet_history, {"W": sent[:1], "V": sent[1:]})
    monitored = spark.createDataFrame([("W", "A"), ("W", "B"), (None, "A")], "wallet string, token_address string")

    def rows(report):
        return sorted(map(tuple, report.collect()), key=str)

    few = jobs.outflow_report(envelopes, monitored, F.lit(now))
    assert "LeftSemi" in few._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(jobs, "MAX_WATCHED", 0)
    many = jobs.outflow_report(envelopes, monitored, F.lit(now))
    assert "LeftSemi" not in many._jdf.queryExecution().optimizedPlan().toString()
    assert rows(few) == rows(many) and len(rows(few)) == 3


def test_no_history_is_parsed_below_the_choice_of_wallets(spark, responses):
    """An inner explode has Spark ask for lists that are not empty below the join, which parses those of all wallets."""
    now = at(0)
    sent = {"signature": "s", "timestamp": int(now.timestamp()), "tokenTransfers": [{"mint": "A", "fromUserAccount": "W", "toUserAccount": "x", "tokenAmount": 5}]}
    envelopes = responses(landed.wallet_history, {"W": [sent, {"signature": "t"}, None], "V": [], "U": [sent], "T": None})
    monitored = spark.createDataFrame([(w, "A") for w in "WVT"], "wallet string, token_address string")
    report = jobs.outflow_report(envelopes, monitored, F.lit(now))
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("LeftSemi")
    assert "from_json" in above and "from_json" not in below
    got = {r["wallet"]: (r["total_outflow"], r["outflow_count"]) for r in report.collect()}
    assert got == {"W": (5, 1), "V": (0, 0), "T": (0, 0)}


def test_security_report_parses_histories_of_answered_wallets_alone(spark, responses, holder_envelopes, tmp_path):
    """From bronze, whose long payloads don't share a row group; all histories are there, one row a wallet."""
    now = at(0)
    move = {"mint": "A", "fromUserAccount": "W", "toUserAccount": "x" * 1000, "tokenAmount": 5}
    sent = [{"signature": f"s{i}", "timestamp": int(now.timestamp()), "tokenTransfers": [move]} for i in range(2000)]
    wallets = responses(landed.wallet_history, {w: sent for w in ("W", *(f"V{i}" for i in range(29)))})
    mints = responses(landed.mint_info, {"A": mint()})
    tables.write_bronze(wallets.coalesce(1), f"{tmp_path}/bronze")
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "bronze" / "files").rglob("*.parquet")]
    sizes = [f.row_group(i).total_byte_size for f in files for i in range(f.num_row_groups)]
    assert sum(f.num_rows for f in files) == 30 and sum(sizes) > 60e6 and max(sizes) < 50e6
    tokens = spark.createDataFrame([("A",), ("B",)], "token_address string")
    monitored = spark.createDataFrame([("W", "A"), ("unanswered", "B")], "wallet string, token_address string")
    report = jobs.security_report(tokens, holder_envelopes, tables.read_bronze(spark, f"{tmp_path}/bronze"), mints, monitored, F.lit(now))
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    parsing = [line for line in plan.split("\n") if "from_json" in line and "tokenTransfers" in line]
    assert parsing and not any("Filter" in line for line in parsing)
    got = {r["token_address"]: (r["rug_risk_score"], "dev-wallet outflow data unavailable" in r["data_gaps"]) for r in report.collect()}
    assert got == {"A": (75, False), "B": (0, True)}


def test_wallet_polls_are_made_after_the_shuffle(spark, tmp_path):
    """A poll up to the fourth line and one of all, from lines shuffled as they are; they land compressed."""
    from demo import lake

    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    lines = [(o, 10 + o, s, n, 2.0, 0.1, "R", "O", at(0)) for o, s, n in ((1, 7, 1), (1, 7, 5), (2, 7, None), (3, 8, 6), (4, None, 2))]
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    polls = lake.wallet_polls(spark, str(tmp_path))
    got = {(r.request_key, r.received_at.hour): sorted(t["signature"] for t in json.loads(r.response)) for r in polls.collect()}
    first, second = sorted({h for _, h in got})
    assert got == {
        ("7", first): ["1-1-11-7"], ("7", second): ["1-1-11-7", "1-5-11-7", "2-12-7"], ("8", second): ["3-6-13-8"],
        (None, first): ["4-2-14"], (None, second): ["4-2-14"],
    }
    plan = polls._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("tokenTransfers") < plan.index("RepartitionByExpression")  # above it in the plan
    path = lake._land(spark, polls, "landed")
    files = spark.read.format("binaryFile").load(path).select("path").collect()
    assert files and all(f.path.endswith(".json.gz") for f in files)
