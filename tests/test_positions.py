from __future__ import annotations

import pytest

from tests.conftest import at
from tickloom.operators import ledger, prices
from tickloom.plans import jobs

EVENT = "position_id long, token_address string, event_type string, event_timestamp timestamp, event_id string, price double, size double, sell_fraction double"


def events(spark, rows):
    """rows: (position, kind, price, size or fraction)"""
    out = []
    for i, (pid, kind, price, x) in enumerate(rows):
        size, fraction = (x, None) if kind == "open" else (None, x)
        out.append((pid, f"T{pid}", kind, at(i), f"{i:04d}", price, size, fraction))
    return spark.createDataFrame(out, EVENT)


CASES = [
    (1, "open", 10.0, 100.0), (1, "sell", 15.0, 0.5), (1, "price", 30.0, None), (1, "sell", 8.0, 0.5), (1, "price", 5.0, None),
    (2, "open", 10.0, 100.0), (2, "sell", 12.0, 1.0), (2, "sell", 20.0, 0.5), (2, "price", 99.0, None),
    (3, "open", 0.0, 5.0), (3, "sell", 1.0, 0.5),
    (4, "open", 1.0, 5.0), (4, "open", 2.0, 6.0), (4, "sell", 3.0, 1.5), (4, "sell", 3.0, 0.0), (4, "sell", 3.0, None), (4, "sell", None, 0.5),
    (5, "sell", 1.0, 0.5), (5, "open", 2.0, 4.0),
    (6, "open", float("nan"), 4.0), (7, "open", 4.0, -1.0),
]


@pytest.mark.parametrize("layout", [{}, {"max_rows": 2, "segment_rows": 2}])
def test_ledger(spark, layout):
    replayed = ledger.replay(events(spark, CASES), **layout)
    state = {r["position_id"]: r for r in ledger.positions(replayed).collect()}
    assert set(state) == {1, 2, 4, 5}
    p1, p2 = state[1], state[2]
    assert (p1["remaining_size"], p1["status"], p1["sales"], p1["highest_price"]) == (25.0, "OPEN", 2, 30.0)
    assert p1["realized_pnl"] == pytest.approx(50 * 5 + 25 * -2)
    assert (p2["remaining_size"], p2["status"], p2["sales"], p2["highest_price"]) == (0.0, "CLOSED", 1, 10.0)
    assert state[4]["entry_price"] == 1.0 and state[4]["sales"] == 0 and state[5]["entry_price"] == 2.0
    reasons = {(r["position_id"], r["event_id"]): r["reason"] for r in ledger.rejections(replayed).collect()}
    assert sorted(reasons.values()) == sorted(
        ["closed", "closed", "bad_open", "no_position", "already_open", *["bad_sell"] * 4, "no_position", "bad_open", "bad_open"]
    )
    sold = {r["event_id"]: r for r in ledger.sales(replayed).collect()}
    assert sold["0001"]["amount_sold"] == 50 and sold["0003"]["amount_sold"] == 25 and sold["0003"]["remaining_size"] == 25


def test_many_sells_against_a_loop(spark):
    rows = [(1, "open", 10.0, 100.0)] + [(1, "sell", 10.0 + i % 5, 0.05 + 0.01 * (i % 7)) for i in range(60)]
    left, gained = 100.0, 0.0
    for _, _, price, f in rows[1:]:
        sold = left * f
        gained += sold * (price - 10)
        left -= sold
    state = ledger.positions(ledger.replay(events(spark, rows), max_rows=10, segment_rows=7)).first()
    assert state["remaining_size"] == pytest.approx(left) and state["realized_pnl"] == pytest.approx(gained)


def test_open_positions_view(spark, tmp_path):
    rows = [(1, "open", 10.0, 100.0), (2, "open", 10.0, 100.0), (3, "open", 10.0, 10.0), (3, "sell", 10.0, 1.0)]
    state = jobs.positions(events(spark, rows), str(tmp_path))
    ticks = spark.createDataFrame([("T1", at(0), "a", 1.0), ("T1", at(5), "b", 15.0), ("T1", at(9), "c", None)], "token_address string, event_timestamp timestamp, event_id string, price double")
    view = {r["position_id"]: r for r in jobs.open_positions_view(state, ticks).collect()}
    assert set(view) == {1, 2}
    assert view[1]["unrealized_pnl"] == 500 and view[1]["unrealized_pnl_pct"] == 0.5 and view[1]["position_value"] == 1500
    assert view[2]["current_price"] is None and view[2]["unrealized_pnl"] is None
    assert prices.latest_prices(ticks).first()["price"] == 15.0
    assert spark.read.parquet(f"{tmp_path}/sales").count() == 1
    jobs.positions(events(spark, rows[:2]), str(tmp_path))
    again = {r["position_id"]: r["status"] for r in jobs.current_positions(spark, str(tmp_path)).collect()}
    assert again == {1: "OPEN", 2: "OPEN", 3: "CLOSED"}
    manual = jobs.manual_watchlist(spark)
    found = spark.createDataFrame([("T1",)], "token_address string")
    decided = spark.createDataFrame([("T1", "HOLD")], "token_address string, action string")
    seen = {r["token_address"]: r for r in jobs.watchlist_view(manual, found, ticks, decided).collect()}
    assert len(seen) == 2 and seen["T1"]["price"] == 15 and seen["T1"]["source"] == "discovered"
