from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest

from tests.conftest import at
from tickloom.operators import backtest as bt

GOLD = "token_address string, event_id string, event_timestamp timestamp, close double, return_1h double, rsi_14 double"


def gold(spark, rsi, closes=None, token="A"):
    closes = closes or [100.0] * len(rsi)
    rows = []
    for i, (r, c) in enumerate(zip(rsi, closes, strict=True)):
        ret = None if i == 0 else c / closes[i - 1] - 1
        rows.append((token, f"{i:03d}", at(3600 * i), float(c), ret, None if r is None else float(r)))
    return spark.createDataFrame(rows, GOLD)


def run(df, **kw):
    return bt.run_backtest(df, **kw).toPandas().sort_values("event_timestamp").reset_index(drop=True)


def test_signals(spark):
    assert run(gold(spark, [20, 50, 80, None]))["signal"].tolist() == ["BUY", "HOLD", "SELL", "HOLD"]


def test_signal_acts_one_row_later(spark):
    assert run(gold(spark, [50, 20, 50, 50, 50]))["position"].tolist() == [0, 0, 1, 1, 1]
    assert run(gold(spark, [20, 50, 50, 80, 50, 50]))["position"].tolist() == [0, 1, 1, 1, 0, 0]


def test_last_close_does_not_change_earlier_rows(spark):
    rsi, base = [50, 20, 50, 50, 80, 50], [100, 101, 102, 103, 104]
    a, b = run(gold(spark, rsi, [*base, 105])), run(gold(spark, rsi, [*base, 999]))
    pd.testing.assert_frame_equal(a.iloc[:5], b.iloc[:5])


def test_fee_lowers_equity_and_no_trade_keeps_it(spark):
    df = gold(spark, [20, 50, 80, 50], [100, 110, 120, 130])
    assert run(df, fee_bps=50)["equity"].iloc[-1] < run(df, fee_bps=0)["equity"].iloc[-1]
    assert (run(gold(spark, [50] * 4, [1, 2, 3, 4]))["equity"] == 1000).all()


def test_hand_equity_and_metrics(spark):
    rows = bt.run_backtest(gold(spark, [20, 50, 50], [100, 110, 121]), fee_bps=0)
    m = bt.metrics(rows).first()
    assert m["total_return"] == pytest.approx(0.21) and m["num_active_periods"] == 2
    assert m["win_rate"] == 1.0 and math.isinf(m["profit_factor"]) and m["max_drawdown"] == 0


def test_single_row_has_zero_ratios(spark):
    m = bt.metrics(bt.run_backtest(gold(spark, [50]))).first()
    assert m["sharpe_ratio"] == 0 and m["sortino_ratio"] == 0 and m["profit_factor"] == 0 and m["win_rate"] == 0


def test_against_a_loop(spark):
    rng = np.random.default_rng(3)
    rsi = rng.uniform(0, 100, 300).tolist()
    closes = (100 * np.cumprod(1 + rng.normal(0, 0.01, 300))).tolist()
    out = run(gold(spark, rsi, closes))
    held, pos, before, equity = 0, [], 0, 1000.0
    for i in range(300):
        pos.append(held)
        ret = 0 if i == 0 else closes[i] / closes[i - 1] - 1
        equity *= 1 + held * ret - (0.001 if held != before else 0)
        assert out["equity"][i] == pytest.approx(equity, rel=1e-9)
        before = held
        held = 1 if rsi[i] < 30 else 0 if rsi[i] > 70 else held
    assert out["position"].tolist() == pos
    curve = out["equity"]
    assert out["drawdown"].min() == pytest.approx(((curve - curve.cummax()) / curve.cummax()).min())
    m, r = bt.metrics(bt.run_backtest(gold(spark, rsi, closes))).first(), out["strategy_return"]
    assert m["sharpe_ratio"] == pytest.approx(r.mean() / r.std() * math.sqrt(8760))
    assert m["sortino_ratio"] == pytest.approx(r.mean() / r[r < 0].std() * math.sqrt(8760))
    active = r[out["position"] == 1]
    assert m["profit_factor"] == pytest.approx(active[active > 0].sum() / -active[active < 0].sum())
