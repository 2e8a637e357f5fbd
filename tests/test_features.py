from __future__ import annotations

import pandas as pd
import pytest

from tests.conftest import CANDLE
from tickloom.operators import features as fe


def run(spark, rows, fn):
    out = fn(spark.createDataFrame(rows, CANDLE)).toPandas()
    return out.sort_values(["token_address", "event_timestamp"]).reset_index(drop=True)


def test_returns(spark, candle_rows):
    r = run(spark, candle_rows([100, 110, 121]), lambda d: fe.add_returns(d, [1]))["return_1h"]
    assert pd.isna(r[0]) and r[1] == pytest.approx(0.10) and r[2] == pytest.approx(0.10)


def test_sma_waits_for_a_full_window(spark, candle_rows):
    s = run(spark, candle_rows([10, 20, 30, 40]), lambda d: fe.add_sma(d, 3))["sma_3"]
    assert s.isna().tolist() == [True, True, False, False] and s[2] == 20 and s[3] == 30


def test_volatility_needs_one_row_more(spark, candle_rows):
    rows = candle_rows([100, 105, 100, 110, 100])
    v = run(spark, rows, lambda d: fe.add_volatility(fe.add_returns(d, [1]), 4))["volatility_4"]
    assert v.isna().tolist() == [True, True, True, True, False]


def test_rsi_range_warm_up_and_flat(spark, candle_rows):
    r = run(spark, candle_rows([100 + (i % 5) - 2 for i in range(30)]), fe.add_rsi)["rsi_14"]
    assert r[:13].isna().all() and r[13:].between(0, 100).all()
    flat = run(spark, candle_rows([5.0] * 20), fe.add_rsi)["rsi_14"]
    assert (flat[13:] == 0).all()


def test_future_does_not_change_the_past(spark, candle_rows):
    base = [100 + (i * 7 % 11) for i in range(60)]
    a = run(spark, candle_rows([*base, 99]), fe.token_features)
    b = run(spark, candle_rows([*base, 500]), fe.token_features)
    pd.testing.assert_frame_equal(a.iloc[:60], b.iloc[:60])


def test_tokens_are_apart(spark, candle_rows):
    rows = candle_rows([100, 110, 121], "A") + candle_rows([7, 7, 7], "B")
    out = run(spark, rows, lambda d: fe.add_returns(d, [1]))
    assert (out[out.token_address == "B"]["return_1h"].dropna() == 0).all()


@pytest.mark.parametrize("n", [1, 40, 600, 1700])
def test_ema_matches_pandas(spark, candle_rows, n):
    closes = [100 + 0.5 * i + (i * 37 % 23) for i in range(n)]
    out = run(spark, candle_rows(closes), fe.add_ema_macd)
    s = pd.Series([float(c) for c in closes])
    fast, slow = s.ewm(span=12, adjust=False).mean(), s.ewm(span=26, adjust=False).mean()
    signal = (fast - slow).ewm(span=9, adjust=False).mean()
    pd.testing.assert_series_equal(out["ema_fast"], fast, check_names=False, rtol=1e-12)
    pd.testing.assert_series_equal(out["ema_slow"], slow, check_names=False, rtol=1e-12)
    pd.testing.assert_series_equal(out["macd_signal"], signal, check_names=False, rtol=1e-9, atol=1e-11)


def test_other_spans(spark, candle_rows):
    closes = [50 + (i * 13 % 29) for i in range(300)]
    out = run(spark, candle_rows(closes), lambda d: fe.add_ema_macd(d, 3, 10, 4))
    want = pd.Series([float(c) for c in closes]).ewm(span=3, adjust=False).mean()
    pd.testing.assert_series_equal(out["ema_fast"], want, check_names=False, rtol=1e-12)


def test_spans_too_far_apart(spark, candle_rows):
    with pytest.raises(ValueError, match="too far apart"):
        fe.add_ema_macd(spark.createDataFrame(candle_rows([1, 2]), CANDLE), 2, 5000, 9)
