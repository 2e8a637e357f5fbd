"""Hot keys must give what one window over the whole key gives."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import CANDLE, at
from tickloom.operators import backtest, features, labels, prices
from tickloom.operators.series import Running, lay_out, lookup

SPLIT = {"max_rows": 40, "segment_rows": 23}


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(7)
    rows = []
    for token, n in (("hot", 400), ("warm", 90), ("cold", 30), ("one", 1)):
        price = 100.0
        for i in range(n):
            price *= 1 + rng.uniform(-0.03, 0.03)
            rows.append((f"{token}{i:05d}", token, at(3600 * (i // 3)), price, float(i % 7)))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, CANDLE).cache()


def table(df):
    pdf = df.toPandas().sort_values("event_id").reset_index(drop=True)
    return pdf[sorted(pdf.columns)]


def same(a, b):
    pd.testing.assert_frame_equal(table(a), table(b), rtol=1e-9, atol=1e-9)


def test_features_do_not_depend_on_layout(mixed):
    same(features.token_features(mixed), features.token_features(mixed, **SPLIT))


def test_backtest_does_not_depend_on_layout(mixed):
    gold = features.with_window_features(lay_out(mixed)).frame()
    same(backtest.run_backtest(gold), backtest.run_backtest(gold, **SPLIT))


def test_labels_do_not_depend_on_layout(mixed):
    def build(series):
        return labels.with_exit_label(labels.with_position_features(labels.with_entry_label(series))).frame()

    same(build(lay_out(mixed)), build(lay_out(mixed, **SPLIT)))


def test_split_does_not_depend_on_layout(mixed):
    same(labels.chronological_split(mixed), labels.chronological_split(mixed, **SPLIT))


def test_index_counts_every_row_once(mixed):
    out = lay_out(mixed, **SPLIT).index("n").frame().toPandas()
    for token, group in out.groupby("token_address"):
        ordered = group.sort_values(["event_timestamp", "event_id"])
        assert list(ordered["n"]) == list(range(1, len(group) + 1)), token


@pytest.mark.parametrize("kind", ["sum", "product", "max", "first", "last"])
def test_running_matches_pandas(mixed, kind):
    value = F.when(F.col("volume") != 3, F.col("close") / 100)
    got = table(lay_out(mixed, **SPLIT).running(x=Running(kind, value)).frame())
    plain = table(mixed).sort_values(["token_address", "event_timestamp", "event_id"])
    v = (plain["close"] / 100).where(plain["volume"] != 3)
    g = v.groupby(plain["token_address"])
    want = {
        "sum": lambda: g.cumsum().groupby(plain["token_address"]).ffill(),
        "product": lambda: g.cumprod().groupby(plain["token_address"]).ffill(),
        "max": lambda: g.cummax().groupby(plain["token_address"]).ffill(),
        "first": lambda: g.transform(lambda s: s.where(s.index == s.first_valid_index()).ffill()),
        "last": lambda: g.ffill(),
    }[kind]()
    np.testing.assert_allclose(got["x"].to_numpy(), want.sort_index().to_numpy(), rtol=1e-9)


def test_one_key_for_all_rows(mixed):
    got = lay_out(mixed, (), ("-close", "event_id"), max_rows=50, segment_rows=37).index("n").frame().toPandas()
    ordered = got.sort_values(["close", "event_id"], ascending=[False, True])
    assert list(ordered["n"]) == list(range(1, len(got) + 1))


def test_alerts_do_not_depend_on_layout(mixed):
    ticks = mixed.withColumnRenamed("close", "price")
    same(prices.price_alerts(ticks), prices.price_alerts(ticks, **SPLIT))


def test_as_of_prices(spark, mixed):
    ticks = mixed.withColumnRenamed("close", "price")
    asks = mixed.select(F.col("event_id").alias("request_id"), "token_address", F.expr("event_timestamp + interval 30 minutes").alias("event_timestamp"))
    got = prices.prices_as_of(asks, ticks, **SPLIT).toPandas().sort_values("request_id")
    left = asks.toPandas().sort_values("event_timestamp")
    right = ticks.toPandas().sort_values(["event_timestamp", "event_id"])[["token_address", "event_timestamp", "price"]]
    want = pd.merge_asof(left, right, on="event_timestamp", by="token_address").sort_values("request_id")
    np.testing.assert_allclose(got["price"].to_numpy(), want["price"].to_numpy())


def test_lookup_with_hot_keys(spark, mixed):
    right = spark.createDataFrame([("hot", 1), ("cold", 2)], "token_address string, v int")
    got = lookup(mixed, right, ["token_address"], max_rows=40).groupBy("token_address", "v").count()
    assert {tuple(r) for r in got.collect()} == {("hot", 1, 400), ("warm", None, 90), ("cold", 2, 30), ("one", None, 1)}


def test_few_range_partitions_and_shuffled_segment_ends(mixed, monkeypatch):
    from tickloom.operators import series

    monkeypatch.setattr(series, "RANGE_PARTITIONS", 2)
    monkeypatch.setattr(series, "BROADCAST_SEGMENTS", 0)
    gold = features.with_window_features(lay_out(mixed)).frame()
    same(backtest.run_backtest(gold), backtest.run_backtest(gold, **SPLIT))


def test_null_key_is_the_same_hot_or_not(spark):
    df = spark.range(50).selectExpr("cast(null as string) as token_address", "id as event_id", "id as event_timestamp")

    def rows(**layout):
        series = lay_out(df, **layout).running(upto=Running("sum", F.col("event_id"))).size("n").index("i")
        return sorted(tuple(r) for r in series.frame().select("event_id", "upto", "n", "i").collect())

    assert rows() == rows(**SPLIT) == [(i, i * (i + 1) // 2, 50, i + 1) for i in range(50)]


def test_hot_group_is_found_and_bounded(mixed):
    series = lay_out(mixed, **SPLIT)
    assert series.longest == 400
    assert {r["token_address"] for r in series.hot_sizes} == {"hot", "warm"}
    sizes = series.hot.groupBy("token_address", "_segment").count().toPandas()["count"]
    assert sizes.max() <= 23


def test_short_segments_do_not_multiply_rows(spark, mixed):
    """The averages look 2,700 rows back, over more than a hundred segments: a row still has few copies."""
    series = features.with_ema_macd(lay_out(mixed, max_rows=40, segment_rows=5))
    copies = []

    def seen(d, w):
        copies.append(d.count())
        return d

    series.bounded(seen).frame()
    assert sum(copies[1:]) < 6 * 490  # the hot rows; before, each had 540 copies
    same(features.token_features(mixed), features.token_features(mixed, max_rows=40, segment_rows=5))


def test_range_partitions_follow_rows(mixed):
    """Segments of two rows: as many range partitions as rows need, not one for each segment."""
    hot = lay_out(mixed, max_rows=40, segment_rows=2).hot
    assert hot.select("_segment").distinct().count() == 200
    assert len(hot.inputFiles()) <= 4  # the shuffle partitions of this session
