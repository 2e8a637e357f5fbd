from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import CANDLE, at
from tickloom.operators import labels
from tickloom.operators.logistic import fit_array, fit_models
from tickloom.operators.scoring import classifier_metrics, score
from tickloom.operators.series import lay_out
from tickloom.plans import models


def column(spark, rows, fn, name):
    out = fn(lay_out(spark.createDataFrame(rows, CANDLE))).frame().toPandas()
    values = out.sort_values(["token_address", "event_timestamp"])[name]
    return [None if pd.isna(v) else v for v in values]


def entry(spark, rows, h, pct):
    return column(spark, rows, lambda s: labels.with_entry_label(s, h, pct, pct), "label")


@pytest.mark.parametrize(
    ("closes", "h", "first"),
    [
        ([100, 106, 90], 2, 1),
        ([100, 94, 110], 2, 0),
        ([100, 101, 102, 103], 3, 0),
        ([100, 101, 102], 5, None),
        ([100, 101, 102, 1000], 2, 0),
        ([100, 101, 102, 1], 2, 0),
    ],
)
def test_triple_barrier(spark, candle_rows, closes, h, first):
    got = entry(spark, candle_rows(closes), h, 0.05)
    assert got[0] == first and got[-h:] == [None] * min(h, len(closes))


def test_exit_label(spark, candle_rows):
    def run(closes):
        return column(spark, candle_rows(closes), lambda s: labels.with_exit_label(s, 2, 0.10), "exit_label")

    assert run([100, 100, 85, 100]) == [1, 1, None, None]
    assert run([100, 100, 97, 100]) == [0, 0, None, None]


def test_position_features(spark, candle_rows):
    rows = candle_rows([100, 100, 100, 100, 90])
    df = labels.with_position_features(lay_out(spark.createDataFrame(rows, CANDLE)), 4).frame().toPandas()
    last = df.sort_values("event_timestamp").iloc[-1]
    assert last["unrealized_return"] == pytest.approx(-0.10) and last["periods_held"] == 4
    assert last["drawdown_from_high"] == pytest.approx(-0.10)
    assert df["drawdown_from_high"].notna().all()


@pytest.mark.parametrize(("n", "train"), [(100, 80), (37, 29)])
def test_split_is_chronological_and_complete(spark, candle_rows, n, train):
    out = labels.chronological_split(spark.createDataFrame(candle_rows(range(1, n + 1)), CANDLE)).toPandas()
    assert len(out) == n and out["is_train"].sum() == train
    assert out[out.is_train]["event_timestamp"].max() < out[~out.is_train]["event_timestamp"].min()


def test_incomplete_rows_drop_on_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 1.0), (float("nan"), 1.0), (1.0, None)], "x double, label double")
    assert labels.drop_incomplete(df, ["x"], "label").count() == 1


def training_rows(spark, tokens=("A", "B"), n=240, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for token in tokens:
        x = rng.normal(size=(n, 3)) * [1, 5, 0.1] + [0, 20, 1]
        y = (x[:, 0] + (x[:, 1] - 20) / 10 + rng.normal(size=n) * 0.5 > 0).astype(float)
        rows += [(token, *map(float, xi), float(yi)) for xi, yi in zip(x, y, strict=True)]
    return spark.createDataFrame(rows, "token_address string, a double, b double, c double, label double")


def test_one_task_and_whole_cluster_fits_agree(spark):
    df = training_rows(spark)
    small = {r["token_address"]: r for r in fit_models(df, ["a", "b", "c"], "label").collect()}
    large = {r["token_address"]: r for r in fit_models(df, ["a", "b", "c"], "label", max_group_rows=50).collect()}
    assert set(small) == set(large) == {"A", "B"}
    for t in small:
        np.testing.assert_allclose(small[t]["coef"], large[t]["coef"], rtol=1e-7, atol=1e-9)
        np.testing.assert_allclose(small[t]["mean"], large[t]["mean"], rtol=1e-9)
        np.testing.assert_allclose(small[t]["scale"], large[t]["scale"], rtol=1e-9)
        assert small[t]["intercept"] == pytest.approx(large[t]["intercept"], abs=1e-8)
        assert small[t]["n_train"] == large[t]["n_train"] == 240


def test_fit_is_the_minimum_of_its_objective():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 4))
    y = (x[:, 0] - x[:, 1] + rng.normal(size=200) > 0).astype(float)
    mean, scale, w = fit_array(x, y)
    z = np.hstack([(x - mean) / scale, np.ones((200, 1))])

    def loss(v):
        m = z @ v
        return 0.5 * v[:-1] @ v[:-1] + np.sum(np.logaddexp(0, m) - y * m)

    for _ in range(50):
        assert loss(w) <= loss(w + rng.normal(size=5) * 1e-3)


@pytest.mark.parametrize("case", ["separable", "rare", "outlier", "correlated"])
def test_hard_fits_reach_the_optimum(case):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 3))
    y = (x[:, 0] > 0).astype(float)
    if case == "rare":
        y = np.zeros(2000)
        y[:2] = 1
    if case == "outlier":
        x[0] = [1e6, -1e6, 1e6]
    if case == "correlated":
        x[:, 1] = x[:, 0] + rng.normal(size=2000) * 1e-9
    mean, scale, w = fit_array(x, y)
    z = np.hstack([(x - mean) / scale, np.ones((2000, 1))])
    p = 1 / (1 + np.exp(-(z @ w)))
    gradient = z.T @ (p - y) + np.append(w[:-1], 0)
    assert np.max(np.abs(gradient)) < 1e-5


def test_constant_feature_does_not_break_the_fit():
    mean, scale, w = fit_array(np.array([[1.0, 4.0], [2.0, 4.0], [3.0, 4.0], [4.0, 4.0]]), np.array([0.0, 0, 1, 1]))
    assert scale[1] == 1 and np.isfinite(w).all() and w[0] > 0


def test_score_and_metrics_on_learnable_data(spark):
    train, test = training_rows(spark), training_rows(spark, seed=9)
    fitted = fit_models(train, ["a", "b", "c"], "label")
    m = classifier_metrics(score(test, fitted, ["a", "b", "c"]), "label").collect()
    assert len(m) == 2 and all(r["roc_auc"] > 0.85 and r["brier_score"] < 0.2 for r in m)


def test_metric_edges(spark):
    rows = [("tie", 0.5, 1), ("tie", 0.5, 0), ("one", 0.9, 1), ("one", 0.2, 1), ("none", 0.1, 0), ("none", 0.2, 0), ("up", 0.9, 1), ("up", 0.1, 0)]
    m = {r["token_address"]: r for r in classifier_metrics(spark.createDataFrame(rows, "token_address string, probability double, label int"), "label").collect()}
    assert m["tie"]["roc_auc"] == 0.5 and m["up"]["roc_auc"] == 1.0
    assert m["one"]["roc_auc"] is None and m["none"]["precision"] == 0 and m["none"]["f1"] == 0
    assert m["one"]["recall"] == 0.5 and m["one"]["precision"] == 1.0


def test_auc_equals_pair_count_with_hot_layout(spark):
    rng = np.random.default_rng(5)
    p = np.round(rng.uniform(size=400), 2)
    y = (rng.uniform(size=400) < p).astype(int)
    df = spark.createDataFrame([("A", float(a), int(b)) for a, b in zip(p, y, strict=True)], "token_address string, probability double, label int")
    pos, neg = p[y == 1], p[y == 0]
    want = np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))
    got = classifier_metrics(df, "label", max_rows=20, segment_rows=11).first()["roc_auc"]
    assert got == pytest.approx(want)


def test_guards(spark):
    rows = [("few", at(i), f"{i}", float(i % 2)) for i in range(10)]
    rows += [("flat", at(i), f"{i}", 0.0) for i in range(40)]
    rows += [("late", at(i), f"{i}", float(i >= 35)) for i in range(40)]
    rows += [("good", at(i), f"{i}", float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "token_address string, event_timestamp timestamp, event_id string, label double")
    ready = labels.trainable(labels.chronological_split(df), "label").collect()
    assert [r["token_address"] for r in ready] == ["good"]


def test_scaler_sees_train_rows_only(spark):
    df = spark.createDataFrame(
        [("A", at(i), f"{i:03d}", 1.0 if i < 80 else 1000.0 + i, float(i % 2)) for i in range(100)],
        "token_address string, event_timestamp timestamp, event_id string, x double, label double",
    )
    split = labels.chronological_split(df)
    model = fit_models(split.where("is_train"), ["x"], "label").first()
    assert model["mean"] == [1.0] and model["n_train"] == 80


RUN = "token_address string, model_type string, run_id string, start_time timestamp, roc_auc double, brier_score double"


def test_promotion_rule(spark):
    cases = {  # champion (auc, brier), challenger (auc, brier), promoted
        "first": (None, (0.5, 0.2), True),
        "better": ((0.60, 0.20), (0.67, 0.20), True),
        "marginal": ((0.60, 0.20), (0.605, 0.20), False),
        "worse": ((0.60, 0.20), (0.50, 0.20), False),
        "gamed": ((0.60, 0.20), (0.70, 0.35), False),
        "no_auc": ((0.60, 0.20), (None, 0.20), False),
        "nan_auc": ((0.60, 0.20), (float("nan"), 0.20), False),
        "no_brier": ((0.60, None), (0.70, 0.20), True),
    }
    runs = [(t, "entry", "new", at(10), *new) for t, (_, new, _) in cases.items()]
    runs += [(t, "entry", "old", at(0), 0.99, 0.01) for t in cases]
    old = [(t, "entry", "champ", at(-10), *c) for t, (c, _, _) in cases.items() if c]
    old += [("other", "exit", "champ", at(-10), 0.5, 0.1)]
    champions = spark.createDataFrame(old, RUN)
    decided = models.promotion_decisions(models.latest_runs(spark.createDataFrame(runs, RUN)), champions)
    got = {r["token_address"]: r for r in decided.collect()}
    for token, (_, _, promoted) in cases.items():
        assert got[token]["promote"] is promoted, token
        assert got[token]["reasons"], token
    table = {r["token_address"]: r["run_id"] for r in models.next_champions(champions, decided).collect()}
    assert table["better"] == "new" and table["worse"] == "champ" and table["first"] == "new" and table["other"] == "champ"
    assert len(table) == len(cases) + 1


def test_promotion_job(spark, tmp_path):
    from tickloom.plans import jobs

    gold = str(tmp_path / "gold")
    from demo.views import candles
    from tickloom.operators.features import token_features

    rows = token_features(candles(spark, "/root/testdata/sf0.001")).withColumn("event_date", F.to_date("event_timestamp"))
    rows.write.partitionBy("event_date").parquet(gold)
    jobs.train(spark, gold, str(tmp_path / "models"), str(tmp_path / "runs"))
    first = jobs.promote(spark, str(tmp_path / "runs"), None, str(tmp_path / "champions" / "1"))
    assert first.where("not promote").count() == 0
    champions = spark.read.parquet(str(tmp_path / "champions" / "1"))
    assert champions.count() == first.count() and "f1" in champions.columns
    again = jobs.promote(spark, str(tmp_path / "runs"), champions, str(tmp_path / "champions" / "2"))
    assert again.where("promote").count() == 0
    assert spark.read.parquet(str(tmp_path / "models")).where("model_type = 'exit'").count() > 5


def test_training_end_to_end(spark):
    from demo.views import candles
    from tickloom.operators.features import token_features

    gold = token_features(candles(spark, "/root/testdata/sf0.001"))
    for kind in (models.ENTRY, models.EXIT):
        result = models.train(gold, kind, run_id=F.lit("r1"))
        runs = result.runs.toPandas()
        assert len(runs) > 5 and runs["n_train"].min() >= 16
        assert runs["roc_auc"].dropna().between(0, 1).all() and runs["brier_score"].between(0, 1).all()
        assert result.models.count() == len(runs)
        assert set(runs["model_type"]) == {kind.name}
