"""One L2-penalised logistic regression per key, on features standardised by the train rows.

The objective is half the squared weights plus the summed log-loss, intercept not penalised.
A key with few enough rows is fitted in one task (Newton steps in numpy). A key with more is fitted
by the whole cluster: each Newton step is one aggregate of gradient and curvature sums over its rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tickloom.operators.series import group_sizes, split_hot
from tickloom.session import cut, ship

ship(__name__)

MAX_GROUP_ROWS = 2_000_000
BROADCAST_MODELS = 10_000
STEPS, TOLERANCE, MAX_MOVE = 100, 1e-10, 2.0
#: A deviation this small against the mean is rounding of a constant column; its scale is 1.
CONSTANT = 1e-9


def newton_step(weights: np.ndarray, gradient: np.ndarray, curvature: np.ndarray) -> np.ndarray:
    """Next weights from log-loss sums; the last weight is the intercept.

    A step is cut to MAX_MOVE in its largest weight: full steps can run away where the classes
    separate, and near the optimum steps are small anyway.
    """
    penalty = np.ones(len(weights))
    penalty[-1] = 0.0
    ridge = np.diag(np.where(penalty > 0, penalty, 1e-12))
    step = np.linalg.solve(curvature + ridge, gradient + penalty * weights)
    return weights - step * min(1.0, MAX_MOVE / max(np.max(np.abs(step)), 1e-300))


def fit_array(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, scale, weights) of one training set."""
    return newton_fit(x, y)[:3]


def newton_fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """(mean, scale, weights, converged) of one training set."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > CONSTANT * np.abs(mean), scale, 1.0)
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -700, 700)))
        nxt = newton_step(w, z.T @ (p - y), (z * (p * (1 - p))[:, None]).T @ z)
        done = np.max(np.abs(nxt - w)) < TOLERANCE
        w = nxt
        if done:
            break
    return mean, scale, w, bool(done)


def _model_schema(df: DataFrame, keys: Sequence[str]) -> T.StructType:
    arrays = [T.StructField(n, T.ArrayType(T.DoubleType())) for n in ("mean", "scale", "coef")]
    return T.StructType(
        [
            *df.select(*keys).schema.fields,
            *arrays,
            T.StructField("intercept", T.DoubleType()),
            T.StructField("n_train", T.LongType()),
            T.StructField("converged", T.BooleanType()),
        ]
    )


def _fit_small(train: DataFrame, keys: list[str], features: list[str], label: str, schema: T.StructType) -> DataFrame:
    """One Arrow table per key in, one row out.

    Fitting costs far more than its bytes suggest, so the keys are spread over all shuffle partitions
    instead of being merged by size.
    """
    arrow = to_arrow_schema(schema)

    def fit(table: pa.Table) -> pa.Table:
        x = np.column_stack([table.column(f).to_numpy() for f in features])
        mean, scale, w, done = newton_fit(x, table.column(label).to_numpy())
        row = {k: table.column(k)[0].as_py() for k in keys}
        row |= {"mean": mean, "scale": scale, "coef": w[:-1], "intercept": float(w[-1]), "n_train": len(x), "converged": done}
        return pa.Table.from_pydict({n: [v] for n, v in row.items()}, schema=arrow)

    doubles = [F.col(c).cast("double").alias(c) for c in (*features, label)]
    partitions = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = train.select(*keys, *doubles).repartition(partitions, *keys)
    return spread.groupBy(*keys).applyInArrow(fit, schema)


def _solve(keys: list[str], size: int):
    """Newton step for each row of sums; runs on the executors."""
    cells = [(i, j) for i in range(size) for j in range(i, size)]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            weights, moves = [], []
            for w, g, h in zip(pdf["w"], pdf["g"], pdf["h"], strict=True):
                curvature = np.zeros((size, size))
                for (a, b), v in zip(cells, h, strict=True):
                    curvature[a, b] = curvature[b, a] = v
                nxt = newton_step(np.asarray(w), np.asarray(g), curvature)
                weights.append(nxt)
                moves.append(float(np.max(np.abs(nxt - np.asarray(w)))))
            yield pdf[[*keys, "mean", "scale", "n_train"]].assign(w=weights, move=moves)

    return solve


def _fit_large(train: DataFrame, keys: list[str], features: list[str], label: str, hot: list) -> DataFrame:
    """Newton steps over the whole cluster. The state, one row per hot key, is a table between steps;
    the driver only learns how far the weights moved."""
    size = len(features) + 1
    xs = [F.col(f).cast("double") for f in features]
    spread = F.array(*[F.stddev_pop(x) for x in xs])
    state = cut(
        train.groupBy(*keys)
        .agg(F.array(*[F.avg(x) for x in xs]).alias("mean"), spread.alias("scale"), F.count(F.lit(1)).alias("n_train"))
        .withColumn("scale", F.zip_with("scale", "mean", lambda s, m: F.when(s > CONSTANT * F.abs(m), s).otherwise(1.0)))
        .withColumn("w", F.array_repeat(F.lit(0.0), size))
        .withColumn("move", F.lit(float("inf")))
    )
    z = [(x - F.col("mean")[i]) / F.col("scale")[i] for i, x in enumerate(xs)] + [F.lit(1.0)]
    given = F.broadcast(state) if len(hot) <= BROADCAST_MODELS else state
    standard = cut(  # standardised once, read at every step
        train.join(given, keys).select(*keys, F.col(label).cast("double").alias("_y"), *[c.alias(f"_z{i}") for i, c in enumerate(z)])
    )
    zc = [F.col(f"_z{i}") for i in range(size)]
    p = F.col("_p")
    gradient = [F.sum((p - F.col("_y")) * c) for c in zc]
    curvature = [F.sum(p * (1 - p) * zc[i] * zc[j]) for i in range(size) for j in range(i, size)]
    known = ["mean", "scale", "n_train", "w"]
    for _ in range(STEPS):
        current = F.broadcast(state) if len(hot) <= BROADCAST_MODELS else state
        rows = standard.join(current, keys)
        margin = sum((F.col("w")[i] * zc[i] for i in range(size)), F.lit(0.0))
        sums = (
            rows.withColumn("_p", 1 / (1 + F.exp(-margin)))
            .groupBy(*keys)
            .agg(F.array(*gradient).alias("g"), F.array(*curvature).alias("h"), *[F.first(c).alias(c) for c in known])
        )
        state = cut(sums.mapInPandas(_solve(keys, size), state.select(*keys, "mean", "scale", "n_train", "w", "move").schema))
        if state.agg(F.max("move")).first()[0] < TOLERANCE:
            break
    return state.select(
        *keys,
        "mean",
        "scale",
        F.slice("w", 1, size - 1).alias("coef"),
        F.col("w")[size - 1].alias("intercept"),
        "n_train",
        (F.col("move") < TOLERANCE).alias("converged"),
    )


def fit_models(
    train: DataFrame, features: Sequence[str], label: str, keys: Sequence[str] = ("token_address",), max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Model table: keys, mean, scale, coef (one entry per feature), intercept, n_train, converged."""
    keys, features = list(keys), list(features)
    schema = _model_schema(train, keys)
    _, hot = group_sizes(train, keys, max_group_rows)
    if not hot:
        return _fit_small(train, keys, features, label, schema)
    small, large = split_hot(train, keys, hot)
    return _fit_small(small, keys, features, label, schema).unionByName(
        _fit_large(large, keys, features, label, hot)
    )
