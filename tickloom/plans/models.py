"""Training, scoring and promotion of the entry and exit models, for all tokens at once."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import constants as K
from tickloom.functions.rules import promotion
from tickloom.operators import labels
from tickloom.operators.logistic import MAX_GROUP_ROWS, fit_models
from tickloom.operators.scoring import classifier_metrics, score
from tickloom.operators.series import lay_out
from tickloom.session import cut
from tickloom.sources.tables import upsert

METRICS = ("precision", "recall", "f1", "roc_auc", "brier_score", "positive_rate_train", "positive_rate_test")


@dataclass(frozen=True)
class ModelKind:
    name: str
    features: tuple[str, ...]
    label: str
    params: dict[str, float]


ENTRY = ModelKind(
    "entry",
    K.ENTRY_FEATURES,
    "label",
    {"horizon": K.ENTRY_HORIZON, "upper_pct": K.ENTRY_UPPER_PCT, "lower_pct": K.ENTRY_LOWER_PCT},
)
EXIT = ModelKind(
    "exit",
    K.EXIT_FEATURES,
    "exit_label",
    {
        "holding_period": K.EXIT_HOLDING_PERIOD,
        "horizon": K.EXIT_HORIZON,
        "decline_threshold": K.EXIT_DECLINE_THRESHOLD,
    },
)


@dataclass(frozen=True)
class Training:
    models: DataFrame
    runs: DataFrame
    scored_test: DataFrame


def labelled(gold: DataFrame, kind: ModelKind, **layout) -> DataFrame:
    """Complete feature and label rows of one model kind."""
    series = lay_out(gold, **layout)
    if kind.name == "entry":
        series = labels.with_entry_label(series, **kind.params)
    else:
        series = labels.with_position_features(series, int(kind.params["holding_period"]))
        series = labels.with_exit_label(series, int(kind.params["horizon"]), kind.params["decline_threshold"])
    rows = series.frame().select("token_address", "event_timestamp", "event_id", *kind.features, kind.label)
    return labels.drop_incomplete(rows, kind.features, kind.label)


def train(
    gold: DataFrame, kind: ModelKind, run_id: Column | None = None, max_group_rows: int = MAX_GROUP_ROWS, **layout
) -> Training:
    """Fit one model per token on its earlier rows and measure it on its later rows.

    Tokens with too few rows or a single label class are left out. Labelled, split and scored rows
    are each written once to the shared folder, since each is read several times.
    """
    split = cut(labels.chronological_split(cut(labelled(gold, kind, **layout)), **layout))
    ready = labels.trainable(split, kind.label)
    usable = split.join(ready.select("token_address"), "token_address", "left_semi")
    models = cut(fit_models(usable.where("is_train"), kind.features, kind.label, max_group_rows=max_group_rows))
    scored = cut(
        score(usable.where("not is_train"), models, kind.features).select(
            "token_address", "event_timestamp", "event_id", kind.label, "probability"
        )
    )
    positive_rate = usable.where("is_train").groupBy("token_address").agg(F.avg(kind.label).alias("positive_rate_train"))
    measured = classifier_metrics(scored, kind.label, **layout).join(positive_rate, "token_address")
    if run_id is None:
        run_id = F.lit(uuid.uuid4().hex)  # one id for the call, the same in every task and retry
    began = F.lit(datetime.now(timezone.utc))
    params = F.map_from_arrays(
        F.array(*[F.lit(n) for n in kind.params]), F.array(*[F.lit(float(v)) for v in kind.params.values()])
    )
    tagged = {"model_type": F.lit(kind.name), "run_id": run_id}
    runs = (
        measured.join(models.select("token_address", "n_train"), "token_address")
        .withColumns({**tagged, "start_time": began, "params": params})
        .select("token_address", "model_type", "run_id", "start_time", "params", "n_train", "n_test", *METRICS)
    )
    return Training(models.withColumns({**tagged, "trained_at": began}), runs, scored)


def models_of(stored: DataFrame, chosen: DataFrame, kind: ModelKind) -> DataFrame:
    """The stored models of one kind that ``chosen`` (champions or runs: token_address, model_type, run_id) names."""
    named = chosen.where(F.col("model_type") == kind.name).select("token_address", "model_type", "run_id").distinct()
    return stored.where(F.col("model_type") == kind.name).join(named, ["token_address", "model_type", "run_id"], "left_semi")


def latest_runs(runs: DataFrame) -> DataFrame:
    """Newest run per token and model type; a NaN metric reads as missing."""
    rest = [c for c in runs.columns if c not in ("token_address", "model_type")]
    newest = F.max_by(F.struct(*rest), F.struct("start_time", "run_id")).alias("_r")
    rows = runs.groupBy("token_address", "model_type").agg(newest).select("token_address", "model_type", "_r.*")
    return rows.withColumns({m: F.when(~F.isnan(m), F.col(m)) for m in METRICS if m in rows.columns})


def promotion_decisions(challengers: DataFrame, champions: DataFrame) -> DataFrame:
    """Promote or keep, for every (token, model type) with a challenger."""
    known = champions.select(
        "token_address",
        "model_type",
        F.col("roc_auc").alias("champion_auc"),
        F.col("brier_score").alias("champion_brier"),
        F.lit(True).alias("_known"),
    )
    joined = challengers.join(known, ["token_address", "model_type"], "left")
    has = F.coalesce("_known", F.lit(False))
    columns = promotion(has, *[F.col(c) for c in ("champion_auc", "champion_brier", "roc_auc", "brier_score")])
    return joined.withColumns(columns).drop("_known")


def next_champions(champions: DataFrame, decided: DataFrame) -> DataFrame:
    """Champion table after the promoted challengers replaced theirs."""
    kept = ["token_address", "model_type", "run_id", *[m for m in METRICS if m in decided.columns]]
    return upsert(champions, decided.where("promote").select(*kept), ["token_address", "model_type"])
