"""Scores from stored models, and classifier metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.series import Running, lay_out, lookup
from tickloom.session import cut
from tickloom.sources.tables import latest_versions


def score(rows: DataFrame, models: DataFrame, features: Sequence[str], keys: Sequence[str] = ("token_address",), **hot) -> DataFrame:
    """Add ``probability`` from a model table (keys, mean, scale, coef, intercept). No model, no probability.

    A table of several runs (``run_id``, ``trained_at``) gives the newest model of each key; pick a run or the
    champions beforehand to score with others.
    """
    if "trained_at" in models.columns:
        models = latest_versions(models, keys, F.struct("trained_at", "run_id"))
    joined = lookup(rows, models.select(*keys, "mean", "scale", "coef", "intercept"), keys, **hot)
    x = F.array(*[F.col(f).cast("double") for f in features])
    centred = F.zip_with(x, "mean", lambda a, m: a - m)
    scaled = F.zip_with(centred, "scale", lambda a, s: a / s)
    terms = F.zip_with(scaled, "coef", lambda a, c: a * c)
    margin = F.aggregate(terms, F.col("intercept"), lambda total, t: total + t)
    return joined.withColumn("probability", 1 / (1 + F.exp(-margin))).drop("mean", "scale", "coef", "intercept")


def classifier_metrics(
    scored: DataFrame, label: str, keys: Sequence[str] = ("token_address",), probability: str = "probability", **layout
) -> DataFrame:
    """Precision, recall, F1, ROC-AUC (null with one class), Brier score and positive rate per key.

    AUC counts pairs with ties as one half. Rows are first summed per distinct probability, in one pass that is
    written; everything else reads those sums, and a running count of the negatives below gives the pairs.
    """
    p, y = F.col(probability), F.col(label)
    steps = cut(
        scored.groupBy(*keys, p.alias("_p")).agg(
            F.count(F.lit(1)).alias("_rows"),
            F.count_if(y == 1).cast("double").alias("_pos"),
            F.count_if(y == 0).cast("double").alias("_neg"),
            F.sum((p - y) * (p - y)).alias("_error"),
        )
    )
    hit = F.col("_p") > 0.5
    total = {"_tp": F.when(hit, F.col("_pos")), "_fp": F.when(hit, F.col("_neg")), "_fn": F.when(~hit, F.col("_pos"))}
    base = (
        steps.groupBy(*keys)
        .agg(
            F.sum("_rows").alias("n_test"),
            F.sum("_error").alias("_error"),
            F.sum("_pos").alias("_ones"),
            F.sum(F.col("_pos") + F.col("_neg")).alias("_known"),
            F.sum(F.when(F.col("_p").isNotNull(), F.col("_pos") + F.col("_neg"))).alias("_judged"),
            *[F.coalesce(F.sum(c), F.lit(0.0)).alias(n) for n, c in total.items()],
        )
        .withColumns(
            {
                "brier_score": F.try_divide("_error", "_judged"),
                "positive_rate_test": F.try_divide("_ones", "_known"),
            }
        )
    )
    pairs = (
        lay_out(steps, keys, ("_p",), **layout)
        .running(_below=Running("sum", F.col("_neg")))
        .frame()
        .groupBy(*keys)
        .agg(
            F.sum(F.col("_pos") * (F.col("_below") - F.col("_neg") / 2)).alias("_won"),
            F.sum("_pos").alias("_p"),
            F.sum("_neg").alias("_n"),
        )
        .select(*keys, F.try_divide(F.col("_won"), F.col("_p") * F.col("_n")).alias("roc_auc"))
    )
    precision = F.coalesce(F.try_divide(F.col("_tp"), F.col("_tp") + F.col("_fp")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("_tp"), F.col("_tp") + F.col("_fn")), F.lit(0.0))
    f1 = F.try_divide(2.0 * F.col("_tp"), 2 * F.col("_tp") + F.col("_fp") + F.col("_fn"))
    return base.join(pairs, list(keys), "left").select(
        *keys,
        precision.alias("precision"),
        recall.alias("recall"),
        F.coalesce(f1, F.lit(0.0)).alias("f1"),
        "roc_auc",
        "brier_score",
        "positive_rate_test",
        "n_test",
    )
