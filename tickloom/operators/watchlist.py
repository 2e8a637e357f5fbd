"""Ranked watchlist and its flat record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.constants import SEVERITY_ORDER
from tickloom.functions.rules import report_severity
from tickloom.operators.series import lay_out
from tickloom.session import cut

GLOBAL_RANK_ROWS = 100_000


def with_severity(decisions: DataFrame) -> DataFrame:
    severity = report_severity(F.col("action"), F.col("confidence"), F.col("override_triggered"))
    return decisions.withColumn("severity", severity)


def rank(decisions: DataFrame, max_rows: int = GLOBAL_RANK_ROWS, **layout) -> DataFrame:
    """Add ``severity`` and ``rank``: by severity, then confidence (highest first), then token.

    The decisions are written once, then counted: a short list is numbered in one task, a long one
    by a range-partitioned sort.
    """
    place = F.array_position(F.array(*[F.lit(s) for s in SEVERITY_ORDER]), F.col("severity"))
    rows = cut(with_severity(decisions).withColumn("_place", place))
    return lay_out(rows, (), ("_place", "-confidence", "token_address"), max_rows=max_rows, **layout).index("rank").frame().drop("_place")


def flat_record(ranked: DataFrame, scan_time: Column) -> DataFrame:
    return ranked.select(
        scan_time.alias("scan_timestamp"),
        "token_address",
        "severity",
        "action",
        "confidence",
        "override_triggered",
        "would_emergency_exit_if_held",
        F.array_join("reasons", "; ").alias("reasons"),
        F.array_join("risks", "; ").alias("risks"),
    )
