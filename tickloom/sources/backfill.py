"""Request work-list for history backfills."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.constants import CANDLES_PER_REQUEST, INTERVAL_SECONDS


def request_chunks(spans: DataFrame, interval: str = "1H", per_request: int = CANDLES_PER_REQUEST) -> DataFrame:
    """Cut each (token_address, start, end) span, end exclusive, into requests below the page cap."""
    if interval not in INTERVAL_SECONDS:
        raise ValueError(f"unsupported interval {interval!r}, expected one of {sorted(INTERVAL_SECONDS)}")
    step = INTERVAL_SECONDS[interval] * per_request
    start, end = F.unix_timestamp("start"), F.unix_timestamp("end")
    chunks = F.sequence(F.lit(0), F.floor((end - start - 1) / step).cast("long"))
    return (
        spans.where(F.col("start") < F.col("end"))
        .withColumns({"_from": start, "_to": end})
        .withColumn("chunk", F.explode(chunks))
        .select(
            "token_address",
            F.lit(interval).alias("interval"),
            "chunk",
            (F.col("_from") + F.col("chunk") * step).alias("time_from"),
            F.least(F.col("_from") + (F.col("chunk") + 1) * step, F.col("_to")).alias("time_to"),
        )
    )
