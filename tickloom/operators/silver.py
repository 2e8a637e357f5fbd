"""Bronze market events to typed rows, each marked valid or with the reasons it is not."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.canonical import packed, unpacked

PAYLOAD = "o string, h string, l string, c string, v string, vUsd string, currency string"
PRICES = ("open", "high", "low", "close")


def dedup(envelopes: DataFrame) -> DataFrame:
    """One row per event id, the first ingested. Copies are thinned before the shuffle, so a much
    repeated event costs one row per input task."""
    order = ("ingestion_timestamp", "source", "event_timestamp", "token_address", "payload")
    w = Window.partitionBy("event_id").orderBy(*order)
    numbered = packed(envelopes).withColumn("_copy", F.row_number().over(w))
    return unpacked(numbered.where(F.col("_copy") == 1).drop("_copy"))


def flatten(envelopes: DataFrame) -> DataFrame:
    """Typed candle columns from the payload. Text that is no number becomes null, bad JSON all nulls."""
    # Exploding the one parsed object keeps it parsed once: no filter on its fields is pushed below the parser.
    p = F.explode(F.array(F.from_json("payload", PAYLOAD)))
    names = {"open": "o", "high": "h", "low": "l", "close": "c", "volume": "v", "volume_usd": "vUsd"}
    head = ("event_id", "source", "schema_version", "ingestion_timestamp")
    return envelopes.withColumn("_p", p).select(
        *head,
        F.col("event_timestamp").cast("timestamp").alias("event_timestamp"),
        "token_address",
        "domain",
        *[F.col(f"_p.{short}").try_cast("double").alias(name) for name, short in names.items()],
        F.col("_p.currency").alias("currency"),
        F.to_date("event_timestamp").alias("event_date"),
    )


def problems() -> Column:
    """Reasons to quarantine a flattened row; empty for a valid one. NaN counts as missing."""

    def bad(name: str, sound: Column) -> Column:
        value = F.col(name)
        return F.when(value.isNull() | F.isnan(value), f"{name}_missing").when(~sound, f"{name}_out_of_range")

    return F.array_compact(
        F.array(
            F.when(F.col("token_address").isNull(), "token_missing"),
            F.when(F.col("event_timestamp").isNull(), "time_missing"),
            *[bad(n, F.col(n) > 0) for n in PRICES],
            bad("volume", F.col("volume") >= 0),
        )
    )


def sound() -> Column:
    """Whether a flattened row is valid: plain comparisons, so that the reasons are made for the others alone."""

    def good(name: str, test: Column) -> Column:
        return F.coalesce(test & ~F.isnan(name), F.lit(False))

    tests = [F.col("token_address").isNotNull(), F.col("event_timestamp").isNotNull()]
    tests += [good(n, F.col(n) > 0) for n in PRICES] + [good("volume", F.col("volume") >= 0)]
    return reduce(lambda a, b: a & b, tests)


def mark(envelopes: DataFrame) -> DataFrame:
    """Deduplicated, flattened rows with ``quarantine_reasons`` and ``is_valid`` (never null)."""
    return judged(dedup(envelopes))


def judged(envelopes: DataFrame) -> DataFrame:
    """``mark`` for envelopes that have no copies."""
    rows = flatten(envelopes).withColumn("is_valid", sound())
    return rows.withColumn("quarantine_reasons", F.when(F.col("is_valid"), F.array().cast("array<string>")).otherwise(problems()))


def split(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined): together exactly the marked rows."""
    valid = marked.where("is_valid").drop("is_valid", "quarantine_reasons")
    return valid, marked.where("not is_valid").drop("is_valid")
