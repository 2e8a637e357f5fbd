"""The event envelope every source is brought into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.constants import DOMAINS, ENVELOPE_COLUMNS
from tickloom.functions.canonical import event_id


def to_envelope(
    df: DataFrame,
    *,
    source: str,
    domain: str,
    token: Column,
    event_timestamp: Column,
    payload: Column,
    ingested: Column | None = None,
    schema_version: str = "1.0",
) -> DataFrame:
    if domain not in DOMAINS:
        raise ValueError(f"unknown domain {domain!r}")
    name = F.lit(source)
    columns = {
        "event_id": event_id(name, token, event_timestamp, payload),
        "source": name,
        "schema_version": F.lit(schema_version),
        "ingestion_timestamp": F.current_timestamp() if ingested is None else ingested,
        "event_timestamp": event_timestamp,
        "token_address": token,
        "domain": F.lit(domain),
        "payload": payload,
    }
    return df.select(*[columns[c].alias(c) for c in ENVELOPE_COLUMNS])
