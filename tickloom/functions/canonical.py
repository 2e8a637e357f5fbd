"""Canonical JSON and deterministic event ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING = "\u0000"


def canonical_json(payload: Column) -> Column:
    """Same text for the same JSON value: keys sorted at every level. Text that is not JSON stays as it is."""
    return F.coalesce(F.to_json(F.try_parse_json(payload)), payload)


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def event_id(source: Column, token: Column, event_timestamp: Column, payload: Column) -> Column:
    """sha256 over source, token, time and the sha256 of the canonical payload."""
    parts = (source, token, iso_utc(event_timestamp), F.sha2(canonical_json(payload), 256))
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit(MISSING)) for p in parts]), 256)


def is_digest(event_id: Column) -> Column:
    return event_id.rlike(r"\A[0-9a-f]{64}\z")


def packed_id(event_id: Column) -> Column:
    """An id as bytes: 64 hex digits, which no shuffle can compress, take 32; another text gets a byte more from 32 bytes on.
    Equal ids, and only they, have equal bytes. Digests keep their order, but not beside other ids."""
    text = event_id.cast("binary")
    other = F.when(F.length(text) < 32, text).otherwise(F.concat(text, F.lit(b"\x00")))
    return F.when(is_digest(event_id), F.unhex(event_id)).otherwise(other)


def unpacked_id(packed: Column) -> Column:
    """The id of ``packed_id``."""
    size = F.length(packed)
    text = F.when(size < 32, packed).otherwise(F.substring(packed, F.lit(1), size - 1)).cast("string")
    return F.when(size == 32, F.lower(F.hex(packed))).otherwise(text)


def packed(df: DataFrame, name: str = "event_id") -> DataFrame:
    """Rows as they travel through a shuffle, their ids packed; without such a column, or with other ids than text, as they are."""
    return df.withColumn(name, packed_id(F.col(name))) if dict(df.dtypes).get(name) == "string" else df


def unpacked(df: DataFrame, name: str = "event_id") -> DataFrame:
    """Rows of ``packed`` behind the shuffle."""
    return df.withColumn(name, unpacked_id(F.col(name))) if dict(df.dtypes).get(name) == "binary" else df


def drop_empty_objects(payload: Column) -> Column:
    """Top-level fields holding an empty object become null; other fields keep their value."""
    fields = F.try_parse_json(payload).cast("map<string,variant>")
    kept = F.transform_values(fields, lambda _, v: F.when(F.coalesce(F.to_json(v), F.lit("")) != "{}", v))
    return F.coalesce(F.to_json(kept), payload)
