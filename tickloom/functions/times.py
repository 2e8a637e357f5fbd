"""Time parsing. Text without an offset is UTC (the session time zone is pinned)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unix_seconds(value: Column) -> Column:
    return F.timestamp_seconds(value)


def iso_time(text: Column) -> Column:
    """ISO-8601 with ``Z``, an offset or neither; anything else is null."""
    return F.try_to_timestamp(text)


def feed_time(text: Column) -> Column:
    """RFC-822 date of a feed item, with a zone name or a numeric offset; anything else is null."""
    clean = F.trim(F.regexp_replace(text, r"^\s*[A-Za-z]{3},\s*", ""))
    return F.coalesce(
        F.try_to_timestamp(clean, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(clean, F.lit("d MMM yyyy HH:mm:ss Z")),
    )
