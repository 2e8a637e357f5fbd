"""News classification by ordered keyword lists, source credibility, and URL domains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.constants import CREDIBLE_DOMAINS, NEWS_KEYWORDS


def credibility(domain: Column) -> Column:
    bare = F.regexp_replace(F.lower(domain), r"^www\.", "")
    return F.when(bare.isin(*CREDIBLE_DOMAINS), "HIGH").otherwise("UNKNOWN")


def url_domain(url: Column) -> Column:
    """Authority of a URL (with its port), without one leading ``www.``; empty when there is none."""
    authority = F.coalesce(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit(""))
    return F.regexp_replace(authority, r"^www\.", "")


def mentions(topic: Column, *texts: Column) -> Column:
    """Case-insensitive substring match over the texts joined by a space."""
    return F.contains(F.lower(_joined(*texts)), F.lower(topic))


def _joined(*texts: Column) -> Column:
    return F.concat_ws(" ", *[F.coalesce(t, F.lit("")) for t in texts])


def _classified(text: Column) -> Column:
    """(event_type, matched_keywords) of a lower-case text; lists are tried in order, the first match wins."""
    chain = F.when(F.lit(False), F.lit(None))
    for name, words in NEWS_KEYWORDS:
        found = [F.contains(text, F.lit(w)) for w in words]
        matched = F.array_compact(F.array(*[F.when(hit, F.lit(w)) for hit, w in zip(found, words, strict=True)]))
        row = F.struct(F.lit(name).alias("event_type"), matched.alias("matched_keywords"))
        chain = chain.when(reduce(lambda a, b: a | b, found), row)
    nothing = F.array().cast("array<string>").alias("matched_keywords")
    return chain.otherwise(F.struct(F.lit("other").alias("event_type"), nothing))


def classify(df: DataFrame, title: str = "title", domain: str = "domain", description: str | None = None) -> DataFrame:
    """Add ``event_type``, ``matched_keywords`` and ``credibility``.

    The text is title, a space, then the description, so a keyword that ends in a space matches at
    the end of a title. It enters the rules as the single element of an array: it is then built and
    lowered once per row, wherever the optimizer moves the expression.
    """
    text = F.lower(_joined(F.col(title), F.col(description) if description else F.lit("")))
    return (
        df.withColumn("_class", F.transform(F.array(text), _classified)[0])
        .withColumns(
            {
                "event_type": F.col("_class.event_type"),
                "matched_keywords": F.col("_class.matched_keywords"),
                "credibility": credibility(F.col(domain)),
            }
        )
        .drop("_class")
    )
