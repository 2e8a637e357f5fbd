"""Jobs that go on from where they stood: a run reads the days it is asked for and what earlier days left behind.

Each gives what the job of the same name in ``jobs`` gives over all days. A run over days that were done before replaces
them and does the days after them again, since those look back on them.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import backtest as bt
from tickloom.operators import features as ft
from tickloom.operators import labels as lb
from tickloom.operators.series import lay_out
from tickloom.session import cut, cuts_removed
from tickloom.sources import tables, versions

#: Days whose tails are kept, so that a run can begin again after one of them.
KEPT_TAILS = 14


def tail_days(spark: SparkSession, tails_path: str) -> list[date]:
    """Days after which tails are there, oldest first."""
    version = versions.current(spark, tails_path)
    if version and '"closes"' not in version.schema:
        raise ValueError(f"{tails_path} has tails of an older layout: take another folder and begin at the first day")
    found = {f.partition["as_of"] for f in version.files} if version else set()
    return sorted(date.fromisoformat(d) for d in found)


def _days(first: date, last: date) -> list[str]:
    return [str(first + timedelta(days=i)) for i in range((last - first).days + 1)]


def features(
    spark: SparkSession, silver_path: str, gold_path: str, tails_path: str, first: date, last: date, kept: int = KEPT_TAILS
) -> dict[str, object]:
    """Gold of the days ``first`` to ``last`` from silver of those days and the tails of the series before them.

    Begins after the newest tails before ``first``, so no day between is left out (with none, at the beginning), and goes
    on to the newest day done before. ``first``, ``last`` and ``rows`` of what was done are returned; ``first`` is None
    for the beginning. Tails take one row with ``TAIL_ROWS`` closes a series and kept day.
    """
    known = tail_days(spark, tails_path)
    before = [d for d in known if d < first]
    last = max([last, *known])
    begin = before[-1] + timedelta(days=1) if before else None
    silver = tables.read_silver(spark, silver_path, keep=tables.within("event_date", begin, last))
    with cuts_removed(spark):
        if before:
            as_of = str(before[-1])
            tails = versions.read(spark, tails_path, keep=lambda p: p["as_of"] == as_of).drop("as_of")
            gold = ft.features_after(silver, tails, deal=True)
        else:
            tails, gold = None, ft.token_features(silver, deal=True)
        seen = Observation()
        gold = gold.observe(seen, F.count(F.lit(1)).alias("rows"))
        only = ("event_date", _days(begin, last)) if begin else None
        done = tables.write_partitioned(gold, gold_path, ["event_date"], sort_by=["token_address", "event_timestamp"], only=only)
        # The tails come from the rows as written, by that version.
        days = set(only[1]) if only else None
        written = versions.read(spark, gold_path, version=done, keep=lambda p: days is None or p["event_date"] in days)
        ends = ft.series_tails(written, tails)
        gone = [str(d) for d in known if d >= first] + [str(d) for d in before[: -(kept - 1)] if kept > 1]
        # One partition, dealt by series already.
        versions.overwrite(ft.packed_tails(ends).withColumn("as_of", F.lit(str(last))), tails_path, ["as_of"], ("as_of", sorted({str(last), *gone})))
    return {"first": begin, "last": last, "rows": seen.get["rows"]}


def backtest(
    spark: SparkSession,
    gold_path: str,
    parts_path: str,
    first: date | None,
    last: date,
    oversold: float = 30.0,
    overbought: float = 70.0,
    fee_bps: float = 10.0,
) -> DataFrame:
    """Summaries of the days ``first`` (None: the beginning) to ``last``, then the metrics of every token from the
    summaries of all days. Only rows of the given days are read; parameters must be those of the other days."""
    gold = tables.read_gold(spark, gold_path, keep=tables.within("event_date", first, last))
    parts = bt.summarise(gold, "event_date", oversold, overbought, fee_bps)
    if first is not None:
        only = ("event_date", _days(first, last))
    else:
        version = versions.current(spark, parts_path)
        done = {f.partition["event_date"] for f in version.files} if version else set()
        only = ("event_date", sorted(d for d in done if d <= str(last)))
    tables.write_partitioned(parts, parts_path, ["event_date"], sort_by=["token_address"], only=only)
    return metrics(spark, parts_path)


def metrics(spark: SparkSession, parts_path: str) -> DataFrame:
    return bt.fold(tables.read_table(spark, parts_path))


def labels(spark: SparkSession, gold_path: str, labels_path: str, open_path: str, first: date, last: date) -> dict[str, int]:
    """Entry and exit labels of the days ``first`` to ``last``, which follow those done before.

    A label looks ahead, so the last rows of a series stay open: they wait in ``open_path`` until later days close
    them. A row goes to ``labels_path`` once, when its labels are final. What is read is these days and the open rows. A run
    that is repeated after a failure changes nothing that was written; days once done are refused, since their labels are final.
    """
    done = {p: versions.current(spark, p) for p in (labels_path, open_path)}
    through = {p: v.notes.get("through", "") if v else "" for p, v in done.items()}
    if through[open_path] == str(last):
        return {"final": 0, "open": tables.read_table(spark, open_path).count()}
    if str(first) <= through[open_path]:
        raise ValueError(f"labels are final up to {through[open_path]}")
    gold = tables.read_gold(spark, gold_path, keep=tables.within("event_date", first, last))
    if done[open_path]:
        gold = gold.unionByName(tables.read_table(spark, open_path))
    with cuts_removed(spark):
        rows = lb.with_exit_label(lb.with_entry_label(lay_out(gold, deal=True))).frame()
        # The entry label looks further ahead, so a row with it has both.
        closed, note = F.col("label").isNotNull(), ("through", str(last))
        if through[labels_path] == str(last):  # a run that broke off between its two writes
            rows = cut(rows)
            final, waiting = rows.where(closed).count(), rows.where(~closed)
        else:
            final, waiting = tables.append_closed(rows, closed, labels_path, ["event_date"], ["token_address", "event_timestamp"], note)
        versions.overwrite(waiting.drop("label", "exit_label"), open_path, note=note)
        return {"final": final, "open": tables.read_table(spark, open_path).count()}
