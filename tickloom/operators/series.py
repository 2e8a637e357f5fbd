"""Ordered series per key, laid out so that no key has to fit in one task.

Most keys are short: one shuffle by key and one sort serve every window. A key with more rows
than ``max_rows`` (a *hot* key) is range-partitioned on its order instead, its rows get an exact
position, and positions are cut into segments of ``segment_rows``:

* frames that look a fixed number of rows back or ahead run per segment, after the few rows at
  each segment edge are copied next door (``bounded``); where they look over many segments, some
  neighbours are taken together, so that a row has few copies;
* running sums, products, maxima and last values run per segment and are then combined with the
  total of the segments before (``running``).

Both give the same values as one window over the whole key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.canonical import packed, unpacked
from tickloom.session import cut

MAX_ROWS = 4_000_000
SEGMENT_ROWS = 1_000_000
BROADCAST_SEGMENTS = 200_000
RANGE_PARTITIONS = 20_000
#: Rows of a range partition at least, where there are more of them than shuffle partitions.
RANGE_ROWS = 100_000
#: Segments that a chain of steps may look over before neighbours are taken together.
REACH_SEGMENTS = 4

_ID, _INDEX, _LAST, _SEGMENT, _HOME = "_row_id", "_row_index", "_last_index", "_segment", "_home_segment"


def same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Null-safe equality on all ``names``."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names], F.lit(True))


def group_sizes(df: DataFrame, keys: Sequence[str], max_rows: int, times: int = 1) -> tuple[int, list]:
    """Rows of the largest group, and the groups above ``max_rows``.

    Reads the key columns only. The list is bounded: it has fewer than rows / max_rows entries.
    """
    counted = df.groupBy(*keys).agg((F.count(F.lit(1)) * times).alias("_rows"))
    row = counted.agg(
        F.max("_rows").alias("longest"),
        F.collect_list(F.when(F.col("_rows") > max_rows, F.struct(*keys, "_rows"))).alias("hot"),
    ).first()
    return row["longest"] or 0, row["hot"]


def split_hot(df: DataFrame, keys: Sequence[str], hot: list) -> tuple[DataFrame, DataFrame]:
    """Rows of the other groups, and rows of the groups listed by ``group_sizes``."""
    if not keys:
        return df.where(F.lit(False)), df
    schema = df.select(*keys).schema
    names = df.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in hot], schema)
    names = F.broadcast(names)  # bounded, see group_sizes
    on = same(df, names, keys)
    return df.join(names, on, "left_anti"), df.join(names, on, "left_semi")


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], max_rows: int | None = None) -> DataFrame:
    """Left join to a table with one row per key, where ``left`` may hold hot keys.

    Hot keys meet a broadcast of just their own right-hand rows; all others join as Spark decides.
    """
    _, hot = group_sizes(left, keys, MAX_ROWS if max_rows is None else max_rows)
    if not hot:
        return left.join(right, list(keys), "left")
    cold_rows, hot_rows = split_hot(left, keys, hot)
    _, hot_right = split_hot(right, keys, hot)
    return cold_rows.join(right, list(keys), "left").unionByName(
        hot_rows.join(F.broadcast(hot_right), list(keys), "left")
    )


def dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a key in one partition."""
    return unpacked(packed(df).repartition(*keys))


def sort_columns(order: Sequence[str]) -> list[Column]:
    """Sort order from column names; a leading ``-`` means descending."""
    return [F.col(n[1:]).desc() if n.startswith("-") else F.col(n).asc() for n in order]


@dataclass(frozen=True)
class Running:
    """A running aggregate: ``kind`` is sum, product, max, or first / last (non-null)."""

    kind: str
    value: Column

    def over(self, frame: WindowSpec) -> Column:
        return _window_aggregate(self.kind, self.value).over(frame)


def _window_aggregate(kind: str, value: Column) -> Column:
    if kind in ("first", "last"):
        return (F.first if kind == "first" else F.last)(value, ignorenulls=True)
    return {"sum": F.sum, "product": F.product, "max": F.max}[kind](value)


def _combine(kind: str, carried: Column, local: Column) -> Column:
    if kind == "last":
        return F.coalesce(local, carried)
    if kind == "first":
        return F.coalesce(carried, local)
    if kind == "max":
        return F.greatest(carried, local)
    both = carried * local if kind == "product" else carried + local
    return F.coalesce(both, local, carried)


Step = Callable[[DataFrame, WindowSpec], DataFrame]


@dataclass(frozen=True)
class Series:
    """Rows per key in a total order; hot keys are held apart, by segment.

    Steps on the hot rows are collected and applied together, so that a chain of them costs one
    shuffle; ``before`` and ``after`` say how far the chain looks over a segment edge.
    """

    cold: DataFrame
    hot: DataFrame | None
    keys: tuple[str, ...]
    order: tuple[str, ...]
    segment_rows: int
    segments: int
    longest: int
    hot_sizes: tuple = ()
    steps: tuple[Step, ...] = ()
    before: int = 0
    after: int = 0

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*sort_columns(self.order))

    def _segment_window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, _SEGMENT).orderBy(*sort_columns(self.order))

    def rows(self, fn: Callable[[DataFrame], DataFrame]) -> Series:
        """Apply a step to each row by itself; it must keep all rows."""
        return self.bounded(lambda d, _: fn(d))

    def with_columns(self, columns: dict[str, Column]) -> Series:
        return self.rows(lambda df: df.withColumns(columns))

    def keep(self, *names: str) -> Series:
        """Keep the key, the order and ``names``. Worth saying before ``running``, which writes hot rows."""
        own = [*self.keys, *[n.removeprefix("-") for n in self.order]]
        wanted = list(dict.fromkeys([*own, *names]))
        inner = (_INDEX, _LAST, _SEGMENT, _HOME)
        return self.rows(lambda d: d.select(*wanted, *[c for c in inner if c in d.columns]))

    def bounded(self, fn: Step, before: int = 0, after: int = 0) -> Series:
        """Apply window steps that look at most ``before`` rows back and ``after`` rows ahead."""
        cold = fn(self.cold, self.window())
        if self.hot is None:
            return replace(self, cold=cold)
        return replace(
            self, cold=cold, steps=(*self.steps, fn), before=self.before + before, after=self.after + after
        )

    def _hot_rows(self) -> DataFrame:
        """The hot rows with all collected steps applied."""
        w = self._segment_window()
        if not self.before and not self.after:
            return reduce(lambda d, fn: fn(d, w), self.steps, self.hot)
        joined = self._joined_segments()
        index, size = F.col(_INDEX), F.lit(self.segment_rows * joined)
        first = F.greatest(F.lit(0), F.floor((index - self.after) / size))
        last = F.floor(F.least(index + self.before, F.col(_LAST)) / size)
        spread = self.hot.withColumn(_HOME, F.floor(index / size).cast("long")).withColumn(
            _SEGMENT, F.explode(F.sequence(first.cast("long"), last.cast("long")))
        )
        done = reduce(lambda d, fn: fn(d, w), self.steps, spread)
        own = done.where(F.col(_SEGMENT) == F.col(_HOME)).drop(_HOME)
        return own if joined == 1 else own.withColumn(_SEGMENT, F.floor(index / self.segment_rows).cast("long"))

    def _joined_segments(self) -> int:
        """How many neighbouring segments the collected steps run over together. No step looks further than the longest
        series, so short ones are still cut."""
        reach = min(self.before + self.after, self.longest)
        return max(1, -(-reach // (self.segment_rows * REACH_SEGMENTS)))

    def running(self, **aggregates: Running) -> Series:
        """Add running aggregates from the first row of the key to the current row.

        Hot rows: the aggregate within the segment comes with the collected steps and is written;
        the values at the ends of full segments then give what each later segment starts from.
        """
        up_to_here = (Window.unboundedPreceding, Window.currentRow)
        frame = self.window().rowsBetween(*up_to_here)
        cold = self.cold.withColumns({n: a.over(frame) for n, a in aggregates.items()})
        if self.hot is None:
            return replace(self, cold=cold)
        by = [*self.keys, _SEGMENT]
        local = self._segment_window().rowsBetween(*up_to_here)
        hot = cut(self._hot_rows().withColumns({n: a.over(local) for n, a in aggregates.items()}))
        carried = {n: f"_carried_{n}" for n in aggregates}
        so_far = Window.partitionBy(*self.keys).orderBy(_SEGMENT).rowsBetween(*up_to_here)
        of = {k: f"_of_{k}" for k in by}
        ends = (
            hot.where(F.col(_INDEX) % self.segment_rows == self.segment_rows - 1)
            .select(*by, *aggregates)
            .select(
                *[F.col(k).alias(of[k]) for k in self.keys],
                (F.col(_SEGMENT) + 1).alias(of[_SEGMENT]),
                *[_window_aggregate(a.kind, F.col(n)).over(so_far).alias(carried[n]) for n, a in aggregates.items()],
            )
        )
        if self.segments <= BROADCAST_SEGMENTS:
            ends = F.broadcast(ends)  # one row per segment, counted when the layout was made
        hot = (
            hot.join(ends, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(o)) for k, o in of.items()]), "left")
            .withColumns({n: _combine(a.kind, F.col(carried[n]), F.col(n)) for n, a in aggregates.items()})
            .drop(*carried.values(), *of.values())
        )
        return replace(self, cold=cold, hot=hot, steps=(), before=0, after=0)

    def index(self, name: str) -> Series:
        """Add the 1-based position of each row in its key."""

        def step(d: DataFrame, w: WindowSpec) -> DataFrame:
            position = F.col(_INDEX) + 1 if _INDEX in d.columns else F.row_number().over(w).cast("long")
            return d.withColumn(name, position)

        return self.bounded(step)

    def size(self, name: str) -> Series:
        """Add the number of rows of the key."""
        if self.hot is None:
            return replace(self, cold=self._with_size(self.cold, name))
        of = {k: f"_of_{k}" for k in self.keys}
        schema = self.hot.select(*[F.col(k).alias(o) for k, o in of.items()]).schema.add(name, "long")
        sizes = [(*(r[k] for k in self.keys), r["_rows"]) for r in self.hot_sizes]
        known = F.broadcast(self.hot.sparkSession.createDataFrame(sizes, schema))  # bounded, see group_sizes
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(o)) for k, o in of.items()], F.lit(True))

        def step(d: DataFrame, _: WindowSpec) -> DataFrame:
            return d.join(known, on, "left").drop(*of.values()) if _INDEX in d.columns else self._with_size(d, name)

        return self.bounded(step)

    def _with_size(self, df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*self.keys)))

    def frame(self) -> DataFrame:
        if self.hot is None:
            return self.cold
        return self.cold.unionByName(self._hot_rows().drop(_INDEX, _LAST, _SEGMENT))


def lay_out(
    df: DataFrame,
    keys: Sequence[str] = ("token_address",),
    order: Sequence[str] = ("event_timestamp", "event_id"),
    *,
    max_rows: int | None = None,
    segment_rows: int | None = None,
    counted: tuple[DataFrame, int] | None = None,
    deal: bool = False,
    arrived: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Series:
    """Lay ``df`` out as series. ``order`` must be total within a key; rows with a null key are a series like any other.

    ``max_rows`` decides on the plan alone: a series gives the same values whether it is hot or not. ``deal`` is for rows
    that are not dealt by key yet, as those of a table: they are, with their ids packed on the way. ``arrived`` makes of the
    rows, once dealt, those to be laid out, with the same key.
    """
    max_rows = MAX_ROWS if max_rows is None else max_rows
    segment_rows = SEGMENT_ROWS if segment_rows is None else segment_rows
    keys, order = tuple(keys), tuple(order)
    source, times = counted or (arrived(df), 1)  # a smaller table whose keys have 1 / times of the rows
    longest, hot = group_sizes(source, keys, max_rows, times)
    if not hot:
        return Series(arrived(dealt(df, keys) if deal else df), None, keys, order, segment_rows, 0, longest)
    cold_rows, hot_rows = split_hot(df, keys, hot)
    cold_rows, hot_rows = arrived(dealt(cold_rows, keys) if deal else cold_rows), arrived(hot_rows)
    segments = sum(-(-r["_rows"] // segment_rows) for r in hot)
    even = -(-sum(r["_rows"] for r in hot) // RANGE_ROWS)
    ranges = max(even, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = cut(
        hot_rows.repartitionByRange(min(segments, ranges, RANGE_PARTITIONS), *keys, *sort_columns(order))
        .sortWithinPartitions(*keys, *sort_columns(order))
        .withColumn(_ID, F.monotonically_increasing_id())
    )
    part, at = F.shiftright(_ID, 33), F.col(_ID).bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumns({"_part": part, "_at": at}).drop(_ID)
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = (
        placed.groupBy(*keys, "_part")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first"))
        .withColumn(_LAST, F.sum("_rows").over(whole) - 1)
        .drop("_rows", "_first")
    )
    starts = F.broadcast(starts)  # at most one row per range partition and hot key
    indexed = (
        placed.alias("p")
        .join(starts.alias("s"), _same_place(keys))
        .select("p.*", (F.col("p._at") + F.col("s._offset")).alias(_INDEX), f"s.{_LAST}")
        .drop("_part", "_at")
        .withColumn(_SEGMENT, F.floor(F.col(_INDEX) / segment_rows).cast("long"))
    )
    return Series(cold_rows, indexed, keys, order, segment_rows, segments, longest, tuple(hot))


def _same_place(keys: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b,
        [F.col(f"p.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys],
        F.col("p._part") == F.col("s._part"),
    )
