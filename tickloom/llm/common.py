"""What the operators of this folder share: tables, stored stages and slices of Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import checkpoint_root, ship

ship(__name__)

#: Bytes of text that a Python worker handles at once; one longer text is handled alone.
SLICE_BYTES = 4_000_000
#: Ids that are broadcast, 8 bytes each.
BROADCAST_IDS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, what: str) -> str:
    """A new folder that driver and executors share."""
    return f"{checkpoint_root(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


_working: list[str] = []


@contextmanager
def working_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes what ``stored`` and ``shared_path`` made inside the block, at its end; what is needed later must be
    written outside it, or kept with ``keep``."""
    before = len(_working)
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in _working[before:]:
            where = hadoop.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        del _working[before:]


def keep(table: DataFrame) -> DataFrame:
    """Leaves the stored table to whoever reads it, beyond the block of ``working_tables``."""
    for file in table.inputFiles()[:1]:
        for path in [p for p in _working if f"{p.rstrip('/').rsplit('/', 1)[-1]}/" in file]:
            _working.remove(path)
    return table


def with_ids(rows: DataFrame, ids: DataFrame, kind: str = "left_semi", on: str = "doc_id") -> DataFrame:
    """Rows whose id is (``left_semi``) or isn't (``left_anti``) among ``ids``, which are counted first: so many that fit
    are broadcast and no row of ``rows`` moves; beyond that both sides are shuffled by id."""
    few = ids.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, on, kind)


def stored(df: DataFrame, what: str, codec: str = "zstd") -> DataFrame:
    """``df`` written to a shared folder and read back: computed once, and safe from lost executors."""
    path = shared_path(df.sparkSession, what)
    _working.append(path)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Memory that this Python worker has freed goes back to the system; its next task may be another operator's."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):  # the second also trims what numpy and Python freed
        pool.release_unused()


def text_slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds at most ``most`` bytes of the column ``text``, or one row; freed memory goes back
    to the system after each batch."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        give_back()
