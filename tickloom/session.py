"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


#: Of tables and cuts: ids and payloads take half of what they take with Spark's default.
CODEC = "zstd"


def pin_utc(spark: SparkSession) -> SparkSession:
    """All timestamps are UTC; bare ISO strings are read as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a session in one process may fall back to /tmp."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tickloom-"))
    return spark.sparkContext.getCheckpointDir()


_written: list[str] = []


@contextmanager
def cuts_removed(spark: SparkSession) -> Iterator[None]:
    """Deletes what ``cut`` writes inside the block, and folders given to ``removed_later``, at its end. Only for jobs whose results are written by then."""
    before = len(_written)
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in _written[before:]:
            where = hadoop.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        del _written[before:]


def removed_later(path: str) -> str:
    """A folder that ``cuts_removed`` deletes too."""
    _written.append(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: short lineage that outlives executors."""
    spark = df.sparkSession
    path = removed_later(f"{checkpoint_root(spark).rstrip('/')}/tickloom/{uuid.uuid4().hex}")
    df.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(module: str) -> None:
    """Send the functions and classes of a module to Python workers by value.

    Executors then need no copy of this package, wherever the driver found it.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])
