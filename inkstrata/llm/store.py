"""Shared-folder helpers: written tables that cut lineage, and size-checked broadcasts."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Only for local sessions that name no shared folder, such as tests.
LOCAL_FALLBACK = "file:///tmp/checkpoints/inkstrata"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; a cluster must name one."""
    set_to = spark.conf.get("spark.checkpoint.dir", None)
    if not set_to:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        set_to = LOCAL_FALLBACK
    return set_to.rstrip("/")


class _Stage(threading.local):
    tables: list[str] = []  # of the pipeline stage that this thread ran last
    open = False


_stage = _Stage()


@contextmanager
def stage_tables(spark: SparkSession) -> Iterator[None]:
    """Tables written inside go when this thread next enters: a pipeline's stage reads them until its own result is
    written, which is before the next stage begins."""
    for path in _stage.tables:
        _delete(spark, path)
    _stage.tables, _stage.open = [], True
    try:
        yield
    finally:
        _stage.open = False


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; removed when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/inkstrata/{name}-{uuid.uuid4().hex}"
    if _stage.open:
        _stage.tables.append(path)
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table written to the shared folder and read back: its rows are computed
    once, survive lost executors, and later readers prune its columns."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Remove the files of a table made by written() that nothing reads any more."""
    spark = df.sparkSession
    for f in {x.rpartition("/")[0] for x in df.inputFiles()}:
        _delete(spark, f)


def bounded_batches(spark: SparkSession, most: str = "4m") -> None:
    """From now on the session's Arrow batches end at most bytes, unless it was given a bound of its own: a batch of 10,000 texts
    is held several times over, by the JVM and by its worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, most)


def small(df: DataFrame, most_rows: int, width: Column | None = None, most_bytes: int = 64_000_000) -> DataFrame:
    """df with a broadcast hint if it has at most most_rows rows, and by width, the bytes of a row's own strings and arrays, at most
    most_bytes; else as it is, and the join shuffles. df should be cheap to count, such as a written table."""
    n, held = df.agg(F.count(F.lit(1)), F.sum(width if width is not None else F.lit(0))).first()
    return F.broadcast(df) if n <= most_rows and (held or 0) <= most_bytes else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
