"""Shared helpers: work folders on shared storage, file access, Arrow text buffers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Texts are handed to vectorised kernels in slices of about this many bytes, so a
#: worker's temporary arrays stay small whatever the Arrow batch holds.
SLICE_BYTES = 2 << 20


def work_dir(spark: SparkSession, tag: str) -> str:
    """A new folder on the storage that all executors share.

    The cluster names that storage in ``spark.checkpoint.dir``. Only where it is
    unset and all executors are threads of this process (master ``local``: tests, a
    single machine) a local folder is made and used instead; elsewhere RuntimeError.
    The folder is deleted when the session ends.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir is unset, and executors of {master} share no local folder")
        base = "file://" + tempfile.mkdtemp(prefix="chronogrid-")
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    path = fs.makeQualified(hadoop_path).toString()
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return path


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings (``__`` for a dot) that hold inside the block; before and after it the caller's do."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def bounded(df: DataFrame, rows: int = 512) -> DataFrame:
    """The same rows in a session of their own, in which an Arrow batch carries at most ``rows`` of them to a Python worker.

    For frames of whole texts that go back to the caller unwritten: how many rows a batch
    has is decided when a frame is planned, by the settings of its session. The caller's
    session keeps its own.
    """
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if 0 < int(spark.conf.get(key)) <= rows:
        return df
    own = spark._jsparkSession.cloneSession()
    own.conf().set(key, str(rows))
    plan = df._jdf.queryExecution().analyzed()
    context = spark.sparkContext
    return DataFrame(context._jvm.org.apache.spark.sql.classic.Dataset.ofRows(own, plan), SparkSession(context, own))


def saved(df: DataFrame, tag: str, rows: int = 512) -> DataFrame:
    """``df`` written to shared storage and read again: cuts lineage, survives lost executors.

    While it is written, an Arrow batch carries at most ``rows`` rows to a Python worker,
    and shuffle files are freed when the table is there. The session's settings are as
    before afterwards; frames that are returned unwritten go by them.
    """
    spark = df.sparkSession
    path, batch = work_dir(spark, tag), int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    batch = rows if batch <= 0 else min(batch, rows)
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true", spark__sql__execution__arrow__maxRecordsPerBatch=str(batch)):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_fs(uri: str):
    """(pyarrow filesystem, path) of a folder on shared storage, for use inside tasks."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of a string column; null counts as empty.

    ``offsets`` has one more entry than the run has rows and starts at 0.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    large = column.cast(pa.large_string())
    n = len(large)
    offsets = np.frombuffer(large.buffers()[1], dtype=np.int64)[large.offset : large.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(large.buffers()[2], dtype=np.uint8) if n and large.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of unsigned 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
