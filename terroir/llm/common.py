"""What the operators of this subpackage share: reading tables, cutting lineage, walking Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one slice of an Arrow batch holds before Python works on it.
SLICE_BYTES = 2 << 20
#: Bytes of an Arrow batch between the JVM and Python; Spark's own default is eight times that.
BATCH_BYTES = "8m"
#: Rows of a settled table, where their number is bounded beforehand, that one task writes to one file.
FILE_ROWS = 1 << 18
#: Whether Spark deletes a query's shuffle files when it ends; else they stay until the driver collects its garbage.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables; the session's Arrow batches are kept small, so that long texts don't pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; one of our own only where that is unset (tests)."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="terroir-checkpoint-")
        context.setCheckpointDir(named)
    return named.rstrip("/")


#: Folders of the tables that this process has settled, oldest first.
_SETTLED: list[tuple[SparkSession, str]] = []


def settle(df: DataFrame, most: int | None = None, tidy: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a read of that table, never the work that made it. Types must be
    known, so a ``void`` column is refused by the writer. Where ``df`` is known to have ``most`` rows at most, it is
    written by a task for each ``FILE_ROWS`` of them, not by one for each shuffle partition, which may be all but empty.
    With ``tidy`` the shuffles that made it are deleted at once.
    """
    spark = df.sparkSession
    if most is not None:
        df = df.coalesce(most // FILE_ROWS + 1)
    path = f"{shared_folder(spark)}/settled-{uuid.uuid4().hex}"
    before = spark.conf.get(TIDY, None)
    try:
        if tidy:
            spark.conf.set(TIDY, "true")
        df.write.parquet(path)
    finally:
        if tidy:
            spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)
    _SETTLED.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def alone(make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` gives, settled; every other table that it has settled on the way is deleted."""
    before = len(_SETTLED)
    out = settle(make())
    for spark, path in _SETTLED[before:-1]:
        _delete(spark, path)
    del _SETTLED[before:-1]
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(df: DataFrame) -> None:
    """Delete the files of a settled table that nothing will read again."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles() if "/settled-" in f}:
        _delete(spark, name)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` (text) holds about ``most`` bytes in each; a longer single row stays whole.

    When a task's input ends, the worker gives back the memory it no longer uses, since it lives on for other tasks.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)
    give_back()


def give_back() -> None:
    """Return freed memory to the system: Arrow's pool, and the C library's heap where it can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """The UTF-8 bytes of each text, without decoding."""
    return pc.cast(batch.column(column), pa.binary()).to_pylist()


def binaries(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """One binary for each run of rows of ``values`` between two ``edges``."""
    data = np.ascontiguousarray(values)
    width = data.nbytes // len(data) if len(data) else 1
    ends = pa.py_buffer((edges * width).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, ends, pa.py_buffer(data.tobytes())])


def numbers(column: pa.ChunkedArray, dtype: np.dtype) -> np.ndarray:
    """The numbers that all binaries of a column hold, one after the other."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def small(df: DataFrame, row_bytes: int, limit: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows times ``row_bytes`` stay within ``limit``, else as it is.

    Pass a settled table: its count reads file footers only.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df
