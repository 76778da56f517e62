"""Shared folders and Arrow helpers of the text operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
#: Rows with a few numbers each that a task sends back at once.
SENT_ROWS = 1 << 16
#: Of rows with a few numbers each.
BROADCAST_ROWS = 1_000_000
#: Spark's own setting: shuffle files go when the query that wrote them ends, not when the driver next collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a new one on a single machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it: lineage ends here, and a lost executor loses nothing.

    The shuffle files of the write are not needed again and are removed with it.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(SHUFFLE_CLEANUP) if before is None else conf.set(SHUFFLE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that `saved` wrote, once everything that reads them is written itself."""
    for df in tables:
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            files, path = fs.FileSystem.from_uri(folder)
            files.delete_dir(path)


def fresh(names: list[str], taken: list[str]) -> tuple[str, ...]:
    """The names, with underscores in front until none is taken (column names do not differ by case)."""
    known = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in known:
            name = f"_{name}"
        known.add(name.lower())
        out.append(name)
    return tuple(out)


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A table that is already written may be broadcast if it has few rows; a larger one is joined by sorting."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 2 << 20) -> None:
    """Texts are long: send fewer rows and bytes at a time to Python workers than Spark's defaults, as a batch lies in memory on both sides."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(size))
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


#: What modules keep in a Python worker from task to task: functions that drop it.
_KEPT: dict[str, Callable[[], None]] = {}


def keeps(owner: str, drop: Callable[[], None]) -> None:
    """Something that tasks of `owner` find again in their worker, and that tasks of others drop."""
    _KEPT[owner] = drop


def drop_others(owner: str) -> None:
    for name, drop in _KEPT.items():
        if name != owner:
            drop()


def give_back() -> None:
    """Return freed memory to the system: Arrow's pool and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def lean(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], owner: str = "") -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run` for mapInArrow. Spark keeps a task's worker for later tasks, and it lies beside the executor's heap while none
    needs it; so it holds no freed memory, and nothing that other operators keep."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_others(owner)
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def pieces(batch: pa.RecordBatch, rows: int = SENT_ROWS) -> Iterator[pa.RecordBatch]:
    """A batch in parts, as each lies in memory on both sides when it is sent."""
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows first..last of a batch with their UTF-8 bytes and offsets, about `limit` bytes at a time; null is empty."""
    texts = batch.column(column).cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, len(texts))
        yield first, last, every[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last
