"""What the operators share: the shared work folder, written intermediate tables, bounded Arrow batches, a worker's memory."""

from __future__ import annotations

import atexit
import ctypes
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []
_LEFT: dict[str, DataFrame] = {}
_HELD: dict[tuple, Any] = {}


def of_worker(key: tuple, make: Callable[[], Any]) -> Any:
    """The one object that a Python worker keeps from task to task: a model with its memory of words.

    Asking for another one frees it first, so a worker that serves several operators holds the memory of one of them."""
    if key not in _HELD:
        if _HELD:
            _HELD.clear()
            release()
        _HELD[key] = make()
    return _HELD[key]


def release() -> None:
    """Gives freed memory back to the system, where the C library can: a worker lives on for other tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only where the setting is absent and driver and executors are one process (tests) a temporary folder takes its place."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="oreline-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return f"file://{_OWN[0]}"


def _sweep() -> None:
    """At the driver's end: tables that results were read from, which no operator could delete."""
    for df in list(_LEFT.values()):
        try:
            discard(df)
        except Exception:  # the session is gone already
            return


def materialize(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: later stages start from files, not from lineage.

    Lost executors then cost only the tasks that they ran, and indeterminate parts of a plan are fixed once.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._oreline_path = path
    if not _LEFT:
        atexit.register(_sweep)
    _LEFT[path] = out
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``materialize`` wrote and that no later plan reads."""
    for df in tables:
        if path := getattr(df, "_oreline_path", None):
            jvm = df.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            _LEFT.pop(path, None)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_text(batches: Iterator[pa.RecordBatch], row: str, field: str) -> Iterator[pa.RecordBatch]:
    """Batches with a further column ``text`` that is a field of their struct column ``row``: the text crosses to Python once."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pc.struct_field(batch[row], field)], [*batch.schema.names, "text"])


def blocks(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts record batches into runs of rows whose ``column`` (strings or binaries) holds about ``most`` bytes at the most.

    A row is never split: a single longer value makes a batch of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)
