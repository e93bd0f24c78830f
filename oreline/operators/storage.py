"""Written intermediate tables: they cut the lineage and fix once what could come out otherwise a second time."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []
_LEFT: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset and all runs in one process, a temporary one."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="oreline-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return f"file://{_OWN[0]}"


def place(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver ends unless ``drop`` did before."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _LEFT:
        atexit.register(_sweep)
    _LEFT[path] = spark
    return path


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _sweep() -> None:
    """At the driver's end: tables that results were read from."""
    for path, spark in list(_LEFT.items()):
        try:
            _delete(spark, path)
        except Exception:  # the session is gone already
            return


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = place(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def dealt(rows: DataFrame, key: str, rows_a_task: int) -> DataFrame:
    """``rows`` dealt by ``key`` to tasks of about ``rows_a_task``, and to all cores: for long work on short rows, which come in few files."""
    spark = rows.sparkSession
    return rows.repartition(max(spark.sparkContext.defaultParallelism, -(-rows.count() // rows_a_task)), key)


def drop(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` wrote and that no later plan reads."""
    for df in tables:
        if path := getattr(df, "_written_to", None):
            _LEFT.pop(path, None)
            _delete(df.sparkSession, path)
