"""How queries are registered: a function of (spark, sf_dir) and, where SQL can say it, the DuckDB text of the same relation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Parquet tables of a folder by attribute: ``Tables(spark, dir).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def stream(self, name: str) -> DataFrame:
        """The same table as a stream of its files; as a pattern the path may be one file or a folder of parts."""
        schema = self._spark.read.parquet(f"{self._dir}/{name}.parquet").schema
        return self._spark.readStream.schema(schema).parquet(f"{self._dir}/{name}.parque[t]")

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")


def query(sql: str | None = None):
    """Registers a function of a ``Tables`` under its own name."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add
