"""Sources and sinks: tolerant scans whose defects are a relation of their own, and sinks that refuse to do harm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, comment: str = "#", name_filter: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, defects) of CSV files with a header, skipping lines that start with ``comment``.

    Rows carry ``_src``, their file's name. Lines that don't fit the schema are no rows but defects (_src, line). A blank is null,
    never 0. Every column is named in the schema, so a scan reads only what a query asks for."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(full).option("header", True).option("comment", comment).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", True).option("nullValue", "")
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return _split(reader.csv(path).withColumn("_src", F.col("_metadata.file_name")), schema[0].name)


def _split(rows: DataFrame, first: str) -> tuple[DataFrame, DataFrame]:
    """Rows and defects. A scan of the corrupt column alone is refused by Spark, so both tests also read the first column."""
    read = F.length(F.concat_ws("", F.col(first).cast("string"))) >= 0  # always true
    bad = F.col(CORRUPT).isNotNull()
    return rows.filter(~bad & read).drop(CORRUPT), rows.filter(bad & read).select("_src", F.col(CORRUPT).alias("line"))


def merge_generations(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union of two schema generations by name; what one lacks is null."""
    return old.unionByName(new, allowMissingColumns=True)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = spark.read.schema(full).option("columnNameOfCorruptRecord", CORRUPT).json(path).withColumn("_src", F.col("_metadata.file_name"))
    return _split(rows, schema[0].name)


def read_log_lines(spark: SparkSession, path: str, pattern: str, names: list[str]) -> DataFrame:
    """A row for each log line that matches: the file, and the pattern's groups by name."""
    lines = spark.read.text(path).withColumn("_src", F.col("_metadata.file_name")).filter(F.col("value").rlike(pattern))
    return lines.select("_src", *(F.regexp_extract("value", pattern, i + 1).alias(n) for i, n in enumerate(names)))


def launch_of(file_name: str = "_src") -> list:
    """(stem, launch time) from names like stem_20260131_235959.csv; null where the name is formed otherwise."""
    pattern = r"^(.+)_(\d{8}_\d{6})\.[a-z]+$"
    stamp = F.nullif(F.regexp_extract(file_name, pattern, 2), F.lit(""))
    return [F.nullif(F.regexp_extract(file_name, pattern, 1), F.lit("")).alias("stem"), F.try_to_timestamp(stamp, F.lit("yyyyMMdd_HHmmss")).alias("launched")]


def write_csv(df: DataFrame, path: str, columns: list[str], mode: str = "errorifexists") -> None:
    """Columns in a fixed order, one header a file; refuses to replace what is there unless told so."""
    df.select(*columns).write.mode(mode).option("header", True).csv(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Appends under the header that the table has; other columns are refused."""
    spark = df.sparkSession
    try:
        there = spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        there = None
    if there is not None and there.dtypes != df.dtypes:
        raise ValueError(f"columns {df.dtypes} don't fit {there.dtypes}")
    df.write.mode("append").parquet(path)


def replace_if_grown(df: DataFrame, path: str, staging: str) -> bool:
    """Replaces a table only by one of the same columns and at least as many rows; the new one is written and counted in ``staging`` first."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(staging)
    new = spark.read.parquet(staging)
    try:
        old = spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old = None
    if old is not None and (old.dtypes != new.dtypes or new.count() < old.count()):
        return False
    new.write.mode("overwrite").parquet(path)
    return True


def guard_path(path: str, forbidden: list[str]) -> str:
    """The path, unless it lies under a forbidden root."""
    if any(path == r.rstrip("/") or path.startswith(r.rstrip("/") + "/") for r in forbidden):
        raise ValueError(f"{path} lies under a protected root")
    return path


def request_key(*columns: str) -> "F.Column":
    """Canonical key of a request: the hash of its fields as JSON, nulls left out."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def replay(requests: DataFrame, recorded: DataFrame, columns: list[str]) -> DataFrame:
    """Answers of recorded requests; ``recorded`` has key, answer."""
    return requests.withColumn("key", request_key(*columns)).join(recorded, "key", "left")


def geojson_features(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """A row a feature: id, geometry as JSON, properties by the DDL ``properties``."""
    schema = f"features array<struct<id:string,geometry:struct<type:string,coordinates:string>,properties:struct<{properties}>>>"
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f")).select("f.id", "f.geometry", "f.properties.*")
