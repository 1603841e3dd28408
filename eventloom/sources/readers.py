"""Readers with explicit schemas; each adds the generated date column of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventloom.sources import schemas

# The JSON payload column is full of quotes, so CSV doubles them instead of using a backslash.
# NULL is written as a mark of its own, so that it differs from the empty string.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "nullValue": "\\N"}
# Text writers cut timestamps to milliseconds by default; readers accept any ISO form.
MICROSECONDS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def with_date(df: DataFrame, ts: str, out: str) -> DataFrame:
    return df.withColumn(out, F.to_date(ts))


def _load(spark: SparkSession, path: str, fmt: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        # A file whose values hold line breaks cannot be split and is read by one task.
        return reader.options(**CSV_OPTIONS, multiLine=multi_line).csv(path)
    if fmt == "json":
        # One array per file; many files still read in parallel.
        return reader.option("multiLine", "true").json(path)
    if fmt == "jsonl":
        return reader.json(path)
    if fmt == "parquet":
        return reader.parquet(path)
    raise ValueError(f"unknown format {fmt!r}")


def read_events(spark: SparkSession, path: str, fmt: str = "parquet", multi_line: bool = False) -> DataFrame:
    return with_date(_load(spark, path, fmt, schemas.EVENTS, multi_line), "event_timestamp", "event_date")


def read_users(spark: SparkSession, path: str, fmt: str = "parquet", multi_line: bool = False) -> DataFrame:
    return with_date(_load(spark, path, fmt, schemas.USERS, multi_line), "created_at", "user_date")


def read_sessions(spark: SparkSession, path: str, fmt: str = "parquet", multi_line: bool = False) -> DataFrame:
    return with_date(_load(spark, path, fmt, schemas.SESSIONS, multi_line), "started_at", "session_date")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS, **MICROSECONDS).csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").options(**MICROSECONDS).json(path)


def inline(spark: SparkSession, rows: list[tuple], schema: StructType | str) -> DataFrame:
    """A few literal rows, for samples and tests."""
    return spark.createDataFrame(rows, schema)
