"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.sources import paths

FOLDS = 5
BATCH_ROWS = 1000
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of this application, wherever they run, and bound the
    rows they are handed at a time: documents are long, and Spark's default is 10,000 rows."""
    context = spark.sparkContext
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    where = Path(tempfile.mkdtemp(prefix="eventloom-code-")) / "eventloom.zip"  # read by the driver only, which serves it
    with zipfile.ZipFile(where, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(where))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    where = paths.scratch_dir(spark, label)
    df.write.parquet(where)
    return spark.read.schema(df.schema).parquet(where)


def numbered(docs: DataFrame, text: str, carry: tuple[str, ...]) -> DataFrame:
    """The text as ``_text``, then the carried columns under numbers, so that no names can clash."""
    return docs.select(F.col(text).alias("_text"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(carry)])


def held_out(doc_id: Column) -> Column:
    """The fold that training never sees; a NULL id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def hashed_sample(df: DataFrame, rows: int, *, by: Column) -> DataFrame:
    """At most ``rows`` rows in the order of a hash, the same ones however the input is laid out."""
    return df.orderBy(F.xxhash64(by), by).limit(rows)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 4096) -> Iterator[pa.Table]:
    """Tables of complete groups from a partition sorted by ``keys``; groups must be bounded."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        whole = pa.Table.from_batches(held).combine_chunks()
        cut = starts(whole, keys)[-1]
        if cut:
            yield whole.slice(0, cut)
        held, size = whole.slice(cut).to_batches(), whole.num_rows - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def starts(table: pa.Table, keys: list[str]) -> list[int]:
    """Row numbers at which a new group begins."""
    columns = [table.column(k).to_pylist() for k in keys]
    rows = list(zip(*columns, strict=True))
    return [i for i, r in enumerate(rows) if i == 0 or r != rows[i - 1]]
