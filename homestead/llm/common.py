"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

#: Arrow batches handed to Python stay below this many bytes, so a run of very
#: long texts does not make a batch of gigabytes.
BATCH_BYTES = 16 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` (long) and ``text`` (string) only: other columns, whatever
    their names, never reach an operator."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"), *more)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(doc_id: Column, mod: int = 5) -> Column:
    """crc32 of the id's decimal text modulo ``mod``; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def small_batches(batch: pa.RecordBatch, column: str = "text",
                  limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch by rows so that each piece holds about ``limit`` bytes of
    ``column`` (one row at least)."""
    n = batch.num_rows
    col = batch.column(column)
    parts = max(1, math.ceil(col.nbytes / limit))
    step = max(1, math.ceil(n / parts))
    for i in range(0, n, step):
        yield batch.slice(i, step)


def written(df: DataFrame, name: str, spark: SparkSession | None = None) -> DataFrame:
    """Write a work table below the shared checkpoint folder and read it
    back: later steps read files that every executor sees, so a lost executor
    costs no recomputation."""
    spark = spark or df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_package(df: DataFrame) -> DataFrame:
    """Make this package importable in the executors' Python workers."""
    ship_package(df.sparkSession)
    return df
