"""Stored copies of a table arranged for a kind of query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.session import leaf_bytes
from tabloom.sources.tables import stored_files

#: Bytes of stored input that go into one file of a copy.
FILE_BYTES = 128 << 20

SMALL_FILE_BYTES = 32 * 1024 * 1024

# Shares of small files at which to merge or rewrite.
MERGE_SHARE, REWRITE_SHARE = 0.10, 0.30


def _in_files(df: DataFrame, keys: Sequence[str], files: int | None) -> DataFrame:
    """Rows in ranges of (keys, number of the row), as many as their stored bytes ask for.

    The number tells equal keys apart, so that a key with very many rows is cut over
    as many ranges as its share of the rows.
    """
    count = files or max(1, -(-leaf_bytes(df) // FILE_BYTES))
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    return numbered.repartitionByRange(count, *keys, "_row").drop("_row").sortWithinPartitions(*keys)


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], files: int | None = None) -> DataFrame:
    """A copy ordered by ``keys``: a filter on them skips files and row groups."""
    _in_files(df, keys, files).write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_covering(df: DataFrame, path: str, keys: Sequence[str], included: Sequence[str]) -> DataFrame:
    """A narrow copy: the keys and the columns a query reads besides them."""
    return write_sorted(df.select(*keys, *included), path, keys)


def write_partitioned(df: DataFrame, path: str, partition: str, sort: Sequence[str], files: int | None = None) -> DataFrame:
    """One folder per value of the leading column, rows inside ordered by the others.

    The rows are cut into ranges of all the keys, so that the rows of one large
    partition value are written by several tasks.
    """
    spread = _in_files(df, [partition, *sort], files)
    spread.write.mode("errorifexists").partitionBy(partition).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def write_filtered(df: DataFrame, path: str, condition: Column, keys: Sequence[str]) -> DataFrame:
    """A copy of the rows that meet a condition; it answers queries that imply it."""
    return write_sorted(df.where(condition), path, keys)


def compaction_report(spark: SparkSession, path: str, small_bytes: int = SMALL_FILE_BYTES) -> DataFrame:
    """Files of a stored table, the share of small ones, and what to do about them; lists the files and reads none."""
    files = stored_files(spark, path)
    share = F.count_if(F.col("file_size") < small_bytes) / F.count(F.lit(1))
    summary = files.agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("file_size").alias("n_bytes"), share.alias("small_share")
    )
    advice = (
        F.when((F.col("small_share") < MERGE_SHARE) | (F.col("n_files") == 1), "keep")
        .when(F.col("small_share") <= REWRITE_SHARE, "merge small files")
        .otherwise("rewrite")
    )
    return summary.withColumn("advice", advice)


def compact_files(spark: SparkSession, source: str, path: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Rewrite a stored table with even files; the bytes of its files give their number."""
    size = stored_files(spark, source).agg(F.sum("file_size")).first()[0] or 0
    df = spark.read.parquet(source)
    df.repartition(max(1, -(-size // file_bytes))).write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
