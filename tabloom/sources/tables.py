"""Parquet tables of one directory, and reports on how they are stored."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.session import scratch_path

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """Lazy access to the tables of a directory: ``Tables(spark, path).orders``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def file_of(self, name: str) -> str:
        return f"{self.path}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.file_of(name))

    def sql(self, text: str, *names: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
        """Run SQL text in which ``{name}`` stands for a table or a given DataFrame."""
        frames = {**{n: getattr(self, n) for n in names}, **frames}
        return self.spark.sql(text, args=args, **frames)


def register_tables(spark: SparkSession, path: str) -> DataFrame:
    """Register one temp view per table; returns (table_name, n_columns, n_rows)."""
    tables = Tables(spark, path)
    widths, rows = [], []
    for name in TABLE_NAMES:
        df = getattr(tables, name)
        df.createOrReplaceTempView(name)
        widths.append(F.struct(F.lit(name).alias("table_name"), F.lit(len(df.columns)).alias("n_columns")))
        rows.append(df.select(F.lit(name).alias("table_name")))
    counts = reduce(DataFrame.unionByName, rows).groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))
    listed = spark.range(1).select(F.inline(F.array(*widths)))
    return listed.join(counts, "table_name", "left").select(
        "table_name", "n_columns", F.coalesce("n", F.lit(0)).alias("n_rows")
    )


def select_into(df: DataFrame, path: str | None = None) -> DataFrame:
    """Create a table from a query: write it once, then read the written copy."""
    path = path or scratch_path(df.sparkSession, "table")
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def row_provenance(df: DataFrame) -> DataFrame:
    """Add the file and the position in that file each row was read from."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.row_index").alias("row_index"),
    )


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, file_size, modified) of a stored table, from a listing: contents are pruned, so no file is opened."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return listed.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("file_size"), F.col("modificationTime").alias("modified"))


def file_layout(spark: SparkSession, path: str) -> DataFrame:
    """Rows and bytes per stored file of a table; rows come from the footers of the files, no column is read."""
    name = F.col("_metadata.file_name").alias("file_name")
    counted = spark.read.parquet(path).groupBy(name).agg(F.count(F.lit(1)).alias("n_rows"))
    files = stored_files(spark, path).select("file_name", "file_size")
    return files.join(counted, "file_name", "left").select("file_name", "file_size", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def inflate(df: DataFrame, times: int, copy: str = "copy_no") -> DataFrame:
    """Repeat every row ``times`` times inside its own partition (no shuffle)."""
    return df.withColumn(copy, F.explode(F.sequence(F.lit(1), F.lit(times))))
