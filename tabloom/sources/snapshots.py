"""A table kept as numbered full copies, for changes on plain parquet.

A version becomes visible only after its data is complete: the record in
``published`` is written last. One writer per table.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _data(self, version: int) -> str:
        return f"{self.path}/data/version={version}"

    def publish(self, state: DataFrame, version: int | None = None) -> int:
        """Write a new version; writing the same version again replaces it."""
        if version is None:
            version = (self.current_version() or 0) + 1
        state.write.mode("overwrite").parquet(self._data(version))
        record = self.spark.range(1).select(F.current_timestamp().alias("published_at"))
        record.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/published/version={version}")
        return version

    def current_version(self) -> int | None:
        try:
            published = self.spark.read.parquet(f"{self.path}/published")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return published.agg(F.max("version")).first()[0]

    def read(self, version: int | None = None) -> DataFrame:
        version = self.current_version() if version is None else version
        if version is None:
            raise ValueError(f"nothing is published in {self.path}")
        return self.spark.read.parquet(self._data(version))
