"""Reading files as a stream, and running a stream until its input is used up."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tabloom.session import scratch_path, setting

END_OF_TIME = "9999-01-01 00:00:00"
BYTES_PER_BATCH = 16 * 1024**3
TIME_ZONE = "spark.sql.session.timeZone"
KEPT_REPORTS = "spark.sql.streaming.numRecentProgressUpdates"
MERGE_SESSIONS_EARLY = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    files_per_batch: int | None = None,
    bytes_per_batch: int = BYTES_PER_BATCH,
) -> DataFrame:
    """Parquet files of a table as a stream, in micro-batches of bounded size.

    Spark takes a plain path for a folder. A table may be a single file, so its
    name is given as a pattern that matches just that name.
    """
    folder, _, name = path.rstrip("/").rpartition("/")
    if name.endswith(".parquet"):
        path = f"{folder}/[{name[0]}]{name[1:]}"
    return _files(spark, path, schema, files_per_batch, bytes_per_batch)


def _files(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None, bytes_per_batch: int) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.parquet(path)


def finish(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is available now, in as many batches as needed, and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


class Punctual(NamedTuple):
    """A feed split by lateness: where its rows on time lie, its late rows, and how far back the rows on time reach."""

    path: str
    schema: StructType
    time: str
    late: DataFrame
    reach_ms: int


def split_late(stream: DataFrame, time: str, lateness: str) -> Punctual:
    """Set aside the rows that come more than ``lateness`` behind the newest row of the batches before.

    On time and late rows together are the feed: nothing is dropped. Every batch
    writes its rows and its newest time under its id and reads those of lower ids
    only, so a repeated batch gives the same split. Rows without a time are on time.
    """
    spark = stream.sparkSession
    base = scratch_path(spark, "feed")
    schema = stream.schema
    marks: dict[int, tuple[datetime | None, datetime | None]] = {}

    def split(batch: DataFrame, batch_id: int) -> None:
        newest = max((m[0] for k, m in _marks(spark, base, marks).items() if k < batch_id and m[0]), default=None)
        limit = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {lateness}")
        at = F.col(time).cast("timestamp")
        late = F.coalesce(at < limit, F.lit(False)) if newest else F.lit(False)
        batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(f"{base}/rows/batch={batch_id}")
        rows = spark.read.schema(StructType([*schema, StructField("late", BooleanType())])).parquet(f"{base}/rows/batch={batch_id}")
        ends = rows.agg(F.max(at).alias("newest"), F.min(F.when(~F.col("late"), at)).alias("oldest"))
        ends.write.mode("overwrite").parquet(f"{base}/marks/batch={batch_id}")
        marks.pop(batch_id, None)

    with setting(spark, TIME_ZONE, "UTC"):
        run_batches(stream, split, f"{base}/progress")
        seen = sorted(_marks(spark, base, marks).items())
    reach, newest = 0, None
    for _, (top, low) in seen:
        newest = max(filter(None, (newest, top)), default=None)
        if newest and low:
            reach = max(reach, int((newest - low).total_seconds() * 1000) + 2)
    every = StructType([*schema, StructField("batch", LongType()), StructField("late", BooleanType())])
    rows = spark.read.schema(every).parquet(f"{base}/rows") if seen else spark.createDataFrame([], every)
    return Punctual(f"{base}/rows/batch=*/late=false", schema, time, rows.where("late").drop("batch", "late"), reach)


def _marks(spark: SparkSession, base: str, known: dict) -> dict:
    """Newest time of each batch, and oldest time of its rows on time; one row per batch."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/marks")
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        known.update({r["batch"]: (r["newest"], r["oldest"]) for r in spark.read.parquet(f"{base}/marks").collect()})
    return known


def run_to_end(feed: Punctual, transform: Callable[[DataFrame], DataFrame], bytes_per_batch: int = BYTES_PER_BATCH, files_per_batch: int | None = None, end_of_time: str = END_OF_TIME) -> DataFrame:
    """Run a query with event time in append mode over the rows on time; returns the written table.

    The watermark stays behind the oldest row that can still come, so that the query
    drops nothing (its progress reports are checked for that). State behind the
    watermark is written and dropped. So that the last state of a finite feed is
    written too, a second run of the same query reads a row at the end of time, NULL
    in all other columns.
    """
    spark = feed.late.sparkSession
    base = scratch_path(spark, "stream")
    end_dir, out, progress = f"{base}/end", f"{base}/out", f"{base}/progress"
    spark.createDataFrame([], feed.schema).coalesce(1).write.parquet(end_dir)

    def run() -> None:
        rows = _files(spark, feed.path, feed.schema, files_per_batch, bytes_per_batch).unionByName(stream_files(spark, end_dir, feed.schema))
        timed = rows.withColumn(feed.time, F.col(feed.time).cast("timestamp")).withWatermark(feed.time, f"{feed.reach_ms} milliseconds")
        writer = transform(timed).writeStream.outputMode("append").format("parquet")
        query = finish(writer.option("path", out).option("checkpointLocation", progress))
        dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
        if dropped:
            raise RuntimeError(f"{dropped} rows were behind the watermark")

    # naive times are taken as UTC, so that windows do not depend on the session's zone;
    # sessions of one key are merged before the shuffle as well as after it
    with setting(spark, TIME_ZONE, "UTC"), setting(spark, MERGE_SESSIONS_EARLY, "true"), setting(spark, KEPT_REPORTS, str(1 << 20)):
        run()
        end = spark.range(1).select(
            *[(F.lit(end_of_time) if f.name == feed.time else F.lit(None)).cast(f.dataType).alias(f.name) for f in feed.schema.fields]
        )
        end.coalesce(1).write.mode("append").parquet(end_dir)
        run()
    return spark.read.parquet(out)


class Windowed(NamedTuple):
    windows: DataFrame
    late: DataFrame


def run_windowed(
    spark: SparkSession,
    path: str,
    time: str,
    lateness: str,
    transform: Callable[[DataFrame], DataFrame],
    files_per_batch: int | None = None,
) -> Windowed:
    """Run an event-time aggregation over a finite feed: the windows of the rows on time, and the late rows."""
    feed = split_late(stream_files(spark, path, spark.read.parquet(path).schema, files_per_batch), time, lateness)
    return Windowed(run_to_end(feed, transform, files_per_batch=files_per_batch), feed.late)


def run_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], progress: str
) -> None:
    """Hand every micro-batch with its id to ``handle``.

    A batch may be handed over again after a failure: ``handle`` must give the same
    result when it is called twice with the same id.
    """
    finish(stream.writeStream.foreachBatch(handle).option("checkpointLocation", progress))
