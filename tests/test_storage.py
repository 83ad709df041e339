"""Stored copies and published versions."""

import pytest
from pyspark.sql import functions as F

from tabloom.operators import layout as L
from tabloom.session import scratch_path
from tabloom.sources import tables as T
from tabloom.sources.snapshots import SnapshotTable


def test_versions(spark, same):
    table = SnapshotTable(spark, scratch_path(spark, "t"))
    assert table.current_version() is None
    with pytest.raises(ValueError):
        table.read()
    assert table.publish(spark.range(3)) == 1
    assert table.publish(table.read().where("id > 0")) == 2
    assert table.read().count() == 2 and table.read(1).count() == 3


def test_unfinished_version_is_not_seen(spark):
    table = SnapshotTable(spark, scratch_path(spark, "t"))
    table.publish(spark.range(3))
    spark.range(9).write.parquet(f"{table.path}/data/version=2")  # the writer was lost before publishing
    assert table.current_version() == 1 and table.read().count() == 3
    assert table.publish(spark.range(5)) == 2 and table.read().count() == 5


def test_sorted_copy_separates_ranges(spark, same):
    df = spark.range(10_000).select("id", (F.col("id") * 7919 % 10_000).alias("k"))
    stored = L.write_sorted(df, scratch_path(spark, "sorted"), ["k"], files=4)
    same(stored, df)
    files = stored.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.min("k").alias("low"), F.max("k").alias("high"))
    edges = files.orderBy("low").collect()
    assert all(a.high < b.low for a, b in zip(edges, edges[1:]))


def test_hot_partition_is_written_by_several_tasks(spark, same):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("s"))
    stored = L.write_partitioned(df, scratch_path(spark, "parts"), "s", ["id"], files=4)
    same(stored.groupBy("s").count(), df.groupBy("s").count())
    hot = stored.where("s = 'hot'")
    assert "PartitionFilters: [isnotnull(s" in hot._jdf.queryExecution().toString()
    assert hot.select("_metadata.file_name").distinct().count() > 1


def test_a_hot_key_fills_several_files(spark, same):
    """Half of the rows hold one key: several files hold it alone, and a filter on another key reads one file."""
    df = spark.range(8000).select("id", F.when(F.col("id") % 2 == 0, 500).otherwise(F.col("id") % 1000).alias("k"))
    stored = L.write_sorted(df, scratch_path(spark, "hot"), ["k"], files=8)
    same(stored, df)
    name = F.col("_metadata.file_name").alias("f")
    sizes = [r["count"] for r in stored.groupBy(name).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 1000
    ends = stored.groupBy(name).agg(F.min("k").alias("low"), F.max("k").alias("high")).collect()
    assert sum(r.low == r.high == 500 for r in ends) >= 2
    assert sum(r.low <= 901 <= r.high for r in ends) == 1


def test_compaction(spark, same):
    path = scratch_path(spark, "small")
    spark.range(2000).repartition(40).write.parquet(path)
    report = L.compaction_report(spark, path).first()
    assert (report.n_files, report.small_share, report.advice) == (40, 1.0, "rewrite")
    target = scratch_path(spark, "compact")
    compacted = L.compact_files(spark, path, target)
    assert L.compaction_report(spark, target).first().n_files == 1
    assert L.compact_files(spark, path, scratch_path(spark, "compact"), file_bytes=report.n_bytes // 3).select("_metadata.file_name").distinct().count() in (3, 4)
    same(compacted, spark.read.parquet(path))


def test_listing_opens_no_file(spark):
    path = scratch_path(spark, "broken")
    spark.range(10).repartition(3).write.parquet(path)
    plan = T.stored_files(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
    assert T.stored_files(spark, path).count() == 3


def test_provenance_and_layout(spark, tables):
    rows = T.row_provenance(tables.nation).orderBy("row_index").collect()
    assert [r.row_index for r in rows] == list(range(25)) and {r.file_name for r in rows} == {"nation.parquet"}
    assert T.file_layout(spark, tables.file_of("nation")).first().n_rows == 25


def test_unknown_table(tables):
    with pytest.raises(AttributeError):
        tables.nonsense
