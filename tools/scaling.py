"""Seconds of the ordered operators by number of cores: python tools/scaling.py COPY_DIR CORES.

COPY_DIR holds an enlarged copy of the order lines in several files, written on
the first call; half of its rows belong to one part.
"""

from __future__ import annotations

import json
import os
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from pyspark.sql import Window, functions as F  # noqa: E402

from tabloom.operators import ordering as O, windows as W  # noqa: E402
from tabloom.session import build_session  # noqa: E402
from tabloom.sources.tables import Tables, inflate  # noqa: E402


def main(copy_dir: str, cores: str, times: int = 8) -> None:
    spark = build_session(
        "scaling",
        f"local[{cores}]",
        **{
            "spark.sql.shuffle.partitions": "32",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.driver.extraJavaOptions": "-XX:+UseParallelGC",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not os.path.exists(f"{copy_dir}/_SUCCESS"):
        lines = Tables(spark, "/root/testdata/sf0.1").lineitem
        hot = F.when(F.col("l_orderkey") % 2 == 0, 1).otherwise(F.col("l_partkey"))
        inflate(lines.withColumn("l_partkey", hot), times).select(
            F.monotonically_increasing_id().alias("id"), "l_partkey", "l_shipdate",
            F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        ).repartition(16).write.parquet(copy_dir)
    df = spark.read.parquet(copy_dir)
    order = ["l_shipdate", "id"]
    sorts = [F.col(c) for c in order]
    whole, per_part = Window.orderBy(*sorts), Window.partitionBy("l_partkey").orderBy(*sorts)
    so_far = (Window.unboundedPreceding, Window.currentRow)
    forms = {
        "row_number_all_plain": lambda: df.withColumn("rn", F.row_number().over(whole)),
        "row_number_all_ranges": lambda: O.number_rows(df, order),
        "running_sum_hot_key_plain": lambda: df.withColumn("s", F.sum("price").over(per_part.rowsBetween(*so_far))),
        "running_sum_hot_key_ranges": lambda: O.running(df, order, ["l_partkey"], totals={"s": "price"}),
        "rank_all_plain": lambda: df.withColumn("r", F.rank().over(Window.orderBy("l_shipdate"))),
        "rank_all_ranges": lambda: O.rank_rows(df, ["l_shipdate"]),
        "latest_per_key": lambda: W.latest_per_key(df, ["l_partkey"], order),
    }
    seconds = {}
    for name, form in forms.items():
        for _ in range(2):
            started = time.perf_counter()
            form().write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 2)
    print(json.dumps({"cores": cores, "rows": df.count(), "seconds": seconds}))
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:3])
