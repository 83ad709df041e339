"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


#: Spark gives sources of unknown size a size near the largest bigint.
UNKNOWN_BYTES = 1 << 60


def build_session(app: str = "tabloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ANSI errors, UTC and adaptive execution (AQE also splits skewed joins)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; every executor must reach it.

    Only a local master may fall back to a temporary folder: on a cluster such a
    folder would be lost with its machine.
    """
    context = spark.sparkContext
    active = context.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None) or active
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="tabloom-")
    if active is None:
        context.setCheckpointDir(configured)
    return configured


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Change a session setting for the length of a block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written copy.

    Iterative operators call this once per round, so that plans stay short and a
    lost executor costs one round at most.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the written copy.

    Unlike a checkpoint the copy is a table of columns: later passes read only the
    columns they need, and Spark knows its size.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def leaf_bytes(df: DataFrame) -> int:
    """Bytes of the stored tables that ``df`` reads, as far as the optimizer knows them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < UNKNOWN_BYTES)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the result; an unknown size counts as very large."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
