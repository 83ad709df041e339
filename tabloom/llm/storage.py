"""Written tables in the shared folder, and Arrow packets that travel in a binary column."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabloom.session import scratch_path


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written copy.

    The copy has a known size, so that Spark decides by its own threshold whether
    a later join may broadcast it, and a lost executor costs no recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of ids that may be broadcast: 16 MB for two bigints.
SMALL_ROWS = 1_000_000


def small(table: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A written table of ids, to be broadcast if it is counted to have few rows; else Spark shuffles both sides."""
    return F.broadcast(table) if table.count() <= rows else table


def pack(**columns: pa.Array) -> bytes:
    """Columns of equal length as one compressed Arrow stream."""
    batch = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(packet: bytes) -> pa.Table:
    return pa.ipc.open_stream(packet).read_all()
