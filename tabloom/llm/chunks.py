"""The distinct-chunk table: look every distinct chunk of a text up once, and bring the answers back.

Texts are cut into blocks of bounded size. Every block sends its distinct chunks, once
each, to the bucket of their hash; a bucket answers for its distinct chunks, once
each; the answers return to the block, where chunks are replaced by position. Rows
are compressed Arrow packets, one per block and bucket, so that a chunk that stands
in every text travels once per block and no key is hot.

Blocks are cut in the order of the input's partitions. Answers come back without their
chunks, in the order of the block's sorted chunks of the bucket, and with a checksum of
them. Should a recomputed input come in another order, checksums differ and the block
lacks those answers (``Found.columns`` tells which chunks have one), so that no answer
is ever given to another chunk.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tabloom.llm.storage import pack, unpack

#: Characters of text after which a block ends; one longer text is a block of its own.
BLOCK_CHARS = 32_000_000


#: Rows whose texts are Python strings at a time.
RUN_ROWS = 256


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list, list[str]]]:
    """(block, ids, texts) of some rows at a time, none of two blocks; NULL texts are empty."""
    part, number, chars = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        for low in range(0, batch.num_rows, RUN_ROWS):
            run = batch.slice(low, RUN_ROWS)
            ids, texts = [], []
            for key, text in zip(run.column(0).to_pylist(), run.column(1).to_pylist()):
                ids.append(key)
                texts.append(text or "")
                chars += len(texts[-1]) + 20
                if chars >= BLOCK_CHARS:
                    yield f"{part}-{number}", ids, texts
                    ids, texts, chars, number = [], [], 0, number + 1
            if ids:
                yield f"{part}-{number}", ids, texts


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[tuple[list, list[str]]]]]:
    """(block, runs of ids and texts); the runs of a block are to be read before the next block."""
    for block, runs in groupby(_runs(batches), key=itemgetter(0)):
        yield block, ((ids, texts) for _, ids, texts in runs)


def text_blocks(docs: DataFrame) -> DataFrame:
    """(block, packet): ids and texts of ``docs`` (id, text)."""
    kind = docs.schema[0].dataType.simpleString()
    kind = pa.int64() if kind in ("bigint", "int", "smallint", "tinyint") else pa.string()

    def cut(batches):
        for block, runs in _blocks(batches):
            columns = zip(*((pa.array(ids, kind), pa.array(texts, pa.large_string())) for ids, texts in runs))
            packet = pack(**dict(zip(("id", "text"), map(pa.concat_arrays, columns))))
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([packet], pa.binary())], names=["block", "packet"])

    return docs.mapInArrow(cut, "block string, packet binary")


def _dealt(chunks: Iterable[str], buckets: int) -> dict[int, list[str]]:
    """Sorted chunks by the bucket of their hash."""
    parts: dict[int, list[str]] = {}
    for chunk in sorted(chunks):
        parts.setdefault(zlib.crc32(chunk.encode()) % buckets, []).append(chunk)
    return parts


def _checksum(chunks: list[str]) -> int:
    return zlib.crc32(repr(chunks).encode("utf-8", "backslashreplace"))


def chunk_packets(docs: DataFrame, split: Callable[[list, list[str]], dict[str, int]], buckets: int) -> DataFrame:
    """(bucket, block, packet): the distinct chunks of every block with a count, by bucket.

    ``split(ids, texts)`` counts the chunks of some rows; the texts of a block are never held together.
    """

    def cut(batches):
        for block, runs in _blocks(batches):
            counts: dict[str, int] = {}
            for ids, texts in runs:
                for chunk, n in split(ids, texts).items():
                    counts[chunk] = counts.get(chunk, 0) + n
            parts = _dealt(counts, buckets)
            keys = list(parts)
            packets = [pack(chunk=pa.array(c, pa.string()), count=pa.array([counts[x] for x in c], pa.int64())) for c in parts.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int32()), pa.array([block] * len(keys), pa.string()), pa.array(packets, pa.binary())], names=["bucket", "block", "packet"]
            )

    return docs.mapInArrow(cut, "bucket int, block string, packet binary")


def bucket_count(docs: DataFrame) -> int:
    return max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def answered(
    packets: DataFrame,
    answer: Callable[[dict[str, int]], dict[str, pa.Array]],
    summary: Callable[[dict[str, int], dict[str, pa.Array]], bytes] | None = None,
) -> DataFrame:
    """(block, bucket, checksum, packet, summary): per block and bucket, the columns of ``answer``.

    ``answer`` gets the distinct chunks of a bucket with their counts over all blocks
    and returns columns in the same order. What ``summary`` makes of both stands on one
    row of each bucket.
    """

    def fill(table: pa.Table) -> pa.Table:
        packets = table["packet"].to_pylist()
        counts: dict[str, int] = {}
        for packet in packets:
            part = unpack(packet)
            for chunk, n in zip(part["chunk"].to_pylist(), part["count"].to_pylist()):
                counts[chunk] = counts.get(chunk, 0) + n
        columns = answer(counts)
        place = {chunk: k for k, chunk in enumerate(counts)}
        out, sums = [], []
        for packet in packets:
            chunks = unpack(packet)["chunk"].to_pylist()
            at = pa.array([place[c] for c in chunks], pa.int64())
            out.append(pack(**{name: column.take(at) for name, column in columns.items()}))
            sums.append(_checksum(chunks))
        told = [summary(counts, columns) if summary else None, *[None] * (len(out) - 1)]
        return pa.table(
            {
                "block": table["block"],
                "bucket": table["bucket"],
                "checksum": pa.array(sums, pa.int64()),
                "packet": pa.array(out, pa.binary()),
                "summary": pa.array(told, pa.binary()),
            }
        )

    return packets.groupBy("bucket").applyInArrow(fill, "block string, bucket int, checksum bigint, packet binary, summary binary")


class Found:
    """The answers that came back to a block."""

    def __init__(self, table: pa.Table, buckets: int):
        self.buckets = buckets
        self.parts = {row["bucket"]: (row["checksum"], row["packet"]) for row in table.to_pylist()}

    def columns(self, chunks: Iterable[str]) -> Iterator[tuple[list[str], pa.Table]]:
        """Chunks of a bucket beside their answers, for all buckets whose answers are for exactly these chunks."""
        for bucket, part in _dealt(chunks, self.buckets).items():
            checksum, packet = self.parts.get(bucket, (None, b""))
            if checksum == _checksum(part):
                yield part, unpack(packet)


def by_block(texts: DataFrame, answers: DataFrame, use: Callable[[list, list[str], Found], pa.Table], buckets: int, schema: str) -> DataFrame:
    """``use(ids, texts, answers)`` for every block, where texts and answers meet."""

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = Found(right.select(["bucket", "checksum", "packet"]), buckets)
        out = []
        for packet in left["packet"].to_pylist():
            part = unpack(packet)
            out.append(use(part["id"].to_pylist(), part["text"].to_pylist(), found))
        return pa.concat_tables(out) if out else use([], [], found)

    kept = answers.select("block", "bucket", "checksum", "packet")
    return texts.groupBy("block").cogroup(kept.groupBy("block")).applyInArrow(meet, schema)
