"""Exact duplicates by progressive refinement: length, then a hash of the head, then the full hash.

Only Spark SQL functions. Every step groups small rows with partial aggregation;
texts move once, and a full hash is taken only where length and head already agree
(the query asks for the digest of every row and therefore hashes all).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.llm.rows import keyed, staying, unpacked
from tabloom.llm.storage import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HEAD_CHARS = 64


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; a pure ASCII text takes Spark's faster function."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after lower-casing A-Z; NULL counts as
    the empty text. Of a group the largest id stays. Rows that repeat the kept id are
    the same document and stay with it; a row without id stays only if its whole
    group has none. ``text_sha256`` is NULL for texts that were told apart earlier,
    unless ``digest_all``. An empty table gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        text.alias("text"),
        F.octet_length(text).alias("size"),
        F.xxhash64(ascii_lower(F.substring(text, 1, HEAD_CHARS))).alias("head"),
    )
    alike = rows.groupBy("size", "head").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    alike = written(alike.select("size", "head", F.lit(True).alias("alike")), "dedup-alike")
    digest = F.sha2(ascii_lower(F.col("text")).cast("binary"), 256)
    if not digest_all:
        digest = F.when(F.col("alike"), digest)
    read = written(
        rows.join(alike, ["size", "head"], "left").select("doc_id", "alike", digest.alias("text_sha256")), "dedup-digests"
    )
    groups = (
        read.where("alike")
        .groupBy("text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
    )
    groups = written(groups, "dedup-groups")  # a join of two plain shuffles can split a hot digest
    joined = read.join(groups, "text_sha256", "left")
    grouped = F.col("group_size").isNotNull()
    keep = F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of equal texts one row, with all its columns: the one with the largest id.

    Rows are judged one by one: rows that share an id but not a text do not go with
    each other. A row without id stays only if no equal text has an id. Of rows with
    the same id and equal texts one stays. An empty table gives no rows.
    """
    rows = keyed(docs, id_col, text_col)
    judged = written(exact_groups(rows.select("key", "text"), "key", "text").select("doc_id", "kept"), "dedup-judged")
    gone = written(judged.where("NOT kept").select(F.col("doc_id").alias("key")).distinct(), "dedup-gone")
    repeated = judged.where("kept").groupBy(F.col("doc_id").alias("key")).count().where("count > 1").select("key")
    return unpacked(staying(rows, gone, written(repeated, "dedup-repeated")))


SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256 FROM d
"""
