"""From raw documents to ids: quality, exact copies, near copies, benchmark passages, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.llm.decontaminate import decontaminate
from tabloom.llm.exact_dedup import drop_exact_copies
from tabloom.llm.jaccard import drop_near_duplicates
from tabloom.llm.pieces import encode_digests
from tabloom.llm.quality import drop_low_quality
from tabloom.llm.storage import written
from tabloom.sources.tables import Tables


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return drop_low_quality(docs, Tables(spark, sf_dir).labels)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return drop_exact_copies(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies the document with the smallest id stays."""
    return drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that mostly consist of them go."""
    return decontaminate(docs, Tables(spark, sf_dir).benchmark)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of every document's ids, and digest of the decoded text."""
    return encode_digests(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece_encoding),
]
#: The classifier's fit and the encoding are beyond SQL; tests run the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read by the next."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0].lower()}")
    return STAGES[-1][1](spark, docs, sf_dir)
