"""From raw documents to sampled token sequences, in five stages.

Every stage reads what its predecessor kept and wrote; all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factgraph.llm import compression_quality, decontaminate, near_dedup, sampled_encoding, substring_dedup
from factgraph.llm.common import fold, staged, table

# Similarity of near duplicates, as a whole percentage.
SIMILAR_PERCENT = 80
# The executors of the last stage still hold the memory of the stages before it, so it
# remembers fewer chunks and works on less text at once than the operator by itself.
REMEMBERED, SLICE = 80_000, 1 << 17


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts; it learns from three quarters of the labels."""
    model = compression_quality.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    return compression_quality.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return near_dedup.one_of_each(docs, SIMILAR_PERCENT)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that stand in an earlier document."""
    return substring_dedup.deduplicated(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every whole text: ``doc_id, sample, n_pieces, log_prob,
    perturbed, log_inclusion, ids_crc32, decoded_crc32, decodes, ids``."""
    return sampled_encoding.segmentations(docs, remembered=REMEMBERED, limit=SLICE)


STAGES = [
    ("quality_classifier", quality),
    ("near_dedup", near_duplicates),
    ("substring_dedup", substrings),
    ("benchmark_decontamination", benchmark),
    ("sampled_encoding", encoding),
]

# A trained classifier and random segmentations are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
