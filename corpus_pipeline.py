"""Corpus pipeline: quality rules, near copies, repeated passages, benchmark text, mix.

Rows are judged by identifier and text, so NULL and repeated identifiers lose no other text; a NULL or empty text is rejected by the
first stage. Further columns pass through, whatever they are called, and an empty table gives no rows in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from holdfast.llm import decontamination, mixing, passages, quality, simhash
from holdfast.sources.storage import fresh_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality.filtered(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest identifier of each group linked by fingerprints of three-word shingles at two differing bits or fewer."""
    return simhash.deduplicated(docs, shingle=3, most=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-byte strings that a smaller identifier has, n_chars counted anew."""
    return passages.without_repeats(docs)


def benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word window of a benchmark item occurs."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, with its size, its source's target and the copy's number."""
    size = docs.withColumn("size", mixing.n_words())
    return mixing.emitted(mixing.mixed(size))


STAGES = [
    ("quality rules", quality_rules), ("near copies", near_copies), ("repeated passages", repeated_passages),
    ("benchmark text", benchmark_text), ("mixing sources", mix_sources),
]
#: Fingerprints, byte matching and systematic sampling have no SQL form; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = fresh_path(spark, f"stage{k}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
