"""Corpus preparation: five stages over ``documents``, each one operator of the library.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's input. All but the last return the columns of
``documents``; the last adds the mixing schedule. Texts go to the tasks in batches of
``BATCH_BYTES`` (a setting of the session, which stays) instead of 10,000 rows, so what
executors and their Python workers hold at once does not depend on the texts' lengths.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ordersmith.llm.decontaminate import remove_contaminated
from ordersmith.llm.jaccard_join import keep_one_per_component
from ordersmith.llm.mixing import mix_sources
from ordersmith.llm.quality_lm import keep_accepted
from ordersmith.llm.staging import release, stage
from ordersmith.llm.suffix_dedup import remove_repeats

BATCH_BYTES = "8m"


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose perplexity under trusted text is above their language's quantile."""
    small_batches(spark)
    return keep_accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group (5-word shingles, 0.75)."""
    small_batches(spark)
    return keep_one_per_component(docs)


def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts strings of 100 bytes that also start earlier; documents left empty go."""
    small_batches(spark)
    return remove_repeats(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    small_batches(spark)
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every document in the Pfair interleaving of its source's blocks."""
    return mix_sources(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_text),
    ("benchmark_decontamination", benchmark_leaks),
    ("mixing_to_weights", mixing),
]

# Perplexities, near-duplicate components over byte cuts and latent retrieval are not
# expressible in SQL; tests/llm/test_pipeline.py holds run() against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark)
    return docs
