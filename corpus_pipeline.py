"""The corpus pipeline: quality rules, line dedup, near-duplicates, decontamination, mixing.

Each stage takes what the one before it kept, as written to Parquet; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm import decontaminate, line_dedup, mixing, quality, simhash
from sediment.staging import Staging, discarding

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass by themselves and by their host; the others go."""
    return quality.kept_rows(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that match an earlier one; `n_chars`, if there, is that of the new text."""
    found = line_dedup.dedup_lines(docs)
    changed = F.col("n_removed") > 0
    new = {"text": F.col("text"), "n_chars": F.char_length("text")}

    def column(name: str) -> Column:
        given = F.col(f"row.`{name}`")
        return (F.when(changed, new[name].cast(docs.schema[name].dataType)).otherwise(given) if name in new else given).alias(name)

    return found.select(*map(column, docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item; the others go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("mixing", mixing_to_weights),
]

# Fingerprints need XXH64 with a seed, which DuckDB's SQL has not; tests hold run() against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again; what a stage wrote for itself is dropped after it."""
    staging = Staging(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with discarding():
            docs = staging.write(name, stage(spark, docs, sf_dir))
    return docs
