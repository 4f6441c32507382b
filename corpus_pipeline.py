"""A corpus from raw documents: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tiffinmart.llm.decontaminate import drop_contaminated
from tiffinmart.llm.jaccard_join import one_of_each
from tiffinmart.llm.mixing import mix_sources
from tiffinmart.llm.quality_rules import keep_good
from tiffinmart.llm.queries import OTHER_WEIGHT, WEIGHTS
from tiffinmart.llm.secret_scan import redact_secrets


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without lines that are common on their host."""
    return keep_good(docs)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return one_of_each(docs, percent=80, size=5)


def contamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, in any order of its passages."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return redact_secrets(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents by the target weights of their sources, in random order."""
    return mix_sources(docs, WEIGHTS, OTHER_WEIGHT)


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_copies_stage),
    ("benchmark decontamination", contamination_stage),
    ("secret scans", secrets_stage),
    ("mixing sources", mixing_stage),
]

#: Secret spans and tiles have no SQL; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
