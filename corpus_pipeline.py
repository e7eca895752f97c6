"""The training-data pipeline over `documents`: each stage's rows are written and read again.

Each stage works on all rows that the one before has kept and returns the columns it was given;
the last one adds the rate at which a document is drawn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.llm.common import Shared, table
from gaugeworks.llm.decontaminate import decontaminate
from gaugeworks.llm.jaccard import drop_near_duplicates
from gaugeworks.llm.line_rules import clean
from gaugeworks.llm.mixing import mix_rows
from gaugeworks.llm.secrets import mask_secrets


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents of a source share go, and documents that the rules reject."""
    return clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) one document stays."""
    return drop_near_duplicates(docs, n_words=5, percent=80)


def benchmark_contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows are 5 percent of the words or more go; shorter
    passages are cut out."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Values of secrets are masked; every document stays."""
    return mask_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its rate, `mix_rate`."""
    return mix_rows(docs, table(spark, sf_dir, "labels"), Shared(spark, "mixing"))


STAGES = [
    ("line_rules", quality_rules),
    ("jaccard_join", near_duplicates),
    ("decontaminate", benchmark_contamination),
    ("secrets", secret_scan),
    ("mixing", mixing),
]

#: Fits and masks by position are beyond SQL; tests hold the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    shared = Shared(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared.keep(stage(spark, docs, sf_dir), name)
    return docs
