"""The corpus pipeline: quality rules, quality classifier, near duplicates, decontamination, packing.

Every stage takes the documents that its predecessor kept and returns those it keeps, with the same
columns; the last returns the pieces of the packed sequences.

Defined cases: nulls, empty texts, repeated rows, ties, empty tables and extra columns are treated as
the docstrings of the operators say; rows without an id pass the joins of the stages.

The stages hand whole texts to Python in small Arrow batches: a runtime setting, which stays set on the
session, as the table a stage returns is computed later. A size that the caller has set is left alone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from dishframe.llm import decontamination, near_duplicates, packing, quality_classifier, quality_rules
from dishframe.llm.common import written
from dishframe.llm.plans import tokenizer_path
from dishframe.plans.tables import Catalog, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

BATCH_SETTING, SPARKS_BATCH, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "2m"


def in_small_batches(stage: Stage) -> Stage:
    """The stage, with Arrow batches of about 2 MB: executor and Python worker both hold a batch of each task."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH_SETTING, None) in (None, SPARKS_BATCH):
            spark.conf.set(BATCH_SETTING, BATCH)
        return stage(spark, docs, sf_dir)

    return run


@in_small_batches
def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept_documents(docs)


@in_small_batches
def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_classifier.kept_documents(docs, table(spark, sf_dir, "labels"))


@in_small_batches
def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.one_of_each(docs)


@in_small_batches
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", rules_stage),
    ("quality classifier", classifier_stage),
    ("n-gram Jaccard join", duplicates_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Tokenizer ids, learned references and hashes are not SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs


catalog = Catalog()
catalog.query(ORACLE_SQL, "pipeline")(run)
