"""A bounded, reproducible sample of labelled rows for fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SPACE = 1_000_000


def sample(labels: DataFrame, column: str, bound: int) -> DataFrame:
    """doc_id and the label (0/1) of about `bound` documents at most, chosen by a hash of the id.

    Null ids and labels are left out; of a document's several labels the greatest counts.
    """
    one = labels.filter(F.col("doc_id").isNotNull() & F.col(column).isNotNull()).groupBy("doc_id").agg(F.max(column).alias(column))
    n = one.count()
    share = SPACE if n <= bound else int(SPACE * bound / n)
    return one.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SPACE)) < share).limit(bound)


def with_label(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The documents of the sample; its size is bounded, so it is sent to every task."""
    return docs.join(F.broadcast(chosen), "doc_id")
