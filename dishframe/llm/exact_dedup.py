"""Exact duplicates: groups of a 128-bit content hash, split where the bytes differ.

Texts are grouped by their hash and their bytes together, so a collision of hashes makes two classes.
The grouping combines in each task before the exchange: of a text copied into a third of all rows, each
task sends one row. Rows find their class by hash and SHA-256 digest through narrow rows without text;
two classes that agree in both raise an error instead of being mixed up.

Defined cases: a null text is empty (or what `normalise` makes of it); a row without an id never
stays unless its whole class has no id, then one row stays and `keep_id` is null; of rows that repeat
the id that stays, one stays; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from dishframe.llm.common import written

Keep = Callable[[Column], Column]


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.md5(text.cast("binary"))


def classes(texts: DataFrame, keep: Keep, hashed: Callable[[Column], Column]) -> DataFrame:
    """One row per distinct text of (doc_id, text): its hash, digest, size and the id that stays."""
    of_text = texts.groupBy(hashed(F.col("text")).alias("key"), "text").agg(
        F.count(F.lit(1)).alias("group_size"), keep(F.col("doc_id")).alias("keep_id")
    )
    distinct = of_text.select("key", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "group_size", "keep_id")
    one = distinct.groupBy("key", "text_sha256").agg(
        F.count(F.lit(1)).alias("n"), F.first("group_size").alias("group_size"), F.first("keep_id").alias("keep_id")
    )
    clash = F.raise_error(F.lit("texts with other bytes agree in hash and digest"))
    size = F.when(F.col("n") == 1, F.col("group_size")).otherwise(clash.cast("bigint"))
    return one.select("key", "text_sha256", size.alias("group_size"), "keep_id")


def mark(
    docs: DataFrame,
    keep: Keep = F.max,
    normalise: Callable[[Column], Column] = lambda text: text,
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row; `keep` chooses the id (F.min or F.max)."""
    texts = docs.select("doc_id", F.coalesce(normalise(F.col("text")), F.lit("")).alias("text"))
    rows = texts.select("doc_id", hashed(F.col("text")).alias("key"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
    # Repeated rows count once here and come back by number: only the first of them can stay.
    repeated = rows.groupBy("doc_id", "key", "text_sha256").agg(F.count(F.lit(1)).alias("copies"))
    # Written, so that both sides of the join are plain exchanges, whose large partitions Spark can split.
    joined = repeated.join(written(classes(texts, keep, hashed)), ["key", "text_sha256"])
    return joined.select("doc_id", "keep_id", "group_size", "text_sha256", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy")).select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256"
    )


def one_of_each(docs: DataFrame, keep: Keep = F.max) -> DataFrame:
    """The rows of documents that stay, with all their columns; rows without an id all stay."""
    gone = mark(docs, keep).filter(F.col("doc_id") != F.col("keep_id")).select("doc_id", "text_sha256").distinct()
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    names = docs.columns
    left = docs.select(F.struct(*names).alias("row"), F.col("doc_id"), digest.alias("text_sha256"))
    once = left.join(gone, ["doc_id", "text_sha256"], "left_anti")
    identified = once.filter(F.col("doc_id").isNotNull()).groupBy("doc_id", "text_sha256").agg(F.first("row").alias("row")).select("row.*")
    return identified.unionByName(once.filter(F.col("doc_id").isNull()).select("row.*"))
