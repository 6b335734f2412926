"""Repeated content, repeated results, repeated snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dishframe.functions.text import collapse
from dishframe.operators.folding import keep_first, keep_last
from dishframe.operators.ranking import group_index
from dishframe.operators.skew import Heavy, salted_lookup


def content_hash(text: Column) -> Column:
    """SHA-256 of the whitespace-collapsed lower-case text; a missing text counts as empty.

    Not nullable, so no join adds a null test that would hash every text a second time.
    """
    return F.coalesce(F.sha2(F.lower(collapse(F.coalesce(text, F.lit("")))), 256), F.lit(""))


def markup_hash(markup: Column) -> Column:
    """Short digest of a markup block as it stands."""
    return F.substring(F.sha2(markup, 256), 1, 16)


def content_groups(df: DataFrame, key: Column, order: str) -> DataFrame:
    """One row per distinct content: its first occurrence and the number of copies."""
    return keep_first(df.withColumn("content_key", key), ["content_key"], [order], count="n_copies")


def content_sources(
    df: DataFrame, key: Column, order: str, source: str, heavy: Heavy = None
) -> DataFrame:
    """Every occurrence with the first one it repeats: the long form of a source list.

    The first occurrences combine before their exchange; the join's large partitions are split by
    adaptive execution, so a content copied into a third of all pages stays spread over many tasks.
    """
    keyed = df.select(order, source, key.alias("content_key"))
    first = keyed.groupBy("content_key").agg(F.min(order).alias("kept"))
    return salted_lookup(keyed, first, ["content_key"], [order], "inner", heavy).select("kept", order, source)


def line_dedupe(lines: DataFrame, page: Sequence[str], line: str = "line", position: str = "line_no") -> DataFrame:
    """Lines of each page without later repeats, ignoring case; the first spelling stays."""
    keyed = lines.withColumn("_key", F.lower(line))
    return keep_first(keyed, [*page, "_key"], [position]).drop("_key")


def item_dedupe(items: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Exact dedupe on (name, description, price as JSON), first kept."""
    price = F.coalesce(F.to_json(F.struct("price")), F.lit("null"))
    staged = items.withColumn("_d", F.coalesce("description", F.lit(""))).withColumn("_p", price)
    return keep_first(staged, [*keys, "name", "_d", "_p"], order).drop("_d", "_p")


def result_dedupe(results: DataFrame, query: Sequence[str], key: Sequence[str], lead: str, partitions: int | None = None) -> DataFrame:
    """First result per (query, key), renumbered over all pages of the query."""
    first = keep_first(results, [*query, *key], [lead])
    return group_index(first, query, [lead, *key], "index", partitions)


def latest_wins(snapshots: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last state of each key over repeated snapshots."""
    return keep_last(snapshots, keys, order)
