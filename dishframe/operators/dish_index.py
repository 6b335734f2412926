"""Inverted index of dish names: exact token matches and names within an edit distance, without comparing
a query with every row.

A name is listed under each of its tokens and under every text that is left when up to two of its letters
are deleted. Two names within two edits share such a text, so a query reads only the postings of its own
tokens and deletions; `levenshtein` then decides. Names are distinct texts, so a dish that fills a
third of all rows is indexed once. The index is written sorted by key: the key filter skips row groups.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from dishframe.functions.text import dish_key, name_tokens
from dishframe.session import written

MOST_EDITS = 2


def _without_one(text: Column) -> Column:
    """All texts with one letter less; none for an empty text."""
    places = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.concat(F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1)))


def deletions(text: Column, edits: int = MOST_EDITS) -> Column:
    """The text and all texts left by up to `edits` deletions, distinct."""
    level = F.array(text)
    every = level
    for _ in range(edits):
        level = F.array_distinct(F.flatten(F.transform(level, _without_one)))
        every = F.array_distinct(F.concat(every, level))
    return every


def _without(text: str, edits: int) -> set[str]:
    every = level = {text}
    for _ in range(edits):
        level = {t[:i] + t[i + 1 :] for t in level for i in range(len(t))}
        every = every | level
    return every


def build(items: DataFrame, name: str, aliases: Mapping[str, str] | None = None, edits: int = MOST_EDITS) -> DataFrame:
    """(posting, dish_key, n_items): one row per key of every distinct name, sorted by posting."""
    names = items.select(dish_key(F.col(name), aliases=aliases).alias("dish_key")).filter("dish_key is not null").groupBy("dish_key").agg(
        F.count(F.lit(1)).alias("n_items")
    )
    token = lambda words: F.transform(words, lambda w: F.concat(F.lit("t "), w))
    edit = lambda texts: F.transform(texts, lambda t: F.concat(F.lit("d "), t))
    keys = F.concat(token(name_tokens(F.col("dish_key"), stopwords=())), edit(deletions(F.col("dish_key"), edits)))
    listed = names.select(F.explode(F.array_distinct(keys)).alias("posting"), "dish_key", "n_items")
    return written(listed.repartitionByRange("posting").sortWithinPartitions("posting", "dish_key"))


def document_frequency(index: DataFrame, words: list[str]) -> DataFrame:
    """(word, n_names, n_items) of the given tokens."""
    return index.filter(F.col("posting").isin([f"t {w}" for w in words])).groupBy(F.substr("posting", F.lit(3)).alias("word")).agg(
        F.count(F.lit(1)).alias("n_names"), F.sum("n_items").alias("n_items")
    )


def search(index: DataFrame, query: str, max_distance: int = MOST_EDITS, edits: int = MOST_EDITS) -> DataFrame:
    """(dish_key, distance, exact) of the names that hold every query token, or lie within the distance."""
    if max_distance > edits:
        raise ValueError("the index holds fewer deletions than the distance asks for")
    key = " ".join(query.lower().split())
    wanted = sorted({w for w in key.split() if len(w) > 2})
    near = index.filter(F.col("posting").isin([f"d {t}" for t in sorted(_without(key, edits))])).select("dish_key").distinct()
    held = index.filter(F.col("posting").isin([f"t {w}" for w in wanted])).groupBy("dish_key").agg(F.count(F.lit(1)).alias("n"))
    exact = held.filter(F.col("n") == len(wanted)).select("dish_key", F.lit(True).alias("exact"))
    distance = F.levenshtein("dish_key", F.lit(key))
    found = near.filter(distance <= max_distance).join(exact, "dish_key", "full") if wanted else near.filter(distance <= max_distance).withColumn("exact", F.lit(False))
    return found.select("dish_key", distance.alias("distance"), F.coalesce("exact", F.lit(False)).alias("exact"))


def matching_items(items: DataFrame, index: DataFrame, query: str, name: str, aliases: Mapping[str, str] | None = None, max_distance: int = MOST_EDITS) -> DataFrame:
    """The items of the names that the search finds, with dish_key, distance and exact."""
    keyed = items.withColumn("dish_key", dish_key(F.col(name), aliases=aliases))
    return keyed.join(search(index, query, max_distance), "dish_key")
