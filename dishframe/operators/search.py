"""Dish-level search over menu items. These follow the product description, not existing code."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dishframe.functions.text import dish_key, name_tokens
from dishframe.operators.folding import keep_first
from dishframe.operators.skew import Heavy, salted_lookup

EARTH_KM = 6371.0


def dish_search(items: DataFrame, query: str, name: str, max_distance: int = 2, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Items whose name holds every query token, or lies within an edit distance of the query."""
    key = dish_key(F.col(name), aliases=aliases)
    wanted = sorted({w for w in query.lower().split() if len(w) > 2})
    words = name_tokens(F.col("dish_key"), stopwords=())
    distance = F.levenshtein("dish_key", F.lit(query.lower()))
    exact = F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in wanted]))) == len(wanted)
    return (
        items.withColumn("dish_key", key)
        .withColumn("distance", distance)
        .withColumn("exact", exact)
        .filter(F.col("exact") | (F.col("distance") <= max_distance))
    )


def ingredient_filter(items: DataFrame, tokens: Column, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Items that hold every wanted and no unwanted ingredient."""
    kept = items
    for word in include:
        kept = kept.filter(F.array_contains(tokens, word))
    for word in exclude:
        kept = kept.filter(~F.array_contains(tokens, word))
    return kept


def haversine_km(lat: Column, lon: Column, to_lat: Column, to_lon: Column) -> Column:
    half = lambda a, b: F.sin(F.radians(b - a) / 2)
    h = half(lat, to_lat) ** 2 + F.cos(F.radians(lat)) * F.cos(F.radians(to_lat)) * half(lon, to_lon) ** 2
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(h))


def result_rows(
    items: DataFrame, places: DataFrame, ratings: DataFrame, place: str, spread: Sequence[str], lat: float, lon: float,
    heavy: Heavy = None,
) -> DataFrame:
    """Dish rows with place, rating and distance. places and ratings are unique on the place."""
    facts = places.join(ratings, place, "left").withColumn(
        "distance_km", haversine_km(F.lit(lat), F.lit(lon), F.col("lat"), F.col("lon"))
    )
    return salted_lookup(items, facts, [place], spread, "inner", heavy=heavy)


def source_confidence(n_ratings: Column, prior: float = 10.0) -> Column:
    """Between 0 (no rating) and 1: the weight of a source's ratings beside a prior of that many."""
    n = F.coalesce(n_ratings, F.lit(0))
    return F.round(n / (n + prior), 3)


KM_PER_DEGREE = 2 * math.pi * EARTH_KM / 360


def around(places: DataFrame, lat: float, lon: float, km: float) -> DataFrame:
    """Places in the box of cells that holds the circle: plain comparisons, so the scan can skip the rest."""
    tall = km / KM_PER_DEGREE
    near = places.filter(F.col("lat").between(lat - tall, lat + tall))
    if abs(lat) + tall >= 89.9:
        return near
    # The circle is widest where it comes nearest to a pole.
    wide = math.degrees(math.asin(min(1.0, math.sin(min(math.pi / 2, km / EARTH_KM)) / math.cos(math.radians(lat))))) + 1e-9
    if math.sin(km / EARTH_KM) >= math.cos(math.radians(lat)) or lon - wide < -180 or lon + wide > 180:
        return near
    return near.filter(F.col("lon").between(lon - wide, lon + wide))


def nearest_items(
    items: DataFrame, places: DataFrame, ratings: DataFrame, place: str, spread: Sequence[str], lat: float, lon: float, k: int, order: Sequence[str],
    digits: int = 4, start_km: float = 1.0,
) -> DataFrame:
    """The k result rows nearest to a point, by rounded distance and then `order`.

    Rings grow until the circle holds k rows, so only places (and items) near the point are joined; the
    last ring reaches round the earth.
    """
    km = start_km
    while True:
        whole = km >= math.pi * EARTH_KM
        ring = places if whole else around(places, lat, lon, km)
        rows = result_rows(items, ring, ratings, place, spread, lat, lon).withColumn("distance_km", F.round("distance_km", digits))
        # A place outside the ring is farther than its radius.
        inside = rows if whole else rows.filter(F.col("distance_km") < km - 10.0**-digits)
        if whole or inside.limit(k).count() == k:
            return inside.orderBy("distance_km", *order).limit(k)
        km *= 4


def source_priority(rows: DataFrame, keys: Sequence[str], source: str, captured: str, ranks: Mapping[str, int], tie: str) -> DataFrame:
    """One row per key: best-ranked source, then the freshest capture."""
    pairs = [F.lit(part) for pair in ranks.items() for part in pair]
    rank = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(source)), F.lit(len(ranks) + 1))
    fresh = -F.unix_micros(F.col(captured).cast("timestamp"))
    return keep_first(rows.withColumn("source_rank", rank), keys, ["source_rank", fresh.alias("_fresh"), tie])


def composite_rating(ratings: DataFrame, place: Sequence[str], rating: str, votes: str) -> DataFrame:
    """Average over providers weighted by their number of reviews."""
    weighted = F.sum(F.col(rating) * F.col(votes)) / F.sum(votes)
    return ratings.groupBy(*place).agg(
        weighted.alias("composite_rating"), F.sum(votes).alias("total_votes"), F.count(F.lit(1)).alias("n_providers")
    )


def recent_or_older(
    photos: DataFrame, place: Sequence[str], age_days: Column, spread: Sequence[str], recent: int = 730, older: int = 1461,
    heavy: Heavy = None,
) -> DataFrame:
    """Photos up to two years old; for a place without any, those up to four years old."""
    aged = photos.withColumn("age_days", age_days).filter(F.col("age_days") <= older)
    state = aged.groupBy(*place).agg(F.bool_or(F.col("age_days") <= recent).alias("_fresh"))
    known = salted_lookup(aged, state, place, spread, "inner", heavy)
    return known.filter(~F.col("_fresh") | (F.col("age_days") <= recent)).drop("_fresh")


def alias_lookup(items: DataFrame, aliases: DataFrame, key: str, spread: Sequence[str], heavy: Heavy = None) -> DataFrame:
    """Canonical dish of each key from an alias table (key, canonical); unknown keys stay."""
    return salted_lookup(items, aliases, [key], spread, heavy=heavy).withColumn(
        "canonical", F.coalesce("canonical", F.col(key))
    )


def phrase_filter(reviews: DataFrame, place: Sequence[str], text: str, wanted: str, unwanted: str) -> DataFrame:
    """Places whose reviews mention a wanted phrase and never an unwanted one."""
    return (
        reviews.groupBy(*place)
        .agg(F.count_if(F.col(text).rlike(wanted)).alias("n_wanted"), F.count_if(F.col(text).rlike(unwanted)).alias("n_unwanted"))
        .filter((F.col("n_wanted") > 0) & (F.col("n_unwanted") == 0))
    )


def place_histogram(rows: DataFrame, place: Sequence[str], low: float, high: float, bins: int) -> DataFrame:
    """How many places fall into each band of row counts."""
    counts = rows.groupBy(*place).agg(F.count(F.lit(1)).alias("n"))
    return (
        counts.select(F.width_bucket(F.col("n").cast("double"), F.lit(low), F.lit(high), F.lit(bins)).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n_places"))
    )


def price_outliers(
    items: DataFrame, category: Sequence[str], price: str, spread: Sequence[str], z: float, heavy: Heavy = None
) -> DataFrame:
    """Items whose price lies z standard deviations from their category's mean."""
    stats = items.groupBy(*category).agg(F.avg(price).alias("mean"), F.stddev_pop(price).alias("deviation"))
    joined = salted_lookup(items, stats, category, spread, "inner", heavy)
    return joined.withColumn("z", (F.col(price) - F.col("mean")) / F.nullif(F.col("deviation"), F.lit(0.0))).filter(
        F.abs("z") >= z
    )


def photo_ratio(places: DataFrame, photos: str, reviews: str) -> DataFrame:
    return places.withColumn("photo_ratio", F.col(photos) / F.nullif(F.col(reviews), F.lit(0)))
