"""Dish-search queries: parts are dishes, suppliers and customers places, events reviews and photos."""

from __future__ import annotations

from pyspark.sql import functions as F

from dishframe.functions import text as tx
from dishframe.operators import dish_index, search
from dishframe.plans.tables import Catalog, table

catalog = Catalog()

LAT, LON = 42.2, -83.2


@catalog.query(
    """SELECT p_partkey, p_name AS dish_key, levenshtein(p_name, 'blue bold') AS distance, false AS exact FROM part WHERE levenshtein(p_name, 'blue bold') <= 2"""
)
def dish_search(spark, sf):
    return search.dish_search(table(spark, sf, "part"), "blue bold", "p_name").select(
        "p_partkey", "dish_key", F.col("distance").cast("bigint").alias("distance"), "exact"
    )


_INDEXED_SQL = """SELECT p_partkey, p_name AS dish_key, levenshtein(p_name, '{0}') AS distance, {1} AS exact FROM part WHERE levenshtein(p_name, '{0}') <= 2 OR {1}"""


def _indexed(spark, sf, query):
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    found = dish_index.matching_items(parts, dish_index.build(parts, "p_name"), query, "p_name")
    return found.select("p_partkey", "dish_key", F.col("distance").cast("bigint").alias("distance"), "exact")


@catalog.query(_INDEXED_SQL.format("ring hot", "(regexp_matches(p_name, '\\bring\\b') AND regexp_matches(p_name, '\\bhot\\b'))"))
def indexed_search(spark, sf):
    """Through the index: names that hold both words in any order, and near misses."""
    return _indexed(spark, sf, "ring hot")


@catalog.query(_INDEXED_SQL.format("col gear", "(regexp_matches(p_name, '\\bcol\\b') AND regexp_matches(p_name, '\\bgear\\b'))"))
def indexed_near_search(spark, sf):
    """Through the index: a misspelt query, found by shared deletions."""
    return _indexed(spark, sf, "col gear")


@catalog.query(
    """SELECT word, count(DISTINCT p_name) AS n_names, count(*) AS n_items FROM (SELECT p_name, unnest(list_distinct(string_split(p_name, ' '))) AS word FROM part)
    WHERE word IN ('ring', 'hot', 'unseen') GROUP BY word"""
)
def token_frequency(spark, sf):
    return dish_index.document_frequency(dish_index.build(table(spark, sf, "part"), "p_name"), ["ring", "hot", "unseen"])


@catalog.query("SELECT p_partkey, p_name FROM part WHERE (p_name LIKE '% ring') AND NOT p_name LIKE 'old %' AND NOT p_name LIKE 'hot %'")
def exclude_filter(spark, sf):
    items = table(spark, sf, "part").select("p_partkey", "p_name")
    return search.ingredient_filter(items, F.split("p_name", " "), include=["ring"], exclude=["old", "hot"])


PLACES_SQL = """place AS (SELECT s_suppkey, s_name, 42 + s_acctbal / 20000 AS lat, -83 - s_nationkey / 50.0 AS lon FROM supplier),
rated AS (SELECT user_id AS s_suppkey, sum(round(value * 100)::BIGINT)::BIGINT / (100.0 * count(*))::DOUBLE AS rating, count(*) AS n_ratings FROM events GROUP BY user_id),
located AS (SELECT *, 12742.0 * asin(sqrt(pow(sin(radians(lat - 42.2) / 2), 2) + cos(radians(42.2)) * cos(radians(lat)) * pow(sin(radians(lon + 83.2) / 2), 2))) AS km FROM place)"""


def _result_parts(spark, sf):
    places = table(spark, sf, "supplier").select(
        "s_suppkey", "s_name", (F.lit(42) + F.col("s_acctbal") / 20000).alias("lat"), (F.lit(-83) - F.col("s_nationkey") / F.lit(50.0)).alias("lon")
    )
    ratings = table(spark, sf, "events").groupBy(F.col("user_id").alias("s_suppkey")).agg(
        (F.sum(F.round(F.col("value") * 100).cast("bigint")) / (F.lit(100.0) * F.count(F.lit(1)))).alias("rating"), F.count(F.lit(1)).alias("n_ratings")
    )
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("s_suppkey"), "l_extendedprice")
    return items, places, ratings, "s_suppkey", ["l_orderkey", "l_linenumber", "l_partkey"], LAT, LON


@catalog.query(
    f"""WITH {PLACES_SQL} SELECT l_orderkey, l_linenumber, l_partkey, s_suppkey, s_name, l_extendedprice, rating, round(coalesce(n_ratings, 0) / (coalesce(n_ratings, 0) + 10), 3) AS source_confidence, round(km, 4) AS distance_km
    FROM lineitem JOIN located ON l_suppkey = s_suppkey LEFT JOIN rated USING (s_suppkey)"""
)
def result_rows(spark, sf):
    return search.result_rows(*_result_parts(spark, sf)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "s_suppkey", "s_name", "l_extendedprice", "rating",
        search.source_confidence(F.col("n_ratings")).alias("source_confidence"), F.round("distance_km", 4).alias("distance_km")
    )


@catalog.query(
    f"""WITH {PLACES_SQL} SELECT l_orderkey, l_linenumber, l_partkey, s_suppkey, round(km, 4) AS distance_km
    FROM lineitem JOIN located ON l_suppkey = s_suppkey ORDER BY round(km, 4), l_extendedprice, l_orderkey, l_linenumber, l_partkey LIMIT 25"""
)
def nearest_k(spark, sf):
    nearest = search.nearest_items(*_result_parts(spark, sf), k=25, order=["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"], start_km=4)
    return nearest.select("l_orderkey", "l_linenumber", "l_partkey", "s_suppkey", "distance_km")


@catalog.query(
    """SELECT user_id, event_type, value, event_id, source_rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY source_rank, ts DESC, event_id) AS rn
      FROM (SELECT *, CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 ELSE 3 END AS source_rank FROM events)) WHERE rn = 1"""
)
def source_priority(spark, sf):
    ranks = {"signup": 1, "purchase": 2}
    rows = table(spark, sf, "events").select("user_id", "event_type", "value", "event_id", "ts")
    return search.source_priority(rows, ["user_id"], "event_type", "ts", ranks, "event_id").drop("ts")


@catalog.query(
    """SELECT user_id, sum(rating * votes)::BIGINT / sum(votes)::BIGINT AS composite_rating, sum(votes)::BIGINT AS total_votes, count(*) AS n_providers
    FROM (SELECT user_id, event_type, floor(max(value))::BIGINT AS rating, count(*) AS votes FROM events GROUP BY ALL) GROUP BY user_id"""
)
def composite_rating(spark, sf):
    providers = table(spark, sf, "events").groupBy("user_id", "event_type").agg(
        F.floor(F.max("value")).alias("rating"), F.count(F.lit(1)).alias("votes")
    )
    return search.composite_rating(providers, ["user_id"], "rating", "votes")


@catalog.query(
    """WITH aged AS (SELECT o_custkey, o_orderkey, date_diff('day', o_orderdate::DATE, DATE '2001-06-01') AS age_days FROM orders),
      near AS (SELECT * FROM aged WHERE age_days <= 1461), fresh AS (SELECT DISTINCT o_custkey FROM near WHERE age_days <= 730)
    SELECT o_custkey, o_orderkey, age_days FROM near WHERE age_days <= 730 OR o_custkey NOT IN (SELECT o_custkey FROM fresh)"""
)
def recency_fallback(spark, sf):
    photos = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    age = F.date_diff(F.lit("2001-06-01").cast("date"), F.col("o_orderdate").cast("date")).cast("bigint")
    return search.recent_or_older(photos, ["o_custkey"], age, ["o_orderkey"]).drop("o_orderdate")


@catalog.query(
    """SELECT p_partkey, p_name AS dish, CASE split_part(p_name, ' ', 2) WHEN 'gizmo' THEN split_part(p_name, ' ', 1) || ' widget' ELSE p_name END AS canonical FROM part"""
)
def alias_lookup(spark, sf):
    items = table(spark, sf, "part").select("p_partkey", tx.dish_key(F.col("p_name")).alias("dish"))
    aliases = (
        items.select("dish").distinct().filter(F.col("dish").endswith(" gizmo"))
        .withColumn("canonical", F.regexp_replace("dish", " gizmo$", " widget"))
    )
    return search.alias_lookup(items, aliases, "dish", ["p_partkey"])


@catalog.query(
    """SELECT * FROM (SELECT source, count(*) FILTER (regexp_matches(text, '(?i)review|rating')) AS n_wanted, count(*) FILTER (regexp_matches(text, '@[a-z]')) AS n_unwanted
      FROM documents GROUP BY source) WHERE n_wanted > 0 AND n_unwanted = 0"""
)
def phrase_filter(spark, sf):
    return search.phrase_filter(table(spark, sf, "documents"), ["source"], "text", "(?i)review|rating", "@[a-z]")


@catalog.query(
    """SELECT CASE WHEN n < 20 THEN 0 WHEN n >= 120 THEN 11 ELSE 1 + (n - 20) // 10 END AS bucket, count(*) AS n_places
    FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) GROUP BY 1"""
)
def histogram(spark, sf):
    return search.place_histogram(table(spark, sf, "events"), ["user_id"], 20, 120, 10)


@catalog.query(
    """SELECT event_id, event_type, value FROM (SELECT *, avg(value) OVER (PARTITION BY event_type) AS m, stddev_pop(value) OVER (PARTITION BY event_type) AS d FROM events)
    WHERE abs((value - m) / d) >= 3"""
)
def price_outliers(spark, sf):
    items = table(spark, sf, "events").select("event_id", "event_type", "value")
    return search.price_outliers(items, ["event_type"], "value", ["event_id"], 3.0).select("event_id", "event_type", "value")


@catalog.query(
    """SELECT user_id, count(*) FILTER (event_type = 'view') / nullif(count(*) FILTER (event_type = 'signup'), 0) AS photo_ratio FROM events GROUP BY user_id"""
)
def photo_ratio(spark, sf):
    places = table(spark, sf, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "view").alias("photos"), F.count_if(F.col("event_type") == "signup").alias("reviews")
    )
    return search.photo_ratio(places, "photos", "reviews").select("user_id", "photo_ratio")
