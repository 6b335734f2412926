"""Map features: way geometry, output routing, counters and cuisine tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dishframe.functions import poi
from dishframe.functions.text import display_label, present
from dishframe.operators.skew import Heavy, salted_lookup


def resolve_refs(
    refs: DataFrame,
    nodes: DataFrame,
    ref: str = "ref",
    spread: Sequence[str] = ("way_id", "pos"),
    heavy: Heavy = None,
) -> DataFrame:
    """Left join of way references to node coordinates; a node shared by very many ways is salted.

    refs: (way_id, pos, <ref>), nodes: (<ref>, lat, lon) unique on <ref>. Order is kept in pos,
    a repeated closing node stays.
    """
    known = nodes.withColumn("_known", F.lit(True))
    return (
        salted_lookup(refs, known, [ref], spread, heavy=heavy)
        .withColumn("missing", F.col("_known").isNull())
        .drop("_known")
    )


def way_summary(resolved: DataFrame, way: str = "way_id") -> DataFrame:
    """Per way: reference and missing counts and the mean vertex (NULL without vertices)."""
    return resolved.groupBy(way).agg(
        F.count(F.lit(1)).alias("n_refs"),
        F.count_if("missing").alias("n_missing"),
        F.avg("lat").alias("lat"),
        F.avg("lon").alias("lon"),
    )


def way_records(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nested way records for the sink. A map way is limited to 2,000 nodes by its source."""
    refs = ways.select("id", F.posexplode("node_refs").alias("pos", "ref"))
    resolved = resolve_refs(refs, nodes.select(F.col("id").alias("ref"), "lat", "lon"), "ref", ("id", "pos"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "ref", "lat", "lon", "missing")))
    shapes = resolved.groupBy("id").agg(ordered.alias("_refs"))
    found = F.filter("_refs", lambda r: ~r["missing"])
    lost = F.filter("_refs", lambda r: r["missing"])
    geometry = F.coalesce(
        F.transform(found, lambda r: F.struct(r["lat"].alias("lat"), r["lon"].alias("lon"))),
        F.array().cast("array<struct<lat:double,lon:double>>"),
    )
    missing = F.transform(lost, lambda r: r["ref"])
    return (
        ways.join(shapes, "id", "left")
        .withColumn("type", F.lit("way"))
        .withColumn("geometry", geometry)
        .withColumn("centroid", poi.mean_point(F.col("geometry")))
        .withColumn("missing_node_refs", F.when(F.size(missing) > 0, missing))
        .drop("_refs")
    )


def with_routes(features: DataFrame, tags: str = "tags") -> DataFrame:
    """Array of the outputs a feature belongs to; outputs may overlap."""
    t = F.col(tags)
    return features.withColumn(
        "routes",
        F.array_compact(
            F.array(
                F.when(poi.is_restaurant(t), F.lit("restaurants")),
                F.when(poi.shop_has(t, "kitchen"), F.lit("kitchens")),
                F.when(poi.shop_has(t, "dairy"), F.lit("dairies")),
            )
        ),
    )


def matched(records: DataFrame, keys: Sequence[str], match: Column) -> DataFrame:
    """Records with a match, its fields as columns; the match is evaluated once per record."""
    return records.select(*keys, F.inline(F.array_compact(F.array(match))))


def feature_counters(features: DataFrame) -> DataFrame:
    """All extraction counters in one pass over (type, tags, missing_node_refs, lat).

    The tests on the tags are evaluated once per feature, before the counting.
    """
    t = F.col("tags")
    tested = F.struct(
        poi.is_restaurant(t).alias("restaurant"),
        poi.split_tokens(poi.tag(t, "shop")).alias("shops"),
        *[F.map_contains_key(t, k).alias(k) for k in ("amenity", "cuisine", "diet")],
    )
    features = features.select("type", "lat", F.size("missing_node_refs").alias("missing"), F.inline(F.array(tested)))
    is_node, is_way = F.col("type") == "node", F.col("type") == "way"
    placed = is_way | F.col("lat").isNotNull()
    kept = F.col("restaurant") & placed
    no_amenity = ~F.col("amenity")
    shop_has = lambda token: F.array_contains("shops", token)
    tests = {
        "nodes_seen": is_node,
        "ways_seen": is_way,
        "restaurant_nodes": kept & is_node,
        "restaurant_ways": kept & is_way,
        "restaurant_ways_with_missing_nodes": kept & is_way & (F.col("missing") > 0),
        "cuisine_with_no_amenity": kept & F.col("cuisine") & no_amenity,
        "diet_with_no_amenity": kept & F.col("diet") & no_amenity,
        "kitchen_nodes_for_review": shop_has("kitchen") & placed & is_node,
        "kitchen_ways_for_review": shop_has("kitchen") & is_way,
        "dairy_nodes_for_review": shop_has("dairy") & placed & is_node,
        "dairy_ways_for_review": shop_has("dairy") & is_way,
        "records_written": kept,
    }
    return features.agg(*[F.count_if(test).alias(name) for name, test in tests.items()])


def token_counts(df: DataFrame, tokens: Column, token: str = "token", n: str = "n") -> DataFrame:
    """Token frequencies, most frequent first, then by token."""
    return (
        df.select(F.explode(tokens).alias(token))
        .groupBy(token)
        .agg(F.count(F.lit(1)).alias(n))
        .orderBy(F.desc(n), F.asc(token))
    )


def tag_value_counts(features: DataFrame, keys: Sequence[str] = ("amenity", "shop")) -> DataFrame:
    """(kind, value, n) of the ';'-list values of several tags in one pass."""
    kinds = F.array(
        *[F.struct(F.lit(k).alias("kind"), poi.split_tokens(poi.tag(F.col("tags"), k)).alias("values")) for k in keys]
    )
    return (
        features.select(F.inline(kinds))
        .select("kind", F.explode("values").alias("value"))
        .groupBy("kind", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("kind", F.desc("n"), "value")
    )


def with_cuisine_facts(records: DataFrame) -> DataFrame:
    t = F.col("tags")
    return (
        records.filter(t.isNotNull())
        .withColumn("cuisines", poi.cuisines(t))
        .withColumn("diets", poi.diets(t))
        .withColumn("label", present(poi.display_name(t, F.col("type"), F.col("id"))))
        .withColumn("raw_name", present(poi.tag(t, "name")))
    )


def cuisine_counts(facts: DataFrame) -> DataFrame:
    """(kind, value, n): cuisines count repeats inside a record, diets once per record."""
    kinds = F.array(
        F.struct(F.lit("cuisine").alias("kind"), F.col("cuisines").alias("values")),
        F.struct(F.lit("diet").alias("kind"), F.col("diets").alias("values")),
    )
    return (
        facts.select(F.inline(kinds))
        .select("kind", F.explode("values").alias("value"))
        .groupBy("kind", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("kind", "value")
    )


def cuisine_summary(facts: DataFrame) -> DataFrame:
    has_cuisine, named = F.size("cuisines") > 0, F.col("label").isNotNull()
    return facts.agg(
        F.count(F.lit(1)).alias("records_read"),
        F.count_if(has_cuisine).alias("records_with_cuisine"),
        F.count_if(F.size("diets") > 0).alias("records_with_diet"),
        F.count_if(has_cuisine & named).alias("records_with_name_and_cuisine"),
        F.count_if(~has_cuisine & named).alias("records_with_unknown_cuisine"),
        F.count_if(F.col("raw_name").isNull()).alias("records_without_name"),
    )


def cuisine_lines(facts: DataFrame) -> DataFrame:
    """'Name (Label; Label)' for records with cuisines."""
    labels = F.array_join(F.transform("cuisines", display_label), "; ")
    return facts.filter((F.size("cuisines") > 0) & F.col("label").isNotNull()).select(
        F.concat("label", F.lit(" ("), labels, F.lit(")")).alias("value")
    )


def unknown_cuisine_names(facts: DataFrame) -> DataFrame:
    return facts.filter((F.size("cuisines") == 0) & F.col("label").isNotNull()).select(F.col("label").alias("value"))
