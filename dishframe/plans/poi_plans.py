"""Map-feature queries. Parts stand in for features, orders and their lines for ways."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dishframe.functions import poi as fn
from dishframe.functions.text import present, split_tokens
from dishframe.operators import poi
from dishframe.plans.tables import Catalog, table

catalog = Catalog()

# The same derived features in SQL: one row per part, NULL for an absent tag.
FEATURES_SQL = """
feature AS (
  SELECT p_partkey AS id,
    CASE WHEN p_size > 25 THEN 'way' ELSE 'node' END AS type,
    CASE WHEN p_size > 1 THEN p_retailprice END AS lat,
    p_size > 45 AS has_missing,
    p_name AS name,
    CASE split_part(p_name, ' ', 2) WHEN 'ring' THEN 'restaurant' WHEN 'bolt' THEN ' Bar ;pharmacy'
      WHEN 'anvil' THEN 'bank' WHEN 'rod' THEN 'bank;;ice_cream' END AS amenity,
    CASE p_type WHEN 'STANDARD' THEN 'bakery' WHEN 'LARGE' THEN 'kitchen;tiles' WHEN 'SMALL' THEN 'dairy'
      WHEN 'PROMO' THEN 'Car' END AS shop,
    CASE WHEN p_brand = 'Brand#7' THEN 'yes' WHEN p_brand = 'Brand#8' THEN 'no' END AS food,
    CASE WHEN p_size < 8 THEN 'mexican; tex-mex ;mexican' WHEN p_size = 30 THEN 'ice_cream' END AS cuisine,
    CASE WHEN p_brand = 'Brand#3' THEN 'vegan' END AS diet_before,
    CASE WHEN p_brand IN ('Brand#3', 'Brand#4', 'Brand#5') THEN CASE WHEN p_size > 20 THEN 'Yes' ELSE 'no' END END AS diet_halal,
    CASE WHEN p_brand = 'Brand#5' THEN ' Kosher' END AS diet_after
  FROM part
), tagged AS (
  SELECT *, CASE WHEN diet_after IS NOT NULL THEN diet_after WHEN diet_halal IS NOT NULL THEN 'subtype'
      ELSE diet_before END AS diet,
    list_filter(list_transform(string_split(coalesce(amenity, ''), ';'), lambda x: lower(trim(x))), lambda x: x <> '') AS amenities,
    list_filter(list_transform(string_split(coalesce(shop, ''), ';'), lambda x: lower(trim(x))), lambda x: x <> '') AS shops,
    list_filter(list_transform(string_split(coalesce(cuisine, ''), ';'), lambda x: lower(trim(x))), lambda x: x <> '') AS cuisines
  FROM feature
), judged AS (
  SELECT *,
    (list_has_any(amenities, ['restaurant','fast_food','bar','biergarten','cafe','pub','ice_cream','canteen'])
      OR list_has_any(shops, ['restaurant','fast_food','bakery','confectionery','coffee','chocolate','pastry','deli','tea','seafood'])
      OR coalesce(food = 'yes', false) OR cuisine IS NOT NULL OR diet IS NOT NULL) AS is_restaurant,
    list_contains(shops, 'kitchen') AS is_kitchen, list_contains(shops, 'dairy') AS is_dairy,
    list_sort(list_distinct(list_filter([
      CASE WHEN diet <> 'subtype' THEN lower(trim(diet)) END,
      CASE WHEN lower(diet_halal) = 'yes' THEN 'halal' END], lambda x: x IS NOT NULL))) AS diets
  FROM tagged
)
"""


def features(spark: SparkSession, sf: str) -> DataFrame:
    """Features with an ordered tag list, derived row by row from the parts."""
    noun = F.element_at(F.split("p_name", " "), 2)
    size, brand, kind = F.col("p_size"), F.col("p_brand"), F.col("p_type")
    pair = lambda key, value: F.struct(F.lit(key).alias("_k"), value.alias("_v"))
    tags = F.filter(
        F.array(
            pair("name", F.col("p_name")),
            pair(
                "amenity",
                F.when(noun == "ring", "restaurant").when(noun == "bolt", " Bar ;pharmacy")
                .when(noun == "anvil", "bank").when(noun == "rod", "bank;;ice_cream"),
            ),
            pair(
                "shop",
                F.when(kind == "STANDARD", "bakery").when(kind == "LARGE", "kitchen;tiles")
                .when(kind == "SMALL", "dairy").when(kind == "PROMO", "Car"),
            ),
            pair("food", F.when(brand == "Brand#7", "yes").when(brand == "Brand#8", "no")),
            pair("cuisine", F.when(size < 8, "mexican; tex-mex ;mexican").when(size == 30, "ice_cream")),
            pair("diet", F.when(brand == "Brand#3", "vegan")),
            pair(
                "diet:halal",
                F.when(brand.isin("Brand#3", "Brand#4", "Brand#5"), F.when(size > 20, "Yes").otherwise("no")),
            ),
            pair("diet", F.when(brand == "Brand#5", " Kosher")),
        ),
        lambda t: t["_v"].isNotNull(),
    )
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.when(size > 25, "way").otherwise("node").alias("type"),
        F.when(size > 1, F.col("p_retailprice")).alias("lat"),
        F.when(size > 45, F.array(F.lit("gone"))).alias("missing_node_refs"),
        fn.tag_map(tags).alias("tags"),
    )


@catalog.query(
    "SELECT token, count(*) AS n FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS token FROM part) GROUP BY token"
)
def token_counts(spark, sf):
    return poi.token_counts(table(spark, sf, "part"), split_tokens(F.col("p_name"), " "))


@catalog.query(f"WITH {FEATURES_SQL} SELECT id, is_restaurant, is_kitchen, is_dairy FROM judged")
def tag_predicate(spark, sf):
    t = F.col("tags")
    return features(spark, sf).select(
        "id",
        fn.is_restaurant(t).alias("is_restaurant"),
        fn.shop_has(t, "kitchen").alias("is_kitchen"),
        fn.shop_has(t, "dairy").alias("is_dairy"),
    )


@catalog.query(f"WITH {FEATURES_SQL} SELECT id, diet, len(diets) AS n_diets, array_to_string(diets, ';') AS diets FROM judged")
def derived_diet_tag(spark, sf):
    t = F.col("tags")
    return features(spark, sf).select(
        "id",
        fn.tag(t, "diet").alias("diet"),
        F.size(fn.diets(t)).cast("bigint").alias("n_diets"),
        F.array_join(fn.diets(t), ";").alias("diets"),
    )


@catalog.query(
    f"""WITH {FEATURES_SQL} SELECT id, route FROM (
      SELECT id, unnest(['restaurants', 'kitchens', 'dairies']) AS route,
        unnest([is_restaurant, is_kitchen, is_dairy]) AS goes FROM judged) WHERE goes"""
)
def route_features(spark, sf):
    return poi.with_routes(features(spark, sf)).select("id", F.explode("routes").alias("route"))


@catalog.query(
    f"""WITH {FEATURES_SQL}, flagged AS (
      SELECT *, is_restaurant AND (type = 'way' OR lat IS NOT NULL) AS kept, type = 'way' OR lat IS NOT NULL AS placed FROM judged)
    SELECT count(*) FILTER (type = 'node') AS nodes_seen, count(*) FILTER (type = 'way') AS ways_seen,
      count(*) FILTER (kept AND type = 'node') AS restaurant_nodes, count(*) FILTER (kept AND type = 'way') AS restaurant_ways,
      count(*) FILTER (kept AND type = 'way' AND has_missing) AS restaurant_ways_with_missing_nodes,
      count(*) FILTER (kept AND cuisine IS NOT NULL AND amenity IS NULL) AS cuisine_with_no_amenity,
      count(*) FILTER (kept AND diet IS NOT NULL AND amenity IS NULL) AS diet_with_no_amenity,
      count(*) FILTER (is_kitchen AND placed AND type = 'node') AS kitchen_nodes_for_review,
      count(*) FILTER (is_kitchen AND type = 'way') AS kitchen_ways_for_review,
      count(*) FILTER (is_dairy AND placed AND type = 'node') AS dairy_nodes_for_review,
      count(*) FILTER (is_dairy AND type = 'way') AS dairy_ways_for_review,
      count(*) FILTER (kept) AS records_written FROM flagged"""
)
def conditional_counters(spark, sf):
    return poi.feature_counters(features(spark, sf))


@catalog.query(
    f"""WITH {FEATURES_SQL} SELECT kind, value, count(*) AS n FROM (
      SELECT 'amenity' AS kind, unnest(amenities) AS value FROM judged UNION ALL
      SELECT 'shop' AS kind, unnest(shops) AS value FROM judged) GROUP BY kind, value"""
)
def tag_value_counts(spark, sf):
    return poi.tag_value_counts(features(spark, sf))


@catalog.query(
    f"""WITH {FEATURES_SQL} SELECT kind, value, count(*) AS n FROM (
      SELECT 'cuisine' AS kind, unnest(cuisines) AS value FROM judged UNION ALL
      SELECT 'diet' AS kind, unnest(diets) AS value FROM judged) GROUP BY kind, value"""
)
def cuisine_counts(spark, sf):
    return poi.cuisine_counts(poi.with_cuisine_facts(features(spark, sf)))


@catalog.query(
    f"""WITH {FEATURES_SQL} SELECT count(*) AS records_read, count(*) FILTER (len(cuisines) > 0) AS records_with_cuisine,
      count(*) FILTER (len(diets) > 0) AS records_with_diet,
      count(*) FILTER (len(cuisines) > 0 AND name IS NOT NULL) AS records_with_name_and_cuisine,
      count(*) FILTER (len(cuisines) = 0 AND name IS NOT NULL) AS records_with_unknown_cuisine,
      count(*) FILTER (name IS NULL) AS records_without_name FROM judged"""
)
def cuisine_summary(spark, sf):
    return poi.cuisine_summary(poi.with_cuisine_facts(features(spark, sf)))


@catalog.query(
    f"""WITH {FEATURES_SQL} SELECT CASE WHEN len(cuisines) > 0 THEN name || ' (' || array_to_string(list_transform(cuisines,
        lambda c: CASE c WHEN 'mexican' THEN 'Mexican' WHEN 'tex-mex' THEN 'Tex-Mex' WHEN 'ice_cream' THEN 'Ice Cream' END), '; ') || ')'
      ELSE name END AS value, len(cuisines) > 0 AS known FROM judged"""
)
def name_lists(spark, sf):
    facts = poi.with_cuisine_facts(features(spark, sf))
    known = poi.cuisine_lines(facts).withColumn("known", F.lit(True))
    return known.unionByName(poi.unknown_cuisine_names(facts).withColumn("known", F.lit(False)))


HINTS = ("anvil", "blue", "gear", "old", "ring")


@catalog.query(
    """SELECT p_partkey, len(hits) > 0 AS possible_restaurant, array_to_string(hits, ',') AS matched_hints FROM (
      SELECT p_partkey, list_filter(['anvil','blue','gear','old','ring'], lambda h: contains(lower(p_name), h)) AS hits FROM part)"""
)
def hint_annotation(spark, sf):
    review = fn.hint_review(F.col("p_name"), HINTS)
    return (
        table(spark, sf, "part")
        .select("p_partkey", review.alias("r"))
        .select("p_partkey", "r.possible_restaurant", F.array_join("r.matched_hints", ",").alias("matched_hints"))
    )


STRONG = {
    "license": r"(?i)license|copyright",
    "contact": r"(?i)[a-z0-9]@[a-z0-9]",
    "review": r"(?i)review|rating",
}
WEAK = {"number": r"[0-9]{2}", "shouting": r"[A-Z]{6}"}


@catalog.query(
    r"""WITH hit AS (SELECT doc_id, lang,
        list_filter([CASE WHEN lang = 'es' THEN 'lang=es' END,
          CASE WHEN regexp_matches(text, '(?i)license|copyright') THEN 'name/url keyword: license' END,
          CASE WHEN regexp_matches(text, '(?i)[a-z0-9]@[a-z0-9]') THEN 'name/url keyword: contact' END,
          CASE WHEN regexp_matches(text, '(?i)review|rating') THEN 'name/url keyword: review' END], lambda r: r IS NOT NULL) AS sure,
        list_filter([CASE WHEN regexp_matches(text, '[0-9]{2}') THEN 'name/url looks Mexican: number' END,
          CASE WHEN regexp_matches(text, '[A-Z]{6}') THEN 'name/url looks Mexican: shouting' END], lambda r: r IS NOT NULL) AS maybe
      FROM documents)
    SELECT doc_id, CASE WHEN len(sure) > 0 THEN 'high' ELSE 'likely' END AS confidence,
      array_to_string(list_sort(CASE WHEN len(sure) > 0 THEN sure ELSE maybe END), '; ') AS reasons
    FROM hit WHERE len(sure) > 0 OR len(maybe) > 0"""
)
def tiered_match(spark, sf):
    match = fn.tiered_match(F.col("text"), STRONG, WEAK, {"lang=es": F.col("lang") == "es"})
    documents = table(spark, sf, "documents").select("doc_id", "lang", "text")
    return poi.matched(documents, ["doc_id"], match).select(
        "doc_id", "confidence", F.array_join("reasons", "; ").alias("reasons")
    )


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    refs = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("way_id"), F.col("l_linenumber").alias("pos"), "l_suppkey", F.col("l_partkey").alias("ref")
    )
    nodes = table(spark, sf, "part").filter("p_size <= 45").select(
        F.col("p_partkey").alias("ref"), F.col("p_size").cast("double").alias("lat"), F.col("p_retailprice").alias("lon")
    )
    return poi.resolve_refs(refs, nodes, "ref", ("way_id", "pos", "l_suppkey"))


@catalog.query(
    """SELECT l_orderkey AS way_id, l_linenumber AS pos, l_partkey AS ref, l_suppkey, p.p_size::DOUBLE AS lat,
      p.p_retailprice AS lon, p.p_partkey IS NULL AS missing
    FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size <= 45) p ON l_partkey = p.p_partkey"""
)
def ordered_ref_join(spark, sf):
    return _resolved(spark, sf)


@catalog.query(
    """SELECT o_orderkey AS way_id, count(l_orderkey) AS n_refs, count(*) FILTER (l_orderkey IS NOT NULL AND p.p_partkey IS NULL) AS n_missing,
      round(avg(p.p_size), 6) AS lat, round(avg(p.p_retailprice), 6) AS lon
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
      LEFT JOIN (SELECT * FROM part WHERE p_size <= 45) p ON l_partkey = p.p_partkey GROUP BY o_orderkey"""
)
def way_summary(spark, sf):
    ways = table(spark, sf, "orders").select(F.col("o_orderkey").alias("way_id"))
    summary = poi.way_summary(_resolved(spark, sf))
    return ways.join(summary, "way_id", "left").select(
        "way_id",
        F.coalesce("n_refs", F.lit(0)).alias("n_refs"),
        F.coalesce("n_missing", F.lit(0)).alias("n_missing"),
        F.round("lat", 6).alias("lat"),
        F.round("lon", 6).alias("lon"),
    )


@catalog.query(
    f"""WITH {FEATURES_SQL} SELECT id, trim(name) AS label, array_to_string(list_filter([name, CASE WHEN p_type = 'PROMO'
      THEN p_brand END], lambda x: x IS NOT NULL), ' ') AS search_text
    FROM judged JOIN part ON id = p_partkey"""
)
def search_text(spark, sf):
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.lit("node").alias("type"),
        F.create_map(
            F.lit("name"), F.col("p_name"), F.lit("brand"), F.when(F.col("p_type") == "PROMO", F.col("p_brand")).otherwise("")
        ).alias("tags"),
    )
    return parts.select(
        "id",
        present(fn.display_name(F.col("tags"), F.col("type"), F.col("id"))).alias("label"),
        fn.search_text(F.col("tags")).alias("search_text"),
    )


@catalog.query(
    """SELECT c_custkey AS id, c_acctbal AS lat, 'node' AS type, 'Shop ' || c_mktsegment AS name, c_nationkey::VARCHAR AS version,
      CASE WHEN c_mktsegment = 'MACHINERY' THEN 'subtype' END AS diet FROM customer"""
)
def xml_elements(spark, sf):
    from dishframe import schemas

    element = F.concat(
        F.lit('<node id="'), F.col("c_custkey").cast("string"), F.lit('" lat="'), F.col("c_acctbal").cast("string"),
        F.lit('" version="'), F.col("c_nationkey").cast("string"), F.lit('"><tag k="name" v="Shop '), F.col("c_mktsegment"),
        F.lit('"/>'), F.when(F.col("c_mktsegment") == "MACHINERY", F.lit('<tag k="diet:halal" v="yes"/>')).otherwise(""),
        F.lit("</node>"),
    )
    parsed = table(spark, sf, "customer").select(F.from_xml(element, schemas.OSM_NODE, {"rowTag": "node"}).alias("n"))
    return parsed.select(
        F.col("n._id").cast("bigint").alias("id"),
        F.col("n._lat").alias("lat"),
        F.lit("node").alias("type"),
        F.col("n._version").alias("version"),
        fn.tag(fn.tag_map(F.col("n.tag")), "name").alias("name"),
        fn.tag(fn.tag_map(F.col("n.tag")), "diet").alias("diet"),
    )
