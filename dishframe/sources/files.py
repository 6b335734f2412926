"""Readers of captured files. Each gives a flat or nested table with an explicit schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dishframe import schemas
from dishframe.functions import poi
from dishframe.functions.text import present, strip
from dishframe.sources.elements import SPLIT_BYTES, elements

MODEL_COMMENT = r"<!-- model: (.*?) -->"


def file_name() -> Column:
    return F.col("_metadata.file_name")


def file_stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def json_documents(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """One row per JSON file, with the file name as capture_id."""
    return spark.read.schema(schema).json(path, multiLine=True).select("*", file_name().alias("capture_id"))


def cards(documents: DataFrame, field: str = "result") -> DataFrame:
    """Cards of a capture with their position."""
    return documents.select("capture_id", F.posexplode(field).alias("pos", "_c")).select("capture_id", "pos", "_c.*")


def features(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Nodes and ways of a map extract in one scan; relations are left out.

    A reference without its attribute is left out; a coordinate that is no number is NULL; an element that is no XML has no fields.
    """
    found = elements(spark, path, ("node", "way"), split_bytes)
    parsed = found.select("kind", F.inline(F.array(F.from_xml("element", schemas.OSM_ELEMENT))))
    meta = F.struct(*[F.col(f"_{a}").alias(a) for a in ("version", "timestamp", "changeset", "uid", "user")])
    osm = F.when(F.coalesce("_version", "_timestamp", "_changeset", "_uid", "_user").isNotNull(), meta)
    tags = poi.tag_map(F.coalesce("tag", F.array().cast(schemas.TAG_PAIRS)))
    node, refs = F.col("kind") == "node", F.coalesce(F.transform("nd", lambda n: n["_ref"]), F.array().cast("array<string>"))
    return parsed.select(
        F.col("kind").alias("type"), F.col("_id").alias("id"), F.when(node, F.col("_lat").try_cast("double")).alias("lat"), F.when(node, F.col("_lon").try_cast("double")).alias("lon"),
        F.when(~node, F.filter(refs, lambda r: F.coalesce(r, F.lit("")) != "")).alias("node_refs"), tags.alias("tags"), osm.alias("osm"),
    )


def poi_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of map features; blank lines give no row, tags of a wrong shape are NULL."""
    return spark.read.schema(schemas.POI).json(path)


def harvest_entries(documents: DataFrame) -> DataFrame:
    """Entries of a harvest, or the single item page of a plain response."""
    entry = f"array<struct<{schemas.HARVEST_ITEM}>>"
    single = F.when(
        F.col("data.itemPage").isNotNull(),
        F.array(
            F.struct(
                F.lit(None).cast("string").alias("item_id"), F.lit("Uncategorized").alias("section"),
                F.lit(None).cast("string").alias("name"), F.lit(None).cast("int").alias("menu_position"),
                F.col("data.itemPage").alias("item_page"),
            )
        ).cast(entry),
    )
    return documents.select("capture_id", "source_url", F.posexplode(F.coalesce("items", single)).alias("pos", "_e")).select(
        "capture_id", "source_url", "pos", "_e.*"
    )


def first_of_type(scripts: DataFrame, key: Sequence[str], kind: str, script: str = "script", position: str = "pos") -> DataFrame:
    """First script document of a schema.org type per key."""
    typed = scripts.filter(F.get_json_object(script, "$['@type']") == kind)
    return typed.groupBy(*key).agg(F.min_by(script, position).alias("document"))


def as_objects(value: Column) -> Column:
    """JSON text of an object or a list of objects as an array of JSON texts."""
    trimmed = F.trim(value)
    many = F.from_json(trimmed, "array<string>")
    listed = F.when(trimmed.startswith("["), many).when(trimmed.startswith("{"), F.array(trimmed))
    inner = F.flatten(
        F.transform(
            listed,
            lambda v: F.when(F.trim(v).startswith("["), F.from_json(v, "array<string>")).otherwise(F.array(v)),
        )
    )
    return F.filter(inner, lambda v: F.trim(v).startswith("{"))


def offer_price(offers: Column) -> Column:
    """Price of an offers object; NULL for a list or a missing price."""
    return F.when(F.trim(offers).startswith("{"), F.get_json_object(offers, "$.price"))


def ld_menu_items(menus: DataFrame, key: Sequence[str], menu: str = "menu") -> DataFrame:
    """(key, section_no, section, item_no, name, description, price) of schema.org menus."""
    sections = menus.select(
        *key, F.posexplode(as_objects(F.get_json_object(menu, "$.hasMenuSection"))).alias("section_no", "_s")
    )
    named = sections.select(
        *key, "section_no", F.coalesce(F.get_json_object("_s", "$.name"), F.lit("")).alias("section"),
        F.posexplode(as_objects(F.get_json_object("_s", "$.hasMenuItem"))).alias("item_no", "_i"),
    )
    return named.select(
        *key, "section_no", "section", "item_no",
        F.get_json_object("_i", "$.name").alias("name"),
        F.coalesce(F.get_json_object("_i", "$.description"), F.lit("")).alias("description"),
        offer_price(F.get_json_object("_i", "$.offers")).alias("price"),
    )


def model_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, model, line_no, line) of rater output files; the model is named by a comment or the file."""
    whole = spark.read.text(path, wholetext=True).select(file_name().alias("file"), "value")
    named = F.coalesce(present(F.regexp_extract("value", MODEL_COMMENT, 1)), file_stem(F.col("file")))
    return whole.select("file", named.alias("model"), F.posexplode(F.split("value", r"\r\n|\n|\r")).alias("line_no", "line"))


def saved_pages(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(page_id, html) of saved pages, one row per file."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(file_stem(file_name()).alias("page_id"), F.col("value").alias("html"))


def model_catalog(documents: DataFrame) -> DataFrame:
    return documents.select(F.inline("models"))


def restaurants(records: DataFrame, order: str, limit: int) -> DataFrame:
    """First named restaurants with city and one-line address."""
    t = F.col("tags")
    named = F.coalesce(present(poi.tag(t, "name")), present(poi.tag(t, "official_name")))
    return (
        records.withColumn("name", named)
        .filter(F.col("name").isNotNull())
        .withColumn("city", F.coalesce(poi.tag(t, "addr:city"), F.lit("")))
        .withColumn("address", poi.address(t))
        .orderBy(order)
        .limit(limit)
    )


def branches(links: DataFrame, href: str = "href") -> DataFrame:
    from dishframe.functions.urls import branch

    return links.withColumn("_b", branch(F.col(href))).filter(F.col("_b.branch_id").isNotNull()).select(
        *links.columns, "_b.branch_id", "_b.branch_name"
    )


__all__ = [
    "as_objects", "branches", "cards", "features", "file_stem", "first_of_type", "harvest_entries", "json_documents",
    "ld_menu_items", "model_catalog", "model_lines", "offer_price", "poi_records", "restaurants", "saved_pages", "strip",
]
