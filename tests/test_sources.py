"""Readers and writers on small files, and the incremental harvest."""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from dishframe import schemas
from dishframe.functions import poi as poi_fn
from dishframe.functions import text as tx
from dishframe.operators import folding, options, poi, raters, required
from dishframe.sources import files, sinks
from dishframe.streaming.harvest import accumulate

OSM = """<?xml version="1.0"?><osm>
<node id="1" lat="42.0" lon="-83.0" version="3" user="u"><tag k="amenity" v="cafe; bar"/><tag k="name" v="Joe"/></node>
<node id="2" lat="44.0" lon="-85.0"/>
<node id="3" lat="1" lon="2"><tag k="shop" v="kitchen"/><tag k="name" v="Pizza Studio"/><tag k="diet:vegan" v="only"/></node>
<way id="9"><nd ref="1"/><nd ref="2"/><nd ref="7"/><nd ref="1"/><tag k="shop" v="dairy"/><tag k="cuisine" v="ice_cream;ice_cream"/></way>
<relation id="5"><tag k="amenity" v="pub"/></relation>
</osm>"""


def write(path, value):
    path.write_text(value if isinstance(value, str) else json.dumps(value))
    return str(path)


def lines_of(path):
    return [line for f in sorted(path.glob("part-*")) for line in f.read_text().splitlines()]


def test_map_extract(spark, tmp_path):
    features = files.features(spark, write(tmp_path / "x.osm", OSM))
    got = {r.id: r for r in features.collect()}
    assert set(got) == {"1", "2", "3", "9"}
    assert got["1"].osm.version == "3" and got["1"].osm.uid is None and got["2"].osm is None
    assert got["3"].tags["diet"] == "subtype" and got["9"].node_refs == ["1", "2", "7", "1"]
    ways = poi.way_records(
        features.filter("type = 'way'").select("id", "node_refs", "tags"), features.filter("type = 'node'").select("id", "lat", "lon")
    )
    way = ways.collect()[0]
    assert way.missing_node_refs == ["7"] and len(way.geometry) == 3
    sinks.routed_features(features, str(tmp_path / "out"))
    routed = spark.read.json(str(tmp_path / "out")).select("id", "route").collect()
    assert sorted((r.id, r.route) for r in routed) == [("1", "restaurants"), ("3", "kitchens"), ("3", "restaurants"), ("9", "dairies"), ("9", "restaurants")]
    sinks.tag_counts(features, str(tmp_path / "counts"))
    counts = [json.loads(line) for line in lines_of(tmp_path / "counts")]
    assert {"kind": "amenity", "value": "bar", "n": 1} in counts and not any(c["value"] == "pub" for c in counts)


def test_poi_lines_and_name_lists(spark, tmp_path):
    records = [
        {"type": "node", "id": "1", "tags": {"name": "Joe", "cuisine": "tex-mex;ice_cream"}},
        {"type": "way", "id": "2", "tags": {"amenity": "cafe"}},
        {"type": "node", "id": "3", "tags": {"official_name": "Bo", "addr:street": "Fort St", "addr:city": "Troy"}},
    ]
    path = write(tmp_path / "p.jsonl", "\n\n".join(json.dumps(r) for r in records) + "\n")
    df = files.poi_records(spark, path)
    assert df.count() == 3
    facts = poi.with_cuisine_facts(df)
    sinks.name_lists(facts, str(tmp_path / "lists"))
    assert lines_of(tmp_path / "lists" / "cuisine_lines") == ["Joe (Tex-Mex; Ice Cream)"]
    assert sorted(lines_of(tmp_path / "lists" / "unknown_cuisine")) == ["Bo", "Unnamed way 2"]
    assert len(lines_of(tmp_path / "lists" / "without_name")) == 2
    named = files.restaurants(df, "id", 5).orderBy("id").collect()
    assert [(r.name, r.city, r.address) for r in named] == [("Joe", "", "MI"), ("Bo", "Troy", "Fort St Troy MI")]
    assert df.select(poi_fn.mexican_match(F.col("tags"))["confidence"]).collect()[0][0] == "high"


def test_capture_to_menu(spark, tmp_path):
    cards = [
        {"item_id": "1", "section": "Featured Items", "name": "Soup", "price": "$3.00"},
        {"item_id": "2", "section": "Mains", "name": "Fish", "description": "fried", "price": "$9.00"},
        {"item_id": "1", "section": "Soups", "name": "Soup", "price": "$3.00"},
        {"item_id": "3", "section": "Mains", "name": "Rice"},
    ]
    flat = files.cards(files.json_documents(spark, write(tmp_path / "toast.json", {"result": cards}), schemas.TOAST))
    folded = folding.rollup_fold(flat, ["capture_id"], "item_id", "Featured Items", "featured item", ["pos"])
    items = folding.clean_cards(folded, default_section="", keep_unnamed=True).select(
        "capture_id", "section", "pos", F.col("name").alias("title"), F.coalesce("description", F.lit("")).alias("ingredients_or_description"), "price", "special"
    )
    sinks.write_menus(items, ["capture_id"], ["title", "ingredients_or_description", "price", "special"], str(tmp_path / "menus"))
    menu = json.loads(lines_of(tmp_path / "menus")[0])
    assert menu == {
        "capture_id": "toast.json",
        "menu_sections": [
            {"section": "Mains", "items": [{"title": "Fish", "ingredients_or_description": "fried", "price": "$9.00"}, {"title": "Rice", "ingredients_or_description": ""}]},
            {"section": "Soups", "items": [{"title": "Soup", "ingredients_or_description": "", "price": "$3.00", "special": "featured item"}]},
        ],
    }


def test_harvest_payloads(spark, tmp_path):
    page = {"itemHeader": {"name": "Tea", "unitAmount": 250}, "optionLists": []}
    write(tmp_path / "a.json", {"source_url": "s", "items": [{"item_id": "1", "name": "Tea", "item_page": page}, {"item_id": "2", "name": "x"}]})
    write(tmp_path / "b.json", {"data": {"itemPage": page}})
    entries = files.harvest_entries(files.json_documents(spark, str(tmp_path), schemas.HARVEST))
    assert entries.count() == 3
    items = options.parse_item_pages(entries).orderBy("capture_id").collect()
    assert [(r.capture_id, r.section, r.title, r.price) for r in items] == [("a.json", "Uncategorized", "Tea", "$2.50"), ("b.json", "Uncategorized", "Tea", "$2.50")]


def test_sized_modals(spark, tmp_path):
    def group(price):
        return [{"group_name": "Top", "rule_text": "pick any", "options": [{"name": "Ham", "price_text": price, "detail": "d"}]}]

    modal = {"groups_by_size": {"S": group("$1.00"), "L": group("$2.00")}}
    path = write(tmp_path / "r.json", {"order_mode": "live", "items": [{"name": "Pie"}], "modals": {"0": modal}})
    modals = files.json_documents(spark, path, schemas.REZKU).select(F.explode("modals").alias("item", "m"))
    sized = modals.select("item", F.explode("m.groups_by_size").alias("size", "g")).select("item", "size", F.inline("g")).select(
        "item", "size", "group_name", F.posexplode("options").alias("pos", "o")
    ).select("item", "size", "group_name", "pos", "o.name", "o.detail", "o.default_selected", F.regexp_extract("o.price_text", r"[\d.]+", 0).cast("decimal(12,2)").alias("price"))
    row = required.pivot_sizes(required.price_by_size(sized, ["item"], ["pos"]), ["item"]).collect()[0]
    assert row.price_by_size == {"L": Decimal("2.00"), "S": Decimal("1.00")} and row.detail == "d"


def test_ld_menus(spark):
    section = {"name": "Tacos", "hasMenuItem": [[{"name": "A &amp; B", "offers": {"price": 3.5}}], {"name": "C", "offers": [{"price": 1}]}]}
    scripts = [json.dumps({"@type": "FAQPage"}), json.dumps({"@type": "Restaurant", "hasMenu": {"hasMenuSection": section}}), json.dumps({"@type": "Restaurant"})]
    df = spark.createDataFrame([(1, scripts)], "k int, s array<string>").select("k", F.posexplode("s").alias("pos", "script"))
    shop = files.first_of_type(df, ["k"], "Restaurant").select("k", F.get_json_object("document", "$.hasMenu").alias("menu"))
    got = files.ld_menu_items(shop, ["k"]).withColumn("name", tx.unescape(F.col("name"))).orderBy("item_no").collect()
    assert [(r.section, r.name, r.price) for r in got] == [("Tacos", "A & B", "3.5"), ("Tacos", "C", None)]


def test_search_results_and_models(spark, tmp_path):
    paged = {"query": "q", "pages": [{"page": 1, "results": [{"index": 1, "title": "a", "url": "u"}]}, {"page": 2, "results": [{"index": 1, "title": "b"}]}]}
    write(tmp_path / "a.json", paged)
    write(tmp_path / "b.json", {"query": "r", "pages": [], "results": [{"index": 7, "title": "c"}]})
    df = files.json_documents(spark, str(tmp_path), schemas.SEARCH_RESULTS)
    got = raters.expand_results(df, ["query"]).orderBy("query", "index").collect()
    assert [(r["query"], r["index"], r["page"], r["title"]) for r in got] == [("q", 1, 1, "a"), ("q", 2, 2, "b"), ("r", 1, None, "c")]
    catalog = {"models": [
        {"modelId": "m1", "provider": "p", "pricePerMillionInputTokens": 0.5, "inputModalities": ["text"]},
        {"modelId": "m2", "provider": "p", "inputModalities": ["text"]},
        {"modelId": "m3", "provider": "p", "pricePerMillionInputTokens": 0.1, "inputModalities": ["image"]},
    ]}
    models = files.model_catalog(files.json_documents(spark, write(tmp_path / "c.txt", catalog), schemas.MODEL_CATALOG))
    assert [r.modelId for r in raters.eligible_models(models, 1.0, "p").collect()] == ["m1"]


def test_saved_pages_keep_their_lines(spark, tmp_path):
    write(tmp_path / "lunch.html", "<p>a</p>\n<p>b</p>")
    assert [tuple(r) for r in files.saved_pages(spark, str(tmp_path)).collect()] == [("lunch", "<p>a</p>\n<p>b</p>")]


def test_ordered_text(spark, tmp_path):
    df = spark.range(500).select("id", F.concat(F.lit("line "), F.col("id").cast("string")).alias("line")).repartition(7)
    sinks.ordered_text(df, ["id"], str(tmp_path / "t"))
    assert lines_of(tmp_path / "t") == [f"line {i}" for i in range(500)]


def test_menu_lines_read_as_the_nested_documents(spark, tmp_path):
    rows = [
        ("a", "Mains", 3, "Rice, \"hot\"", 2), ("a", "Drinks", 1, "Tea\n{x}", None), ("a", "Mains", 7, "Stew", 5), ("a", "Drinks", 9, None, 4),
        ("b", None, 2, "Soup", 1), ("b", "Mains", 5, "Pie]}", 1), (None, "Mains", 4, "Roll", 1), ("c", "", 6, "", 6),
    ]
    items = spark.createDataFrame(rows, "menu string, section string, pos long, title string, size int")
    sinks.write_menu_lines(items, ["menu"], ["title", "size"], str(tmp_path / "long"))
    sinks.write_menus(items, ["menu"], ["title", "size"], str(tmp_path / "nested"))
    rest = "".join(f.read_text() for f in sorted((tmp_path / "long").glob("part-*"))).strip()
    found = []
    while rest:
        document, end = json.JSONDecoder().raw_decode(rest)
        found.append(document)
        rest = rest[end:].lstrip()
    nested = [json.loads(line) for f in (tmp_path / "nested").glob("part-*") for line in f.read_text().splitlines()]
    assert len(found) == 4 and sorted(map(str, found)) == sorted(map(str, nested))
    assert sinks.menu_lines(items.limit(0), ["menu"], ["title"]).count() == 0


def test_sorted_json_and_snapshot(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", None), (1, "a", "x")], "menu_position int, name string, extra string")
    sinks.sorted_json(df.filter("name = 'b'"), str(tmp_path / "j"))
    assert lines_of(tmp_path / "j") == ['{"menu_position":2,"name":"b"}']
    for _ in range(2):
        sinks.snapshot(df, str(tmp_path / "s"), False)
    assert [json.loads(line)["name"] for line in lines_of(tmp_path / "s")] == ["a", "b"]


def test_incremental_harvest(spark, tmp_path):
    incoming, target = tmp_path / "in", tmp_path / "out"
    incoming.mkdir()
    schema = "item_id string, step int, name string"
    stream = str(tmp_path / "progress")

    def run():  # each time in another session, as after a restart
        accumulate(spark.newSession(), str(incoming), schema, ["item_id"], ["step"], str(target), stream)

    write(incoming / "1.json", '{"item_id":"a","step":1,"name":"old"}\n{"item_id":"b","step":1,"name":"b"}\n')
    run()
    write(incoming / "2.json", '{"item_id":"a","step":2,"name":"new"}\n{"item_id":"c","step":2,"name":"c"}\n')
    run()
    got = spark.read.schema(schema).json(f"{target}/version=1").orderBy("item_id").collect()
    assert [tuple(r) for r in got] == [("a", 2, "new"), ("b", 1, "b"), ("c", 2, "c")]
