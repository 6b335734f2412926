"""Committed increments and resume; XML elements in one scan; merged options in long form."""

import io
import random
import re

import pytest
from pyspark.sql import functions as F

from dishframe.operators import options, sizes
from dishframe.sources import files, snapshots
from dishframe.sources.elements import element_texts, elements

SCHEMA = "item_id string, menu_position int, item_page string"


class Stop(Exception):
    pass


def page(run):
    return lambda todo: todo.select("item_id", "menu_position", F.concat(F.lit(run), "item_id").alias("item_page"))


def state(df):
    return {r.item_id: (r.menu_position, r.item_page, r.version) for r in df.collect()}


def test_harvest_goes_on_after_a_stop(spark, tmp_path):
    path = str(tmp_path / "h")
    items = spark.createDataFrame([(c, i) for i, c in enumerate("abcdef")], "item_id string, menu_position int")
    asked = []

    def stops(todo):
        asked.append(sorted(r.item_id for r in todo.collect()))
        if len(asked) == 3:
            raise Stop
        return page("1")(todo)

    with pytest.raises(Stop):
        snapshots.harvest(spark, path, items, stops, SCHEMA, steps=3, portion=F.col("menu_position"))
    assert asked == [["a", "d"], ["b", "e"], ["c", "f"]]
    assert [(r.version, r.complete, r.n_rows) for r in snapshots.commits(spark, path).orderBy("version").collect()] == [(0, False, 2), (1, False, 2)]
    got = state(snapshots.harvest(spark, path, items, page("2"), SCHEMA))
    assert got == {"a": (0, "1a", 0), "d": (3, "1d", 0), "b": (1, "1b", 1), "e": (4, "1e", 1), "c": (2, "2c", 2), "f": (5, "2f", 2)}
    assert snapshots.commits(spark, path).filter("complete").count() == 1
    again = state(snapshots.harvest(spark, path, items, page("3"), SCHEMA))  # nothing is left: an empty, complete increment
    assert again == got and snapshots.commits(spark, path).orderBy(F.desc("version")).first().n_rows == 0


def test_rows_without_commit_do_not_count(spark, tmp_path):
    path = str(tmp_path / "h")
    read = lambda: state(snapshots.snapshot(spark, path, SCHEMA, "item_id", "item_page", "menu_position"))
    assert read() == {}
    rows = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    snapshots.write_increment(rows(("a", 1, "torn")), path, 0)
    assert read() == {} and snapshots.commits(spark, path).count() == 0
    snapshots.write_increment(rows(("a", 1, "x"), ("a", 2, "y"), ("a", 3, None), (None, 1, "n"), ("", 1, "e"), ("b", 1, None)), path, 0)
    snapshots.commit(spark, path, 0, False)
    assert read() == {"a": (2, "y", 0), "b": (1, None, 0)}
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        snapshots.commit(spark, path, 0, True)
    items = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "item_id string, menu_position int")
    held = snapshots.snapshot(spark, path, SCHEMA, "item_id", "item_page", "menu_position")
    assert sorted(r.item_id for r in snapshots.remaining(items, held, "item_id", "item_page").collect()) == ["b", "c"]
    snapshots.write_increment(rows(("a", 9, None), ("b", 2, "late")), path, 1)
    snapshots.commit(spark, path, 1, True)
    assert read() == {"a": (2, "y", 0), "b": (2, "late", 1)}


EXTRACT = (
    "﻿<?xml version='1.0'?><osm><bounds/>"
    + "".join(f'<node id="{i}" lat="1.5"/>' if i % 3 else f"<node id='{i}' note='a > \"b\" ü'><tag k=\"name\" v=\"é{i}\"/></node >" for i in range(20))
    + "".join(f'<way id="w{i}"><nd ref="1"/><nd/><nd ref=""/><nd ref="{i}"/>\n</way>\n<relation id="{i}"><member type="way"/></relation><nodes/>' for i in range(9))
    + "<way/></osm>"
)


@pytest.mark.parametrize("split", [1, 7, 64, 1000, 10**6])
def test_every_element_is_read_once_at_any_cut(split):
    data = EXTRACT.encode()
    want = [(m[1], m[0]) for m in re.finditer(r"""<(node|way)(?=[\s/>])(?:[^>"']|"[^"]*"|'[^']*')*?(?:/>|>.*?</\1\s*>)""", EXTRACT, re.S)]
    assert len(want) == 30
    got = [e for a in range(0, len(data), split) for e in element_texts(io.BytesIO(data), a, min(a + split, len(data)), ["node", "way"], step=16)]
    assert got == want


def test_unclosed_and_empty_files():
    assert list(element_texts(io.BytesIO(b""), 0, 0, ["node"])) == []
    assert list(element_texts(io.BytesIO(b"plain text <nodes/> <no"), 0, 23, ["node"])) == []
    for cut in (b'<node id="1"><tag/>', b"<node id='1", b'<node id="1" '):
        with pytest.raises(ValueError, match="byte 2"):
            list(element_texts(io.BytesIO(b"  " + cut), 0, 99, ["node"], step=4))


def test_features_of_a_folder_cut_into_ranges(spark, tmp_path):
    (tmp_path / "a.osm").write_text(EXTRACT)
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "c.osm").write_text('<node id="z" lat="x" lon="2"/>\n<node id="bad"><tag k="a"/></node>')
    (tmp_path / "_hidden.osm").write_text('<node id="hidden"/>')
    (tmp_path / "empty.osm").write_text("")
    found = files.features(spark, str(tmp_path), split_bytes=100)
    assert found.rdd.getNumPartitions() > 10
    got = {(r.type, r.id): r for r in found.collect()}
    assert len(got) == 32 and got["way", "w4"].node_refs == ["1", "4"] and got["way", None].node_refs == []
    assert got["node", "3"].tags == {"name": "é3"} and got["node", "1"].lat == 1.5 and got["node", "1"].node_refs is None
    assert got["node", "z"].lat is None and got["node", "z"].lon == 2.0 and got["node", "bad"].tags == {"a": ""}
    assert elements(spark, f"file://{tmp_path}", ["way"]).count() == 10
    with pytest.raises(Exception, match="No such file|FileNotFound"):
        elements(spark, str(tmp_path / "none"), ["way"]).count()


STRUCTURE = "array<struct<group:string,options:array<struct<name:string,price:decimal(12,2)>>>>"
CROSS = "array<struct<group:string,n:int>>"
RANK = {"Small": 0, "Large": 1}


def structured(spark, rows):
    schema = f"section string, pos int, title string, price_min decimal(12,2), price_max decimal(12,2), ingredients_or_description string, groups {STRUCTURE}, cross_sell {CROSS}"
    return sizes.with_size(spark.createDataFrame(rows, schema)).withColumn("signature", options.structure_signature(F.col("groups")))


def test_merged_options_match_brute_force(spark):
    from decimal import Decimal

    rng, rows = random.Random(3), []
    for pos in range(80):
        size, dish = rng.choice(["Small", "Large"]), rng.choice(["Thin", "Deep", "Taco", "Soup", "Lone"])
        sauces = [("Sauce", [(n, Decimal(rng.randint(0, 3))) for n in ("Red", "Green")[: 1 if dish == "Deep" and pos % 3 == 0 else 2]])]
        groups = None if dish == "Taco" else [] if dish == "Soup" else sauces
        cross = rng.choice([None, [], [("Drinks", pos)], [("Dips", pos), ("Drinks", pos), (None, pos)]])
        section = "s%d" % (pos % 2) if dish != "Lone" else f"alone{pos}"
        rows.append((section, pos, f"{size} {dish}", Decimal(rng.randint(1, 9)), None, None, groups, cross))
    df = structured(spark, rows)
    items = {}
    for r in rows:
        size, dish = r[2].split()
        items.setdefault((r[0], dish.lower()), []).append((RANK[size], r[1], size, r))
    want, crosses = set(), set()
    for (section, dish), members in items.items():
        if len(members) < 2:
            continue
        members.sort(key=lambda m: m[:2])
        floor = min(m[3][3] for m in members)
        names = [tuple((g, tuple(n for n, _ in o)) for g, o in m[3][6] or []) for m in members]
        shared = len({(m[3][6] is None, n) for m, n in zip(members, names)}) == 1
        want |= {(section, dish, 0, "Size", None, m[1], m[2], m[3][3] - floor, m[3][3]) for m in members}
        for m in members[:1] if shared else members:
            for g, (group, opts) in enumerate(m[3][6] or []):
                want |= {(section, dish, g + 1, group, None if shared else m[1], i, n, p, None) for i, (n, p) in enumerate(opts)}
        seen = {}
        for m in members:
            for c in m[3][7] or []:
                seen.setdefault(c[0], c[1])
        crosses |= {(section, dish, g, n) for g, n in seen.items()}
    got = sizes.merged_options(df, ["section"]).select(
        "section", "residual_key", "group_no", "group", F.col("under.pos").alias("under"), "option_no", "option", "price", "absolute_price"
    )
    found = [tuple(r) for r in got.collect()]
    assert set(found) == want and len(found) == len(want) and any(w[4] is not None for w in want)
    union = sizes.merged_cross_sells(df, ["section"]).select("section", "residual_key", "group", "cross_sell.n")
    assert {tuple(r) for r in union.collect()} == crosses
    assert sizes.merged_options(df.limit(0), ["section"]).count() == sizes.merged_cross_sells(df.limit(0), ["section"]).count() == 0


def test_merged_options_collect_no_members(spark):
    df = structured(spark, [])
    for rows in (sizes.merged_options(df, ["section"]), sizes.merged_cross_sells(df, ["section"])):
        assert "collect_list" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_map_elements_scan_once(spark):
    import __spark_entry__ as entry

    plan = entry.queries()["map_elements"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan") == 1 and "Exchange" not in plan


def test_a_document_without_the_section_is_an_error(spark):
    from dishframe.operators import ordering

    rows = spark.createDataFrame([("a", 2, "Menu"), ("a", 1, "Menu"), ("b", 1, "Menu"), ("b", 2, None)], "doc string, pos int, title string")
    found = ordering.section_or_error(rows, ["doc"], "title", "Menu", "pos")
    assert sorted((r.doc, r.pos) for r in found.collect()) == [("a", 1), ("b", 1)]
    with pytest.raises(Exception, match="not found"):
        ordering.section_or_error(rows.filter("doc = 'a' or title is null"), ["doc"], "title", "Menu", "pos").collect()


def test_source_evidence_of_null_and_empty_lists(spark):
    from dishframe.operators import signals

    hits = "array<struct<value:string,start:int,context:string>>"
    rows = [("s", 1, "t", [("5", 0, "c"), ("4", 9, "d")], None), (None, 2, None, [], [("7", 1, "e")]), ("s", 1, "t", None, [])]
    pages = spark.createDataFrame(rows, f"source string, page int, title string, ratings {hits}, counts {hits}")
    got = signals.source_evidence(pages, "source", "page", "title", {"ratings": 1, "counts": None}).collect()
    want = [("s", 1, "page", 0, "t", None), ("s", 1, "ratings", 0, "5", "c"), (None, 2, "page", 0, None, None), (None, 2, "counts", 0, "7", "e"), ("s", 1, "page", 0, "t", None)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
