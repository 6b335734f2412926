"""The dish index beside brute force, and what a search reads of it."""

import random

import pytest
from pyspark.sql import functions as F

from dishframe.operators import dish_index, jsonwalk, search


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return row[-1]


NAMES = ["taco", "tacos", "carne taco", "taco carne asada", "tac", "", "a", "pho", "phở bo", "enchiladas verdes", "enchilada verde", None, "TACO", " taco "]


@pytest.mark.parametrize("query", ["taco", "taco carne", "tcao", "enchilads verds", "ab", "zz", "pho"])
def test_index_finds_what_comparing_every_name_finds(spark, query):
    draw = random.Random(4)
    names = NAMES + ["".join(draw.choice("taco ") for _ in range(draw.randrange(1, 7))) for _ in range(150)]
    items = spark.createDataFrame(list(enumerate(names)), "id int, name string")
    found = dish_index.matching_items(items, dish_index.build(items, "name"), query, "name")
    got = {(r.id, r.distance, r.exact) for r in found.collect()}
    wanted = {w for w in query.split() if len(w) > 2}
    want = set()
    for r in items.select("id", dish_index.dish_key(F.col("name")).alias("k")).filter("k is not null").collect():
        exact = bool(wanted) and wanted <= {w for w in r.k.split() if len(w) > 2}
        if exact or distance(r.k, query) <= 2:
            want.add((r.id, distance(r.k, query), exact))
    assert got == want


def test_search_reads_postings_of_its_own_keys(spark):
    items = spark.createDataFrame([(i, f"dish number {i}") for i in range(300)], "id int, name string")
    index = dish_index.build(items, "name")
    shown = dish_index.search(index, "dish number 7")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(posting" in shown or "PushedFilters: [IsNotNull(dish_key), In(posting" in shown
    assert index.filter("posting = 't dish'").count() == 300
    with pytest.raises(ValueError):
        dish_index.search(index, "x", max_distance=3)


def test_nearest_items_match_a_full_sort(spark):
    draw = random.Random(8)
    places = [(i, draw.uniform(-89, 89), draw.uniform(-179, 179)) for i in range(300)] + [(1000 + i, 42.2 + i / 500, -83.2) for i in range(10)]
    of_places = spark.createDataFrame(places, "place int, lat double, lon double")
    items = spark.createDataFrame([(i, p) for i, (p, _, _) in enumerate(places) for _ in range(2)], "id int, place int")
    ratings = spark.createDataFrame([(p, 4.0) for p, _, _ in places[::2]], "place int, rating double")
    for lat, lon, k in ((42.2, -83.2, 5), (42.2, -83.2, 40), (88.0, 170.0, 7), (-10.0, 179.5, 3), (0.0, 0.0, 10_000)):
        parts = (items, of_places, ratings, "place", ["id"], lat, lon)
        whole = search.result_rows(*parts).withColumn("distance_km", F.round("distance_km", 4)).orderBy("distance_km", "id").limit(k)
        near = search.nearest_items(*parts, k=k, order=["id"])
        assert [(r.id, r.distance_km) for r in near.collect()] == [(r.id, r.distance_km) for r in whole.collect()]


def test_confidence(spark):
    df = spark.createDataFrame([(0,), (10,), (None,), (990,)], "n int").select(search.source_confidence(F.col("n")).alias("c"))
    assert [r.c for r in df.collect()] == [0.0, 0.5, 0.0, 0.99]


def test_walk_keeps_document_order_and_tests_inside(spark):
    document = '{"b":[{"Review":1,"x":{"deep":"4 stars"}},[{"k":2}]],"a":{},"n":NaN,"b2":{"z":1,"z":{"rating":5}}}'
    df = spark.createDataFrame([(1, 7, document), (2, 8, "broken"), (3, 9, None), (4, 6, "[]"), (5, 5, '"text"')], "k int, part int, d string")
    every = jsonwalk.json_objects(df, "k", "d").orderBy("n").collect()
    assert [(r.n, r.path) for r in every] == [(0, ""), (1, "b[0]"), (2, "b[0].x"), (3, "b[1][0]"), (4, "a"), (5, "b2"), (6, "b2.z")]
    kept = jsonwalk.json_objects(df, "k", "d", keep=lambda node: "k" in node).collect()
    assert [tuple(r) for r in kept] == [(1, 3, "b[1][0]", '{"k": 2}')]
    found = jsonwalk.review_like(df, ["k", "part"], "d", "(?i)review|rating|stars?", 10, 1400).orderBy("n", "kind").collect()
    assert [(r.part, r.n, r.kind) for r in found] == [(7, 0, "ratingish"), (7, 1, "ratingish"), (7, 1, "review"), (7, 2, "ratingish"), (7, 5, "ratingish"), (7, 6, "ratingish")]
    assert {r.context for r in found if r.kind == "review"} == {'{"Review":'}
