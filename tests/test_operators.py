"""Operators on small written-out menus, and properties on random ones."""

import random
import re
from decimal import Decimal

from pyspark.sql import functions as F

from dishframe import schemas
from dishframe.functions import price
from dishframe.operators import comparison, dedupe, folding, jsonwalk, links, matching, options, ordering, poi, raters, reports
from dishframe.operators import required, signals, sizes, skew


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- folding ------------------------------------------------------------------------------------

CARDS = [
    (0, "Featured", "1", "Soup"), (1, "Featured", None, "Ghost"), (2, "Mains", "1", "Soup"), (3, "", "2", "Fish"),
    (4, "Mains", None, "Rice"), (5, "Mains", "3", ""),
]


def test_rollup_fold_and_order(spark):
    cards = spark.createDataFrame(CARDS, "pos int, section string, item_id string, name string")
    folded = folding.rollup_fold(cards, [], "item_id", "Featured", "featured item", ["pos"])
    assert rows(folded.select("pos", "special"), "pos") == [(2, "featured item"), (3, None), (4, None), (5, None)]
    clean = folding.clean_cards(cards, rollup="Featured")
    assert rows(clean.select("pos", "section"), "pos") == [(2, "Mains"), (3, "Uncategorized"), (4, "Mains")]
    kept = folding.clean_cards(cards, rollup="Featured", default_section="", keep_unnamed=True)
    assert rows(kept.select("pos", "section", "name"), "pos")[-1] == (5, "Mains", "")
    order = folding.section_order(clean, [])
    assert rows(order, "section_pos") == [("Mains", 1, 2), ("Uncategorized", 2, 1)]


def test_fold_keeps_every_real_card(spark):
    rng = random.Random(3)
    cards = [(i, rng.choice(["Popular", "A", "B"]), str(rng.randrange(30))) for i in range(300)]
    df = spark.createDataFrame(cards, "pos int, section string, item string")
    folded = folding.rollup_fold(df, [], "item", "Popular", "x", ["pos"], heavy=skew.heavy_keys(df.filter("section <> 'Popular'"), ["item"], min_rows=5))
    popular = {c[2] for c in cards if c[1] == "Popular"}
    want = sorted((c[0], "x" if c[2] in popular else None) for c in cards if c[1] != "Popular")
    assert rows(folded.select("pos", "special"), "pos") == want
    count = folding.rollup_count(df, [], "item", "Popular").collect()[0][0]
    assert count == len(popular & {c[2] for c in cards if c[1] != "Popular"})


def test_structured_merge(spark):
    structured = [
        ("Soup", "Most Ordered", 0, "thin", "3"), ("Rice", "Most Ordered", 1, "", None), ("Soup", "Starters", 2, "much longer", "4"),
        ("Soup", "Lunch", 3, "short", "5"),
    ]
    cards = [("Soup", "x", 0, "", "9", None, 90, 10), ("Rice", "Sides", 1, "", "2", 1, None, None), ("Flan", None, 2, "sweet", "6", 2, None, 5)]
    m = spark.createDataFrame(structured, "title string, section string, pos int, description string, price string")
    c = spark.createDataFrame(
        cards, "title string, section string, pos int, description string, price string, featured_rank int, like_percent int, like_review_count int"
    )
    got = folding.structured_card_merge(m, c, []).select(
        "title", "section", "description", "price", "special", "like_percent", "like_review_count"
    )
    assert rows(got, "title") == [
        ("Flan", "Uncategorized", "sweet", "$6", "featured item", None, None),
        ("Rice", "Sides", "", None, "featured item", None, None),
        ("Soup", "Starters", "much longer", "4", "featured item", 90, 10),
    ]


# --- option trees -------------------------------------------------------------------------------


def harvest(spark):
    def leaf(name, cents, deeper="[]"):
        return {"name": name, "unitAmount": cents, "description": "", "defaultQuantity": None, "nestedExtrasList": deeper}

    def group(name, opts, optional=False, low=None, kind=None):
        return {
            "name": name, "type": kind, "isOptional": optional, "minNumOptions": low, "maxNumOptions": 9, "numFreeOptions": None,
            "selectionNode": "s", "options": opts,
        }

    def option(name, cents, nested=None):
        return {"name": name, "unitAmount": cents, "description": "", "defaultQuantity": 1, "nestedExtrasList": nested}

    crust = lambda a: [group("Crust", [leaf("Thin", 0), leaf("Gluten Free Crust", a)], low=1)]
    tree = [
        group("Size", [option("Small", 0, crust(345)), option("Large", 200, crust(400))], low=1),
        group("Toppings", [option("Ham", 150), option("Olive", 100), option("Corn", 100)], low=2),
        group("Extras", [option("Dip", 50), option("Dip", 75)], optional=True),
        group("Also", [option("Cola", 199)], optional=True, kind="item"),
    ]
    page = {"itemHeader": {"name": "Pie", "description": "vegan", "unitAmount": 1000}, "optionLists": tree}
    data = [("1", "Pizza", "Pie", 0, page), ("2", None, "Gone", 1, None)]
    return spark.createDataFrame(data, schemas.HARVEST_ITEM.replace(":", " ", 4).replace("item_page:", "item_page ", 1))


def test_item_pages(spark):
    items = options.parse_item_pages(harvest(spark)).collect()
    assert len(items) == 1
    item = items[0]
    assert (item.title, item.section, item.price) == ("Pie", "Pizza", "$12.00")
    assert (item.price_min, item.price_max) == (Decimal("12.00"), Decimal("18.50"))
    index = {(r.group, r.name): r for r in item.option_index}
    free = index[("Crust", "Gluten Free Crust")]
    assert free.available_when == ["Small", "Large"] and free.price is None and free.parent_group == "Size"
    assert free.price_by_parent == {"Small": Decimal("3.45"), "Large": Decimal("4.00")}
    assert index[("Extras", "Dip")].price == Decimal("0.50") and index[("Extras", "Dip")].available_when is None
    assert [(b.tag, len(b.matches)) for b in item.dietary_badges] == [("gluten_free", 1), ("vegan", 0)]
    assert [(c.group, [(o.name, o.price) for o in c["items"]]) for c in item.cross_sell] == [("Also", [("Cola", Decimal("1.99"))])]


def test_third_level_is_refused(spark):
    import pytest

    df = harvest(spark).filter("item_id = '1'")
    whole = df.select(options.assert_two_levels(F.col("item_page.optionLists")).alias("ok")).collect()
    assert whole[0].ok
    deep = F.from_json(
        F.replace(F.to_json("item_page.optionLists"), F.lit('"nestedExtrasList":"[]"'), F.lit('"nestedExtrasList":[{"name":"x"}]')),
        schemas.OPTION_LISTS,
    )
    with pytest.raises(Exception, match="deeper than two levels"):
        df.select(options.assert_two_levels(deep)).collect()


# --- required groups ----------------------------------------------------------------------------

MODIFIERS = [
    ("kabob", [("Meat", "Required", [("Beef", "$9.00", "radio"), ("Lamb", "$11.00", "radio")]), ("Side", "Choose 2", [("Rice", "$1.00", "radio"), ("Corn", "$1.00", "radio")])]),
    ("plain", [("Extra", "Optional, up to 3", [("Dip", "$1.00", "checkbox")])]),
]


def modifier_table(spark):
    schema = "item string, groups array<struct<group_name:string,rule_text:string,options:array<struct<name:string,price_text:string,input_type:string>>>>"
    return required.explode_modifiers(spark.createDataFrame(MODIFIERS, schema), ["item"])


def test_replacing_rule(spark):
    mods = modifier_table(spark)
    pick = price.required_count(F.col("rule_text"))
    groups = required.priced_groups(mods, ["item"], pick, "once")
    parts = required.note_parts(mods.select("item", "group_pos", "group_name", "option_pos", "name", "price"), groups, ["item"])
    notes = required.render_notes(parts, ["item"], "once")
    flags = required.input_type_flags(mods, ["item"], pick)
    items = spark.createDataFrame(
        [("kabob", "$0.00", "old", True), ("plain", "$0.00", "keep", True), ("soup", "$4.00", "s", False)],
        "item string, price string, description string, has_modifiers boolean",
    )
    done = required.apply_replacing(items, required.item_additions(groups, ["item"]), notes, flags, ["item"])
    got = {r["item"]: r for r in done.collect()}
    assert got["kabob"].price == "$10.00"
    assert got["kabob"].description == "Meat: Lamb ($11.00) available for an extra charge; Side: choose 2 - Rice, Corn"
    assert got["kabob"].review_flags == ["group 'Side' rule says 'Choose 2' (implies checkbox) but option inputs are ['radio']"]
    assert (got["plain"].price, got["plain"].description) == ("$0.00", "keep")
    assert got["plain"].review_flags == [required.STILL_ZERO_REPLACED]
    assert (got["soup"].price, got["soup"].review_flags) == ("$4.00", None)


def test_appending_rule(spark):
    mods = modifier_table(spark).withColumn("rule_text", F.when(F.col("rule_text") == "Choose 2", "must pick 2").when(F.col("rule_text") == "Required", "Must pick 1"))
    pick = price.required_pick(F.col("rule_text"))
    groups = required.priced_groups(mods, ["item"], pick, "times")
    parts = required.note_parts(mods.select("item", "group_pos", "group_name", "option_pos", "name", "price"), groups, ["item"])
    notes = required.render_notes(parts, ["item"], "times")
    cards = spark.createDataFrame(
        [("kabob", "$0.00", "old", True, "live"), ("plain", None, "", True, "live"), ("soup", "$4.00 - $6.00", "s", False, "preview")],
        "item string, card_price string, description string, has_modal boolean, order_mode string",
    )
    cards = cards.withColumn("r", price.price_range(F.col("card_price"))).select("*", "r.low", "r.high").drop("r")
    got = {r["item"]: r for r in required.apply_appending(cards, required.item_additions(groups, ["item"]), notes, ["item"]).collect()}
    assert got["kabob"].price == "$11.00"
    assert got["kabob"].description == "old; Meat: Lamb ($11.00) available for an extra charge; Side: choose 2 - Rice, Corn"
    assert got["plain"].review_flags == [required.NO_REQUIRED_GROUP]
    assert (got["soup"].price, got["soup"].description, got["soup"].missing_options) == ("$4.00", "s; Options up to $6.00", True)
    assert got["soup"].review_flags == [required.CLOSED_PREVIEW]


# --- sizes --------------------------------------------------------------------------------------


def sized(spark, titles, section="Pizza"):
    data = [(section, i, t, f"d{i}" if i else "", Decimal(10 + i), Decimal(20 + i)) for i, t in enumerate(titles)]
    df = spark.createDataFrame(
        data, "section string, pos int, title string, ingredients_or_description string, price_min decimal(12,2), price_max decimal(12,2)"
    ).withColumn("price", price.dollars(F.col("price_min")))
    return sizes.with_size(df)


def test_size_merge(spark):
    items = sized(spark, ["Large Thin", "Salad", "Small Thin", "Large Deep", "thin small"])
    out = sizes.normalized_items(items, ["section"], ["pos"])
    got = rows(out.select("title", "price", "price_max", "ingredients_or_description", "n_members"), "class", "pos")
    assert got == [
        ("Thin", "$10.00", Decimal("24.00"), "d2", 3), ("Large Deep", "$13.00", Decimal("23.00"), "d3", 1), ("Salad", "$11.00", Decimal("21.00"), "d1", 1),
    ]
    assert sum(r[4] for r in got) == 5
    again = sizes.with_size(out.drop("class", "size_normalized", "n_members"))
    merged_again = sizes.normalized_items(again, ["section"], ["pos"])
    assert sorted(rows(merged_again.select("title", "price"))) == sorted((g[0], g[1]) for g in got)


def test_merged_documents(spark):
    group = "array<struct<group:string,options:array<struct<name:string>>>>"
    cross = "array<struct<group:string,n:int>>"
    items = sized(spark, ["Large Thin", "Small Thin", "Small Deep", "Large Deep"]).withColumn(
        "groups",
        F.when(F.col("pos") == 3, F.lit(None)).otherwise(F.array(F.struct(F.lit("Sauce").alias("group"), F.array(F.struct(F.lit("Red").alias("name"))).alias("options")))).cast(group),
    ).withColumn("cross_sell", F.array(F.struct(F.lit("With").alias("group"), F.col("pos").alias("n"))).cast(cross))
    items = items.withColumn("signature", options.structure_signature(F.col("groups")))
    got = {r.title: r for r in sizes.merged_documents(items, ["section"]).collect()}
    assert [(o.name, o.price) for o in got["Thin"].size_options] == [("Small", Decimal("1.00")), ("Large", Decimal("0.00"))]
    assert got["Thin"].shared_groups[0].group == "Sauce" and got["Thin"].size_options[0].nested is None
    assert got["Deep"].shared_groups is None and got["Deep"].size_options[0].nested[0].group == "Sauce"
    assert got["Thin"].merged_from == ["Small Thin", "Large Thin"] and len(got["Thin"].cross_sell) == 1


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_near_misses_match_brute_force(spark):
    rng = random.Random(5)
    words = ["side of rice", "beans", "or papas", "deep dish", "thin crust", "(8oz)", "combo", "taco", "tacos", "grande"]
    titles = {"Large " + " ".join(rng.sample(words, rng.randint(1, 3))) for _ in range(60)} | {"Large ab", "Large abc", "Large a", "Large aaaa", "Large aaaaa"}
    titles |= {t[:k] + rng.choice("xyz") + t[k + rng.randint(0, 2):] for t in sorted(titles) for k in [rng.randrange(7, len(t) + 1)]}
    items = sized(spark, sorted(titles))
    lone = sizes.lone_residuals(items, ["section"])
    order = [r.residual_key for r in lone.orderBy("pos").collect()]
    want = {
        (a, b) for i, a in enumerate(order) for b in order[i + 1:] if len(a) > 2 and len(b) > 2 and 1 - edits(a, b) / max(len(a), len(b)) >= 0.80 - 1e-9
    }
    got = sizes.near_misses(lone, ["section"])
    assert {(r.residual_a, r.residual_b) for r in got.collect()} == want and len(want) > 10


def test_near_misses_by_edits_of_bytes(spark):
    lone = sizes.lone_residuals(sized(spark, ["Large aañaaaaaaa", "Large aaaaaaaaaa", "Large aaaaañaña", "Large bbñbbbbb", "Large bbbbbbbb"]), ["section"])
    got = {(r.residual_a, r.residual_b): round(r.ratio, 6) for r in sizes.near_misses(lone, ["section"], byte_edits=True).collect()}
    # Two bytes of ten letters are within a fifth, two of eight are not.
    assert got == {("aañaaaaaaa", "aaaaaaaaaa"): 0.8}
    assert len(sizes.near_misses(lone, ["section"]).collect()) > 1


def test_near_misses_of_many_blocks(spark, monkeypatch):
    """Pairs between and inside blocks, texts of one to several segments, equal letter pairs; no pair is exchanged."""
    monkeypatch.setattr(sizes, "BLOCK", 8, raising=False)
    monkeypatch.setattr(sizes, "BLOCKS", 5, raising=False)
    rng = random.Random(11)
    parts = ["it ", "hewh", "the ", "ñü", "tion", "aa", "er ", "zq"]
    texts = {"".join(rng.choices(parts, k=rng.choice([2, 5, 12, 20, 60]))).strip() for _ in range(22)}
    for text in sorted(texts):
        for edits_of in (1, len(text) // 6, len(text) // 5 + 1):
            other = list(text)
            for _ in range(edits_of):
                at = rng.randrange(len(other))
                other[at:at + 1] = rng.choice([[], ["x"], [other[at], "y"]])
                other = other or ["x"]
            texts.add("".join(other).strip())
    order = sorted(t for t in texts if len(t) > 2)
    rng.shuffle(order)
    rows_ = [("big", t, "Large " + t, i) for i, t in enumerate(order)] + [("small", t, "Large " + t, i) for i, t in enumerate(order[:6])]
    lone = spark.createDataFrame(rows_, "section string, residual_key string, title string, pos bigint")
    want = {
        (s, a, b) for s, of in (("big", order), ("small", order[:6])) for i, a in enumerate(of) for b in of[i + 1:]
        if 1 - edits(a, b) / max(len(a), len(b)) >= 0.80 - 1e-9
    }
    got = sizes.near_misses(lone, ["section"])
    pairs = [(r.section, r.residual_a, r.residual_b) for r in got.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == want and len(want) > 20
    assert not re.search(r"Exchange hashpartitioning\([^)]*pos_a", got._jdf.queryExecution().executedPlan().toString())


# --- raters -------------------------------------------------------------------------------------


def test_consensus(spark):
    votes = [
        ("m1", "1", "high", 0), ("m1", "1", "low", 1), ("m2", "1", " Medium ", 0), ("m3", "1", "bogus", 0), ("m3", "1", "high", 1),
        ("m1", "2", "none", 2), ("m2", "x", "high", 1), ("m2", "9", "high", 2),
    ]
    judged = spark.createDataFrame(votes, "model string, index string, usefulness string, pos int")
    known = spark.createDataFrame([(1, "a", "u1"), (2, "b", "u2"), (3, "c", "u3")], "index int, title string, url string")
    got = raters.consensus(known, raters.first_votes(judged)).orderBy("index")
    assert [(r.avg_score, r.average_usefulness, r.variance, r.confidence, r.judgment_count) for r in got.collect()] == [
        (2.5, "medium", 0.25, "high", 2), (0.0, "none", 0.0, "low", 1), (None, "none", None, "low", 0),
    ]
    line = got.select(reports.consensus_line().alias("l")).collect()[0].l
    assert line == "| 1 | 2.50 medium | high | 1/1/0/0 | a | u1 |"


def test_published_counts_give_the_published_figures(spark):
    """22 high and one medium vote: 2.957, variance 0.042, high confidence."""
    votes = [(f"m{i}", 1, "high" if i < 22 else "medium", 0) for i in range(23)]
    judged = spark.createDataFrame(votes, "model string, index int, usefulness string, pos int")
    known = spark.createDataFrame([(1, "a", "u")], "index int, title string, url string")
    row = raters.consensus(known, raters.first_votes(judged)).collect()[0]
    assert (row.avg_score, row.variance, row.average_usefulness, row.confidence) == (2.957, 0.042, "high", "high")


# --- comparison ---------------------------------------------------------------------------------

FILES = {
    "a": "<!-- model: z/one -->\n\nDish Name | Original Category | Canonical Category | Base Price | Sides Number | Side Choices | Description\n---|---|---|---|---|---|---\nTacos | Lunch | Main | $5 | 2 | rice | x\nBroken | row\n| Tacos | Lunch | Main | 5.50 | 2 | rice | later |",
    "b": "TACOS! | lunch | Main | $5.5 | | rice | y\nFlan | Sweet | Dessert | $3 | | | z",
}


def test_compare_files(spark, tmp_path):
    for name, body in FILES.items():
        (tmp_path / f"{name}.txt").write_text(body)
    from dishframe.functions import text as tx
    from dishframe.sources.files import model_lines

    lines = model_lines(spark, str(tmp_path))
    cells = comparison.row_lines(lines, headings=comparison.SEVEN_COLUMNS)
    assert rows(comparison.model_summary(cells, 7), "model") == [("b", 2, 2, 0), ("z/one", 2, 3, 1)]
    items = comparison.well_formed(cells, comparison.SEVEN_FIELDS).withColumn("key", tx.split_dish_key(F.col("dish")))
    aligned = comparison.latest_per_model(items, ["key"])
    assert rows(aligned.select("key", "model", "price"), "key", "model") == [("flan", "b", "$3"), ("tacos", "b", "$5.5"), ("tacos", "z/one", "5.50")]
    gaps = comparison.coverage_gaps(aligned, ["key"], lines.select("model").distinct())
    assert rows(gaps) == [("flan", ["b"], ["z/one"])]
    assert rows(comparison.disagreements(aligned, ["key"], F.col("price"), price.normalize_price)) == []
    sides = comparison.disagreements(aligned, ["key"], F.col("sides_number"), tx.text_key)
    assert rows(sides) == [("tacos", 2, "[blank]: b; 2: z/one")]


# --- pages, order, matching ---------------------------------------------------------------------


def test_heading_and_orphans(spark):
    data = [(1, "h", "Tacos", None), (2, "i", "A", None), (3, "p", "", "$4"), (4, "p", "", "$5"), (5, "i", "B", "$6"), (6, "p", "", "$7"), (7, "h", "Soup", None), (8, "i", "C", None)]
    df = spark.createDataFrame(data, "pos int, kind string, title string, price string").withColumn("page", F.lit(1))
    filled = ordering.nearest_heading(df, ["page"], "pos", F.when(F.col("kind") == "h", F.col("title")), width=3)
    assert [r.section for r in filled.orderBy("pos").collect()] == ["Tacos"] * 6 + ["Soup"] * 2
    cards = df.filter("kind <> 'h'")
    priced = ordering.attach_orphan_prices(
        cards, ["page"], "pos", F.col("title") != "", F.col("price"), F.when(price.looks_like_price(F.col("price")), F.col("price")), width=3
    )
    assert rows(priced.select("title", "resolved_price"), "title") == [("A", "$4"), ("B", "$6"), ("C", None)]


def test_reading_order(spark):
    left = [(1, 10, y, f"L{y}") for y in (30, 10, 20)]
    right = [(1, 90, y, f"R{y}") for y in (15, 5, 25)]
    single = [(2, 10, 3, "c"), (2, 90, 2, "b"), (2, 10, 1, "a")]
    df = spark.createDataFrame(left + right + single, "page int, x int, y int, text string")
    got = ordering.reading_order(df, ["page"], "x", "y", F.lit(50), ["x"], partitions=3).orderBy("page", "block_no")
    assert [r.text for r in got.collect()] == ["L10", "L20", "L30", "R5", "R15", "R25", "a", "b", "c"]


def test_review_snippets_match_the_loop(spark):
    rng = random.Random(9)
    lines = [rng.choice(["short", "Great review of the place with many more words", "rated it", "x" * 400, "3 days ago"]) for _ in range(60)]
    got = spark.createDataFrame([(lines,)], "l array<string>").select(ordering.review_snippets(F.col("l"), longest=900, limit=30)).collect()[0][0]
    want = []
    for i, line in enumerate(lines):
        if not any(w in line for w in ("review", "rated", "ago")):
            continue
        window = " ".join(lines[max(0, i - 2): i + 5])
        if len(window) >= 45 and window not in want and len(want) < 30:
            want.append(window[:900])
    assert got == want


def test_pattern_hits_match_finditer(spark):
    import re

    text = "x 4.5 out of 5 stars and 3/5 then 12,345 reviews\n5 of 5 " * 9
    got = spark.createDataFrame([(text,)], "t string").select(signals.pattern_hits(F.col("t"), signals.RATING, 180, 260, 25)).collect()[0][0]
    want = [(m.group(1), m.start(), re.sub(r"\s+", " ", text[max(0, m.start() - 180): m.start() + 260]).strip()) for m in re.finditer(signals.RATING, text)]
    assert [tuple(h) for h in got] == want[:25] and len(want) > 25


def test_line_of(spark):
    df = spark.createDataFrame([("ab\ncd ef\ngh", 5)], "t string, p int")
    assert df.select(signals.line_of(F.col("t"), F.col("p"))).collect()[0][0] == "cd ef"


def test_token_matches_with_hot_tokens(spark):
    rng = random.Random(2)
    words = ["house", "casa", "real", "luna", "sol", "verde", "mar"]
    names = [(i, " ".join(rng.sample(words, rng.randint(1, 3))), rng.choice(["Troy", "Novi", ""])) for i in range(30)]
    pages = [(i, " ".join(["House", *rng.sample(words, 2), rng.choice(["troy", "novi"])])) for i in range(60)]
    left = spark.createDataFrame(names, "p int, name string, city string")
    right = spark.createDataFrame(pages, "g int, hay string")
    want = set()
    for i, name, city in names:
        for j, hay in pages:
            mine, theirs = set(name.split()), set(hay.lower().split())
            shared = {t for t in mine & theirs if len(t) > 2}
            in_city = bool(city) and city.lower() in hay.lower()
            if (in_city and shared) or (len(mine) >= 2 and len(shared) >= 2):
                want.add((i, j, ", ".join(sorted(shared))))
    got = matching.token_matches(left, right, "p", "g", F.col("name"), F.col("city"), F.col("hay"))
    assert {(r.p, r.g, r.shared_tokens) for r in got.collect()} == want


def test_token_matches_find_cities_inside_words(spark):
    places = spark.createDataFrame([(1, "casa", "NATION_1"), (2, "casa", "St. Paul"), (3, "casa", "o"), (4, "casa", ""), (5, "casa", None), (6, "casa", "nation_13")], "p int, name string, city string")
    pages = spark.createDataFrame([(1, "Casa NATION_12"), (2, "casa st. paul's"), (3, "Casa St Paul"), (4, None), (5, "")], "g int, hay string")
    got = matching.token_matches(places, pages, "p", "g", F.col("name"), F.col("city"), F.col("hay"))
    assert {(r.p, r.g) for r in got.collect()} == {(1, 1), (2, 2), (3, 1)}


def test_content_sources_with_a_dominant_copy(spark):
    data = [(i, f"s{i % 4}", "Same  text" if i % 3 else f"text {i}") for i in range(120)]
    df = spark.createDataFrame(data, "id int, source string, text string")
    got = dedupe.content_sources(df, dedupe.content_hash(F.col("text")), "id", "source")
    first = {}
    for i, _, t in data:
        first.setdefault(" ".join(t.split()).lower(), i)
    assert {(r.kept, r.id) for r in got.collect()} == {(first[" ".join(t.split()).lower()], i) for i, _, t in data}


def test_json_items(spark):
    document = '{"a":[{"name":" Taco ","price":0,"x":{"title":"Deep","subtitle":"s"}},{"name":"Menu","price":1},{"title":"No"}],"displayName":"Root","basePrice":""}'
    df = spark.createDataFrame([(1, document), (2, "broken"), (3, None)], "k int, d string")
    got = jsonwalk.json_items(df, "k", "d")
    assert rows(got.select("source_path", "name", "description", "price"), "n") == [
        ("", "Root", "", None), ("a[0]", "Taco", "", "0"), ("a[0].x", "Deep", "s", None)
    ]


def test_way_records(spark):
    ways = spark.createDataFrame([("w1", ["1", "2", "9", "1"]), ("w2", [])], "id string, node_refs array<string>")
    nodes = spark.createDataFrame([("1", 1.0, 10.0), ("2", 3.0, 20.0)], "id string, lat double, lon double")
    got = {r.id: r for r in poi.way_records(ways, nodes).collect()}
    assert [tuple(p) for p in got["w1"].geometry] == [(1.0, 10.0), (3.0, 20.0), (1.0, 10.0)]
    assert tuple(got["w1"].centroid) == (5 / 3, 40 / 3) and got["w1"].missing_node_refs == ["9"]
    assert got["w2"].geometry == [] and got["w2"].centroid is None and got["w2"].missing_node_refs is None


def test_first_per_group_is_cut_before_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    top = links.first_per_group(df, ["g"], ["id"], 2)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert top.count() == 6


def test_included_pages(spark):
    data = [("own", "u", "x"), ("linked", "u", "The Place (Fort St)"), ("linked", "u", "other"), ("panel", "https://grubhub.com/restaurant/1", "menu"), ("panel", "https://a.b", "menu")]
    df = spark.createDataFrame(data, "source string, url string, text string")
    kept = links.included_pages(df, "own", "linked", "(Fort St)", "panel", ["grubhub.com/restaurant"])
    assert kept.count() == 3


def test_grouped_text(spark):
    import pytest

    texts = spark.createDataFrame([("a", " A "), ("b", "B")], "key string, text string")
    groups = spark.createDataFrame([("g", 2, "a"), ("g", 1, "b")], "group string, pos int, key string")
    assert rows(reports.grouped_text(texts, groups, "key")) == [("g", "B\n\n\nA")]
    with pytest.raises(Exception, match="missing group member: zz"):
        reports.grouped_text(texts, groups.union(spark.createDataFrame([("g", 3, "zz")])), "key").collect()


def test_line_summary_counts_what_row_lines_cut(spark):
    lines = ["a | b | c | d", "| a | b | c | d |", "||a|b|c|d||", "|", "", "  ", None, "---", "| --- | :---: |", "a---|b", "<!-- a | b", "a||c|d", " | a | b | c |"]
    table = spark.createDataFrame([(m, line) for m in ("x", None) for line in lines], "model string, line string")
    want = comparison.model_summary(comparison.row_lines(table), 4)
    assert sorted(map(str, comparison.line_summary(table, 4).collect())) == sorted(map(str, want.collect()))
    assert {(r.parsed_rows, r.raw_rows, r.malformed_rows) for r in want.collect()} == {(4, 8, 4)}
