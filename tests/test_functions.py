"""Scalar functions on written-out cases."""

import html as html_module
from decimal import Decimal
from urllib.parse import urljoin

from pyspark.sql import functions as F

from dishframe.functions import html, poi, price, sizes, text, urls


def values(spark, function, inputs):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(function(F.col("v"))).collect()]


def test_whitespace(spark):
    assert values(spark, text.strip, [" a\t", " b\n", "c  d"]) == ["a", "b", "c  d"]
    assert values(spark, text.collapse, ["  a \n b  c  ", "x y", "\t"]) == ["a b c", "x y", ""]
    assert values(spark, text.drop_control, ["a\x07b  c\td\ne"]) == ["ab c d\ne"]


def test_labels_and_slugs(spark):
    assert values(spark, text.display_label, ["tex-mex", " ice_cream", "bbq's"]) == ["Tex-Mex", "Ice Cream", "Bbq'S"]
    assert values(spark, lambda c: text.slug(c, 8, "page"), ["Hello, World!", "--"]) == ["hello-wo", "page"]
    assert values(spark, text.model_slug, ["a/b:c d"]) == ["a__b-c-d"]


def test_tokens(spark):
    assert values(spark, text.split_tokens, ["A; b ;;C", None]) == [["a", "b", "c"], []]
    assert values(spark, text.name_tokens, ["The Taco Bar of LA 24x7"]) == [["taco", "24x7"]]


def test_dish_keys(spark):
    assert values(spark, text.basic_dish_key, [" Mac & Cheese!", "Enchiladas/Enchiladas Suizas"]) == ["mac and cheese", "enchiladas"]
    assert values(spark, text.split_dish_key, ["Refried or Charro Beans", "2 Burritos"]) == ["beans", "burritos"]
    assert values(spark, text.side_choice_key, ["Rice and Beans, rice; Chips/Salsa!"]) == ["beans, chips, rice, salsa"]
    assert values(spark, text.first_number, ["pick 2 of 3", " any "]) == ["2", "any"]


def test_entities(spark):
    cases = ["Chips &amp; Salsa &amp;lt;", "a &hellip; &#8364;&#x1F600;", "caf&#233; &euro;5 & more &nosuch; &", "&notin;&lt;b&gt;", "none", ""]
    assert values(spark, text.unescape, cases) == [html_module.unescape(c) for c in cases]
    assert values(spark, text.unescape, [None, "&#0; &#xD800;"]) == [None, "&#0; &#xD800;"]


def test_links_in_any_quoting(spark):
    page = """<a href="/a?x=1&amp;y=2">1</a><a class=z href='b.html'>2</a><A HREF=c>3</A><form data-action="no" action='/f'></form>
      <a data-href="no">4</a><a href="">5</a>"""
    assert values(spark, html.links, [page]) == [["/a?x=1&y=2", "b.html", "c", "/f"]]


def test_resolve_as_urljoin(spark):
    bases = ["https://h", "https://h/", "https://h/a/b", "https://h/a/b/?q=1#f"]
    found = ["x", "/x/y?z=1", "//cdn.example/y", "?q=1", "../z", "#f", "./x", "../../../up", "a/./b/../c/", "..", "", "mailto:a@b", "http://o/p", "a?b=../c"]
    pairs = [(b, l) for b in bases for l in found]
    got = spark.createDataFrame(pairs, "b string, l string").select("b", "l", urls.resolve(F.col("b"), F.col("l")).alias("r")).collect()
    wanted = {(b, l): urljoin(b, l) for b, l in pairs}
    assert [(r.b, r.l, r.r) for r in got if r.r != wanted[r.b, r.l]] == []


def test_jsonish(spark):
    cases = ['```json\n{"a": 1}\n```', 'Sure: {"a": {"b": 2}} done', '{"a": 1}', "none"]
    assert values(spark, text.jsonish, cases) == ['{"a": 1}', '{"a": {"b": 2}}', '{"a": 1}', "none"]


def test_message_text(spark):
    rows = spark.createDataFrame(
        [(1, " plain ", None), (2, None, [("a",), ("",), ("b",)])], "i int, content string, parts array<struct<text:string>>"
    )
    shown = rows.orderBy("i").select(text.message_text(F.col("content"), F.col("parts")))
    assert [r[0] for r in shown.collect()] == ["plain", "a\n\nb"]


def test_prices(spark):
    assert values(spark, price.price_value, ["$1,234.50 each", "Not available", None]) == [Decimal("1234.50"), None, None]
    assert values(spark, price.normalize_price, ["$ 5", "12.5", "ask "]) == ["$5.00", "$12.50", "ask"]
    assert values(spark, price.is_invalid_price, ["$0.00", "ask", "3"]) == [True, True, False]
    assert values(spark, price.price_range, ["$5.00 - $7.50", "$3.25", "x"]) == [
        (Decimal("5.00"), Decimal("7.50")), (Decimal("3.25"), None), (None, None)
    ]
    assert values(spark, price.cents, ["1299", "bad", None]) == [Decimal("12.99"), Decimal("0.00"), Decimal("0.00")]
    assert values(spark, price.looks_like_price, ["$5", "five", "$" + "x" * 80]) == [True, False, False]
    assert values(spark, price.card_price, ["Dish $5.00+ add", "none"]) == ["$5.00+", None]


def test_rules(spark):
    assert values(spark, price.required_count, ["Optional 3", "Required - choose 2", "required", "any", None]) == [None, 2, 1, None, None]
    assert values(spark, price.pick_rule, ["must pick 2 - 4", "Must pick", "pick up to 3", "pick any", None]) == [
        (True, 2, 4), (True, 1, 1), (False, None, 3), (False, None, None), (False, None, None)
    ]


def test_card_texts(spark):
    assert values(spark, price.is_sold_out, ["Tacos\n86'd today", "ok", None]) == [True, False, False]
    assert values(spark, price.popularity, ["Tacos\n#2 most liked\n87% (56)\nPopular", "Tacos"]) == [
        (2, 87, 56, True), (None, None, None, False)
    ]


def test_menu_codes(spark):
    cases = [
        "NO.6. Pepper Steak", "C17.Soup", "18. Fried Rice", "1.50 TACO (TUESDAY)", "2 oz Guacamole", "4 Corner Pizza", "S8. ", " 33. Egg ",
    ]
    got = [(r["menu_code"], r["title"]) for r in values(spark, sizes.split_menu_code, cases)]
    assert got == [
        ("NO.6", "Pepper Steak"), ("C17", "Soup"), ("18", "Fried Rice"), (None, "1.50 TACO (TUESDAY)"), (None, "2 oz Guacamole"),
        (None, "4 Corner Pizza"), (None, "S8."), ("33", "Egg"),
    ]


def test_sizes(spark):
    cases = [
        "Small Thin Crust", "Deep Dish - Large", "X-Large", 'Pizza (Extra Large)', '12" Pie', "14 inch - Combo", "Large", "Smallville",
        "Kids Small Fries Large", "Medley", "Party Tray Wings", "Wings party tray", "extra large",
    ]
    got = [tuple(r) for r in values(spark, sizes.split_size, cases)]
    assert got == [
        ("Small", "Thin Crust"), ("Large", "Deep Dish"), ("Large", "X"), ("Extra Large", "Pizza"), ('12"', "Pie"), ('14"', "Combo"),
        (None, "Large"), (None, "Smallville"), ("Large", "Kids Small Fries"),
        (None, "Medley"), ("Party Tray", "Wings"), ("Party Tray", "Wings"), ("Large", "extra"),
    ]


def test_size_order(spark):
    rows = spark.createDataFrame([(s,) for s in ["XL", '14"', "Small", '9"', "Huge", "Jr"]], "s string")
    assert [r.s for r in rows.orderBy(sizes.size_order(F.col("s"))).collect()] == ['9"', '14"', "Jr", "Small", "XL", "Huge"]


def test_urls(spark):
    assert values(spark, urls.site, ["https://www.A.com/x", "http://b.org", "/rel"]) == ["a.com", "b.org", ""]
    assert values(spark, urls.unwrap, ["https://www.google.com/url?q=https%3A%2F%2Fx.io%2Fa&sa=U", "https://x.io/url2"]) == [
        "https://x.io/a", "https://x.io/url2"
    ]
    assert values(spark, urls.unquote, ["a%20b+c", "bad%zz"]) == ["a b+c", "bad%zz"]
    classify = lambda c: urls.source_of(c, F.lit("google_search"))
    assert values(spark, classify, ["https://www.YELP.com/biz/x", "https://maps.google.com/", "https://a.b"]) == [
        "yelp", "google_maps", "google_search"
    ]
    assert values(spark, urls.is_provider_link, ["https://x.SQUARE.site/", "https://a.b"]) == [True, False]
    assert values(spark, urls.looks_like_menu, ["Our $5 lunch", "closed"]) == [True, False]
    resolved = lambda c: urls.resolve(F.lit("https://a.com/x/y?q=1"), c)
    assert values(spark, resolved, ["/m", "z", "https://b.c/d"]) == ["https://a.com/m", "https://a.com/x/z", "https://b.c/d"]


PAGE = (
    '<html><head><title> A &amp; B </title><meta name="description" content="Good food"><style>x{}</style></head>'
    "<body><!-- no --><h1>Menu</h1><script>var s = '<p>';</script><p>Tacos<br>two</p>tacos"
    '<h2> <b>Sides</b> </h2><a href="/menu?a=1&amp;b=2">m</a><form action="/go"></form></body></html>'
)


def test_pages(spark):
    assert values(spark, html.visible_lines, [PAGE]) == [["A & B", "Menu", "Tacos", "two", "tacos", "Sides", "m"]]
    assert values(spark, html.title, [PAGE, "<p>"]) == ["A & B", ""]
    assert values(spark, html.meta_description, [PAGE]) == ["Good food"]
    assert values(spark, html.headings, [PAGE]) == [["Menu", "Sides"]]
    assert values(spark, html.links, [PAGE]) == [["/menu?a=1&b=2", "/go"]]


def test_script_json(spark):
    assert values(spark, html.json_or_null, ['{"a":1}', "{&quot;a&quot;:1}", "var x", ""]) == ['{"a":1}', '{"a":1}', None, None]


def tag_case(spark, pairs, function):
    rows = spark.createDataFrame([(pairs,)], "t array<struct<_k:string,_v:string>>")
    return rows.select(function(poi.tag_map(F.col("t")))).collect()[0][0]


def test_tag_maps(spark):
    same = lambda m: m
    assert tag_case(spark, [("diet", "kosher"), ("diet:vegan", "yes")], same) == {"diet": "subtype", "diet:vegan": "yes"}
    assert tag_case(spark, [("diet:vegan", "yes"), ("diet", "kosher")], same) == {"diet:vegan": "yes", "diet": "kosher"}
    assert tag_case(spark, [("a", "1"), ("a", None), (None, "x")], same) == {"a": ""}
    assert tag_case(spark, [("diet:vegan", "Only"), ("diet:halal", "no")], poi.diets) == ["vegan"]


def test_restaurants(spark):
    assert tag_case(spark, [("amenity", "bank; Cafe")], poi.is_restaurant) is True
    assert tag_case(spark, [("disused:amenity", "restaurant")], poi.is_restaurant) is False
    assert tag_case(spark, [("diet:vegan", "no")], poi.is_restaurant) is True


def test_cuisine_match(spark):
    found = tag_case(spark, [("name", "TAQUERÍA Lupita"), ("cuisine", "tex-mex;pizza")], poi.mexican_match)
    assert found.confidence == "high"
    assert found.reasons == ["cuisine='tex-mex;pizza' contains tex-mex", "name/url keyword: taqueria"]
    weak = tag_case(spark, [("brand", "El Barzón")], poi.mexican_match)
    assert (weak.confidence, weak.reasons) == ("likely", ["name/url looks Mexican: el barzon"])
    assert tag_case(spark, [("name", "La Pita")], poi.mexican_match) is None


def test_kitchen_review(spark):
    found = tag_case(spark, [("name", " Pizza Pub "), ("operator", "X")], poi.kitchen_review)
    assert (found.possible_restaurant, found.matched_hints, found.searched_text) == (True, ["pizza", "pub"], "pizza pub x")
