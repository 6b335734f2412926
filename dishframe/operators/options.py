"""Option trees of item pages: index, price bounds, badges.

A page is one row and its tree at most two levels deep, so all of this is array work
inside the row: one projection, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dishframe.functions.price import MONEY, cents, dollars
from dishframe.functions.sizes import rename_variant_group
from dishframe.functions.text import let, or_default, present

MODIFIER = "extra_option"
CROSS_SELL = "item"

# Dietary tags, their labels and patterns.
DIETARY_TAGS = (
    ("gluten_free", "Gluten free available", r"(?i)gluten[\s_-]?free|\bGF\b"),
    ("vegan", "Vegan option available", r"(?i)\bvegan\b"),
    ("vegetarian", "Vegetarian option available", r"(?i)\bvegetarian\b"),
    ("dairy_free", "Dairy free available", r"(?i)dairy[\s_-]?free"),
    ("cauliflower_crust", "Cauliflower crust available", r"(?i)cauliflower"),
)

def _zero() -> Column:
    return F.lit(0).cast("decimal(22,2)")


def modifiers(groups: Column) -> Column:
    """Raw groups that modify the item; a group without a type is one."""
    return F.filter(groups, lambda g: F.coalesce(present(g["type"]), F.lit(MODIFIER)) == MODIFIER)


def cross_sells(groups: Column) -> Column:
    """Raw groups that point at other items, as (group, items)."""
    return F.transform(
        F.filter(groups, lambda g: g["type"] == CROSS_SELL),
        lambda g: F.struct(
            or_default(g["name"], "Recommended").alias("group"),
            F.transform(
                g["options"],
                lambda o: F.struct(F.coalesce(o["name"], F.lit("")).alias("name"), cents(o["unitAmount"]).alias("price")),
            ).alias("items"),
        ),
    )


def _group(g: Column, options: Column) -> Column:
    return F.struct(
        or_default(g["name"], "Options").alias("group"),
        (~F.coalesce(g["isOptional"], F.lit(True))).alias("required"),
        g["minNumOptions"].alias("min_select"),
        g["maxNumOptions"].alias("max_select"),
        F.coalesce(g["numFreeOptions"], F.lit(0)).alias("free_count"),
        g["selectionNode"].alias("selection"),
        options.alias("options"),
    )


def _option(o: Column, *more: Column) -> Column:
    return F.struct(
        F.coalesce(o["name"], F.lit("")).alias("name"),
        cents(o["unitAmount"]).alias("price"),
        F.coalesce(o["description"], F.lit("")).alias("description"),
        F.when(o["defaultQuantity"] > 0, o["defaultQuantity"]).alias("default_quantity"),
        *more,
    )


def build_groups(raw: Column) -> Column:
    """Standard modifier groups, two levels, cents as dollars."""
    inner = lambda o: F.transform(
        modifiers(o["nestedExtrasList"]), lambda g: _group(g, F.transform(g["options"], lambda o: _option(o)))
    )
    return F.transform(
        modifiers(raw),
        lambda g: _group(g, F.transform(g["options"], lambda o: _option(o, inner(o).alias("nested")))),
    )


def assert_two_levels(raw: Column) -> Column:
    """Fail instead of losing data when an option of the second level carries groups of its own.

    Expects the second level's nestedExtrasList as JSON text.
    """
    deeper = F.exists(
        raw,
        lambda g: F.exists(
            g["options"],
            lambda o: F.exists(
                o["nestedExtrasList"],
                lambda n: F.exists(
                    n["options"],
                    lambda p: ~F.coalesce(p["nestedExtrasList"], F.lit("[]")).isin("[]", "", "null"),
                ),
            ),
        ),
    )
    return F.when(F.coalesce(deeper, F.lit(False)), F.raise_error(F.lit("option tree deeper than two levels")).cast("boolean")).otherwise(True)


def _sum(values: Column) -> Column:
    return F.aggregate(values, _zero(), lambda acc, v: (acc + v).cast("decimal(22,2)"))


def _bounds(groups: Column, lows, highs) -> tuple[Column, Column]:
    """Cheapest and priciest way to satisfy the required groups."""
    required = F.filter(groups, lambda g: g["required"] & (F.size(g["options"]) > 0))
    picks = lambda g: F.coalesce(F.nullif(g["min_select"], F.lit(0)), F.lit(1))
    low = F.transform(required, lambda g: _sum(F.slice(F.array_sort(lows(g["options"])), F.lit(1), picks(g))))
    high = F.transform(
        required, lambda g: _sum(F.slice(F.sort_array(highs(g["options"]), asc=False), F.lit(1), picks(g)))
    )
    return _sum(low), _sum(high)


def required_bounds(groups: Column) -> Column:
    """Struct (low, high) over standard groups; a nested required group counts under its option."""
    plain = lambda options: F.transform(options, lambda o: o["price"].cast("decimal(22,2)"))

    def with_nested(side: int):
        def per_option(o: Column) -> Column:
            nested = F.coalesce(_bounds(o["nested"], plain, plain)[side], _zero())
            return (o["price"] + nested).cast("decimal(22,2)")

        return lambda options: F.transform(options, per_option)

    low, high = _bounds(groups, with_nested(0), with_nested(1))
    return F.struct(F.coalesce(low, _zero()).alias("low"), F.coalesce(high, _zero()).alias("high"))


def option_rows(groups: Column) -> Column:
    """The tree in preorder as (group, name, required, parent_group, parent_option, price)."""
    row = lambda g, o, pg, po: F.struct(
        g["group"].alias("group"),
        o["name"].alias("name"),
        g["required"].alias("required"),
        pg.alias("parent_group"),
        po.alias("parent_option"),
        o["price"].alias("price"),
    )
    none = F.lit(None).cast("string")

    def under(g: Column, o: Column) -> Column:
        rows = F.flatten(
            F.transform(o["nested"], lambda n: F.transform(n["options"], lambda p: row(n, p, g["group"], o["name"])))
        )
        own = F.array(row(g, o, none, none))
        return F.when(rows.isNotNull(), F.concat(own, rows)).otherwise(own)

    return F.flatten(F.transform(groups, lambda g: F.flatten(F.transform(g["options"], lambda o: under(g, o)))))


def option_index(rows: Column) -> Column:
    """One entry per (group, name): the first row fixes required, parent and price.

    `rows` should be a plain column: it is read once per entry.

    available_when lists the parents in order, repeats included; price_by_parent keeps the
    last price of each parent.
    """
    key = lambda r: F.struct(r["group"].alias("group"), r["name"].alias("name"))

    def parent_prices(nested: Column) -> Column:
        last = lambda p: F.element_at(F.filter(nested, lambda r: r["parent_option"] == p), -1)["price"]
        return F.transform(
            F.array_distinct(nested["parent_option"]), lambda p: F.struct(p.alias("parent"), last(p).alias("price"))
        )

    def entry(same: Column) -> Column:
        first = F.element_at(same, 1)
        nested = F.filter(same, lambda r: r["parent_option"].isNotNull())
        some = F.exists(same, lambda r: r["parent_option"].isNotNull())
        return F.struct(
            first["name"].alias("name"),
            first["group"].alias("group"),
            first["required"].alias("required"),
            first["parent_group"].alias("parent_group"),
            F.when(first["parent_group"].isNull(), first["price"]).alias("price"),
            F.when(some, nested["parent_option"]).alias("available_when"),
            F.when(some, F.map_from_entries(let(nested, parent_prices))).alias("price_by_parent"),
        )

    same_key = lambda k: F.filter(rows, lambda r: (r["group"] == k["group"]) & (r["name"] == k["name"]))
    return F.transform(F.transform(F.array_distinct(F.transform(rows, key)), same_key), entry)


def dietary_badges(index: Column, item_text: Column) -> Column:
    """(tag, label, matches): options that fit a tag, or no matches when only the item text fits."""
    badge = lambda tag, label, pattern: F.struct(
        F.lit(tag).alias("tag"),
        F.lit(label).alias("label"),
        F.filter(index, lambda r: r["name"].rlike(pattern)).alias("matches"),
        item_text.rlike(pattern).alias("in_text"),
    )
    hits = F.filter(
        F.array(*[badge(*row) for row in DIETARY_TAGS]), lambda b: (F.size(b["matches"]) > 0) | b["in_text"]
    )
    return F.transform(hits, lambda b: F.struct(b["tag"].alias("tag"), b["label"].alias("label"), b["matches"].alias("matches")))


def rename_variant_groups(groups: Column) -> Column:
    return F.transform(groups, lambda g: g.withField("group", rename_variant_group(g["group"])))


def structure_signature(groups: Column) -> Column:
    """Groups and option names without prices; equal for two sizes of one dish."""
    return F.to_json(
        F.transform(
            groups,
            lambda g: F.struct(g["group"].alias("group"), F.transform(g["options"], lambda o: o["name"]).alias("names")),
        )
    )


def parse_item_pages(pages: DataFrame, page: str = "item_page") -> DataFrame:
    """Standard items from item pages; rows without a page are dropped."""
    p = F.col(page)
    keep = [c for c in pages.columns if c not in (page, "name", "section")]
    built = pages.filter(p.isNotNull()).select(
        *keep,
        or_default(F.col("section"), "Uncategorized").alias("section"),
        F.coalesce(present(p["itemHeader"]["name"]), F.col("name"), F.lit("")).alias("title"),
        F.coalesce(p["itemHeader"]["description"], F.lit("")).alias("ingredients_or_description"),
        cents(p["itemHeader"]["unitAmount"]).alias("_base"),
        build_groups(p["optionLists"]).alias("groups"),
        cross_sells(p["optionLists"]).alias("cross_sell"),
    )
    walked = built.select(
        "*", required_bounds(F.col("groups")).alias("_bounds"), option_rows(F.col("groups")).alias("_rows")
    )
    indexed = walked.select(
        "*",
        (F.col("_base") + F.col("_bounds.low")).cast(MONEY).alias("price_min"),
        (F.col("_base") + F.col("_bounds.high")).cast(MONEY).alias("price_max"),
        option_index(F.col("_rows")).alias("option_index"),
    ).drop("_base", "_bounds", "_rows")
    text = F.concat_ws(" ", "title", "ingredients_or_description")
    return indexed.select(
        "*", dollars(F.col("price_min")).alias("price"), dietary_badges(F.col("option_index"), text).alias("dietary_badges")
    )


def unnest(items: DataFrame, keys: Sequence[str], array: str) -> DataFrame:
    """Rows of a computed struct array.

    The outer form keeps Spark from adding a size test on the array, which would be pushed
    below and evaluate the whole tree a second time.
    """
    return (
        items.select(*keys, F.explode_outer(array).alias("_e")).filter(F.col("_e").isNotNull()).select(*keys, "_e.*")
    )


def badge_counts(items: DataFrame) -> DataFrame:
    return unnest(items, [], "dietary_badges").groupBy("tag").agg(F.count(F.lit(1)).alias("n")).orderBy("tag")


def nested_option_count(groups: Column) -> Column:
    """How many options carry groups of their own."""
    per_group = F.transform(groups, lambda g: F.size(F.filter(g["options"], lambda o: F.size(o["nested"]) > 0)))
    return F.aggregate(per_group, F.lit(0), lambda acc, n: acc + n)
