"""Real prices of $0.00 items from their required modifier groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dishframe.functions.price import MONEY, dollars, price_value
from dishframe.operators.skew import k_bounds

# How equal prices of a required group count: 'once', or 'times' the number of picks.
EQUAL_PRICE_MODES = ("once", "times")


def priced_groups(
    options: DataFrame,
    item: Sequence[str],
    pick: Column,
    mode: str,
    group: str = "group_pos",
    price: str = "price",
) -> DataFrame:
    """Per required group with at least one priced option: bounds, counts and its addition to the price.

    `pick` is NULL for a group that does not bind.
    """
    if mode not in EQUAL_PRICE_MODES:
        raise ValueError(f"equal-price mode must be one of {EQUAL_PRICE_MODES}")
    keys = [*item, group]
    priced = options.withColumn("_pick", pick).filter(F.col("_pick").isNotNull() & F.col(price).isNotNull())
    bounds = k_bounds(priced, keys, price, F.col("_pick"))
    equal = F.col("floor") * (F.lit(1) if mode == "once" else F.col("k"))
    same = F.col("floor") == F.col("ceiling")
    return bounds.select(
        *keys,
        "floor",
        "ceiling",
        F.col("n").alias("n_options"),
        F.col("k").alias("pick"),
        same.alias("equal_prices"),
        F.when(same, equal).otherwise(F.col("low")).alias("addition"),
    )


def item_additions(groups: DataFrame, item: Sequence[str]) -> DataFrame:
    """Resolved addition per item; items without a binding priced group do not occur."""
    return groups.groupBy(*item).agg(
        F.sum("addition").alias("addition"),
        F.count(F.lit(1)).alias("n_groups"),
        F.count_if("equal_prices").alias("n_equal_groups"),
    )


def note_parts(
    options: DataFrame, groups: DataFrame, item: Sequence[str], group: str = "group_pos", price: str = "price"
) -> DataFrame:
    """Options that a group's note lists: all when prices are equal, else the pricier ones."""
    keys = [*item, group]
    listed = F.col("equal_prices") | (F.col(price) > F.col("floor"))
    return options.filter(F.col(price).isNotNull()).join(groups, keys).filter(listed)


def render_notes(
    parts: DataFrame, item: Sequence[str], mode: str, group: str = "group_pos", name: str = "name", price: str = "price"
) -> DataFrame:
    """Note text per item: one sentence per group in order. A menu card bounds the length."""
    keys = [*item, group, "group_name", "equal_prices", "pick"]
    text = F.when(F.col("equal_prices"), F.col(name)).otherwise(
        F.concat(name, F.lit(" ("), dollars(F.col(price)), F.lit(")"))
    )
    ordered = lambda by, what: F.array_sort(F.collect_list(F.struct(F.col(by).alias("p"), what.alias("t"))))
    listed = parts.groupBy(*keys).agg(ordered("option_pos", text).alias("_parts"))
    names = F.array_join(F.col("_parts")["t"], ", ")
    choose = F.concat(F.lit("choose "), F.col("pick").cast("string"))
    if mode == "once":
        choose = F.when(F.col("pick") == 1, F.lit("choose one")).otherwise(choose)
    label = F.coalesce(F.nullif(F.col("group_name"), F.lit("")), F.lit("options"))
    note = F.when(F.col("equal_prices"), F.concat(label, F.lit(": "), choose, F.lit(" - "), names)).otherwise(
        F.concat(label, F.lit(": "), names, F.lit(" available for an extra charge"))
    )
    return (
        listed.withColumn("_note", note)
        .groupBy(*item)
        .agg(ordered(group, F.col("_note")).alias("_notes"))
        .select(*item, F.col("_notes")["t"].alias("notes"))
    )


def input_type_flags(options: DataFrame, item: Sequence[str], pick: Column, group: str = "group_pos") -> DataFrame:
    """Groups whose rule and input kind disagree: one pick means radio, several mean checkbox."""
    expected = F.when(F.col("pick") == 1, F.lit("radio")).otherwise(F.lit("checkbox"))
    return (
        options.withColumn("_pick", pick)
        .filter(F.col("_pick").isNotNull())
        .groupBy(*item, group)
        .agg(
            F.max("_pick").alias("pick"),
            F.max("group_name").alias("group_name"),
            F.max("rule_text").alias("rule_text"),
            F.bool_or(F.col("price").isNotNull()).alias("_priced"),
            # Input kinds are a handful, so the set stays small however many options there are.
            F.array_sort(F.collect_set(F.coalesce("input_type", F.lit("")))).alias("kinds"),
        )
        .filter(F.col("_priced"))
        .withColumn("expected", expected)
        .filter(F.col("kinds") != F.array("expected"))
        .select(
            *item,
            group,
            F.concat(
                F.lit("group '"), "group_name", F.lit("' rule says '"), "rule_text", F.lit("' (implies "), "expected",
                F.lit(") but option inputs are ["),
                F.array_join(
                    F.transform(F.filter("kinds", lambda k: k != ""), lambda k: F.concat(F.lit("'"), k, F.lit("'"))), ", "
                ),
                F.lit("]"),
            ).alias("flag"),
        )
    )


def explode_modifiers(captures: DataFrame, item: Sequence[str], groups: str = "groups") -> DataFrame:
    """(item, group_pos, group_name, rule_text, option_pos, name, price_text, price, input_type) rows."""
    return (
        captures.select(*item, F.posexplode(groups).alias("group_pos", "_g"))
        .select(*item, "group_pos", "_g.group_name", "_g.rule_text", F.posexplode("_g.options").alias("option_pos", "_o"))
        .select(
            *item, "group_pos", "group_name", "rule_text", "option_pos",
            F.coalesce("_o.name", F.lit("")).alias("name"),
            F.col("_o.price_text"),
            price_value(F.col("_o.price_text")).alias("price"),
            F.col("_o.input_type") if "input_type" in _option_fields(captures, groups) else F.lit(None).cast("string").alias("input_type"),
        )
    )


def modifiers_of_zero_priced(
    items: DataFrame, modifiers: DataFrame, capture: Sequence[str], key_of: Column, key: str = "key", price: str = "price"
) -> DataFrame:
    """Items without a price beside their captured modifiers, looked up by the item's key in its capture:
    its link on one platform, its position as text on another. Items without modifiers stay."""
    unpriced = F.col(price).isNull() | (F.col(price) == "$0.00")
    return items.filter(unpriced).withColumn(key, key_of).join(modifiers, [*capture, key], "left")


def _option_fields(captures: DataFrame, groups: str) -> list[str]:
    return captures.schema[groups].dataType.elementType["options"].dataType.elementType.fieldNames()


# The messages of the review flags.
STILL_ZERO_REPLACED = "price still $0.00 after checking modifiers - no required priced option found"
STILL_ZERO_APPENDED = "price still $0.00 after checking required groups"
NO_REQUIRED_GROUP = "price still $0.00 - no required modifier group found to establish a price"
CLOSED_PREVIEW = (
    "options not scraped: restaurant closed with no preorder slots available - could not enter "
    "Start order flow to reach item modals"
)
NOT_REACHED = "options not scraped: item modal could not be reached"


def apply_replacing(items: DataFrame, additions: DataFrame, notes: DataFrame, flags: DataFrame, item: Sequence[str]) -> DataFrame:
    """First platform rule: notes replace the description; a remaining zero is flagged.

    items carries price (text), description and has_modifiers.
    """
    flag_lists = flags.groupBy(*item).agg(F.array_sort(F.collect_list(F.struct("group_pos", "flag")))["flag"].alias("_flags"))
    zero = (F.col("price").isNull() | (F.col("price") == "$0.00")) & F.col("has_modifiers")
    total = F.coalesce("addition", F.lit(0).cast(MONEY))
    still = F.when(zero & (total == 0), F.array(F.lit(STILL_ZERO_REPLACED)))
    empty = F.array().cast("array<string>")
    all_flags = F.concat(
        F.when(zero, F.coalesce("_flags", empty)).otherwise(empty), F.coalesce(still, empty)
    )
    return (
        items.join(additions.select(*item, "addition"), item, "left")
        .join(notes, item, "left")
        .join(flag_lists, item, "left")
        .withColumn("review_flags", F.when(F.size(all_flags) > 0, all_flags))
        .withColumn(
            "description",
            F.when(zero & (F.size("notes") > 0), F.array_join("notes", "; ")).otherwise(F.coalesce("description", F.lit(""))),
        )
        .withColumn("price", F.when(zero, dollars(total)).otherwise(F.col("price")))
        .drop("addition", "notes", "_flags")
    )


def apply_appending(items: DataFrame, additions: DataFrame, notes: DataFrame, item: Sequence[str]) -> DataFrame:
    """Second platform rule: notes follow the description; missing or unpriced modals are flagged.

    items carries card_price (text), low, high (DECIMAL), description, has_modal and order_mode.
    """
    described = F.coalesce("description", F.lit(""))
    range_note = F.concat(F.lit("Options up to "), dollars(F.col("high")))
    with_range = F.when(
        F.col("high").isNotNull(), F.concat_ws("; ", F.nullif(described, F.lit("")), range_note)
    ).otherwise(described)
    zero = F.col("has_modal") & (F.col("low").isNull() | (F.col("low") == 0))
    resolved = zero & F.col("addition").isNotNull()
    with_notes = F.concat_ws("; ", F.nullif(described, F.lit("")), F.array_join("notes", "; "))
    flag = (
        F.when(~F.col("has_modal"), F.when(F.col("order_mode") == "preview", F.lit(CLOSED_PREVIEW)).otherwise(F.lit(NOT_REACHED)))
        .when(resolved & (F.col("addition") == 0), F.lit(STILL_ZERO_APPENDED))
        .when(zero & ~resolved, F.lit(NO_REQUIRED_GROUP))
    )
    return (
        items.join(additions.select(*item, "addition"), item, "left")
        .join(notes, item, "left")
        .withColumn("review_flags", F.when(flag.isNotNull(), F.array(flag)))
        .withColumn("missing_options", F.when(~F.col("has_modal"), F.lit(True)))
        .withColumn("description", F.when(resolved & (F.size("notes") > 0), with_notes).otherwise(with_range))
        .withColumn(
            "price",
            F.when(resolved, dollars(F.col("addition"))).otherwise(
                F.coalesce(dollars(F.col("low")), F.col("card_price"))
            ),
        )
        .drop("addition", "notes", "card_price", "low", "high")
    )


def price_by_size(options: DataFrame, item: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per (item, group, option, size): last price of the size, detail of the first sighting."""
    keys = [*item, "group_name", "name"]
    first = options.groupBy(*keys).agg(
        F.min_by(F.struct("detail", "default_selected"), F.struct(*order)).alias("_first")
    )
    last = options.groupBy(*keys, "size").agg(F.max_by(F.struct("price"), F.struct(*order)).alias("_last"))
    return last.join(first, keys).select(
        *keys, "size", F.col("_last.price").alias("price"), "_first.detail", "_first.default_selected"
    )


def pivot_sizes(sized: DataFrame, item: Sequence[str]) -> DataFrame:
    """Map of size to price per option; a dish has a handful of sizes."""
    return sized.groupBy(*item, "group_name", "name").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("size", "price")))).alias("price_by_size"),
        F.max("detail").alias("detail"),
        F.bool_or("default_selected").alias("default_selected"),
    )
