"""Flat platform menus: rollup folding, defaults, section order, enrichment, merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from dishframe.functions.text import or_default, present
from dishframe.operators.skew import Heavy, salted_lookup


def clean_cards(
    cards: DataFrame,
    section: str = "section",
    name: str = "name",
    rollup: str | None = None,
    default_section: str = "Uncategorized",
    keep_unnamed: bool = False,
) -> DataFrame:
    """Drop the rollup section and, unless kept, unnamed cards; fill the default section."""
    if rollup is not None:
        cards = cards.filter(~F.col(section).eqNullSafe(F.lit(rollup)))
    if not keep_unnamed:
        cards = cards.filter(present(F.col(name)).isNotNull())
    return cards.withColumn(section, or_default(F.col(section), default_section)).withColumn(
        name, F.coalesce(name, F.lit(""))
    )


def rollup_fold(
    cards: DataFrame,
    menu: Sequence[str],
    item: str,
    rollup: str,
    label: str,
    spread: Sequence[str],
    section: str = "section",
    special: str = "special",
    heavy: Heavy = None,
) -> DataFrame:
    """Cards outside the rollup; those whose item also occurs in the rollup get the label."""
    in_rollup = F.col(section).eqNullSafe(F.lit(rollup))
    listed = (
        cards.filter(in_rollup & present(F.col(item).cast("string")).isNotNull())
        .select(*menu, item)
        .distinct()
        .withColumn("_listed", F.lit(True))
    )
    rest = cards.filter(~in_rollup)
    return (
        salted_lookup(rest, listed, [*menu, item], spread, heavy=heavy)
        .withColumn(special, F.when(F.col("_listed"), F.lit(label)))
        .drop("_listed")
    )


def rollup_count(
    cards: DataFrame, menu: Sequence[str], item: str, rollup: str, section: str = "section"
) -> DataFrame:
    """Per menu: how many distinct rollup items also occur in a real section."""
    in_rollup = F.col(section).eqNullSafe(F.lit(rollup))
    seen = cards.groupBy(*menu, item).agg(
        F.bool_or(in_rollup).alias("_rolled"), F.bool_or(~in_rollup).alias("_real")
    )
    return seen.groupBy(*menu).agg(F.count_if(F.col("_rolled") & F.col("_real")).alias("folded"))


def section_order(
    cards: DataFrame, menu: Sequence[str], section: str = "section", position: str = "pos", rank: Column | None = None
) -> DataFrame:
    """Sections of a menu in order of first appearance.

    `rank` (default 0) puts whole classes of sections first, e.g. structured before card-only ones.
    """
    first = cards.groupBy(*menu, section).agg(
        F.min(F.struct((F.lit(0) if rank is None else rank).alias("r"), F.col(position).alias("p"))).alias("_first"),
        F.count(F.lit(1)).alias("n_items"),
    )
    order = Window.partitionBy(*menu).orderBy("_first", section)
    return first.select(*menu, section, F.row_number().over(order).alias("section_pos"), "n_items")


def badge_flag(
    items: DataFrame,
    badges: DataFrame | None,
    menu: Sequence[str],
    item: str,
    card_text: str,
    phrase: str,
    label: str,
    spread: Sequence[str],
    heavy: Heavy = None,
) -> DataFrame:
    """Label from a badge table where there is one, else from the phrase on any card of the item."""
    if badges is None:
        marked = items.filter(F.contains(F.col(card_text), F.lit(phrase)))
    else:
        marked = badges
    marked = marked.filter(F.col(item).isNotNull()).select(*menu, item).distinct().withColumn("_marked", F.lit(True))
    return (
        salted_lookup(items, marked, [*menu, item], spread, heavy=heavy)
        .withColumn("special", F.when(F.col("_marked"), F.lit(label)))
        .drop("_marked")
    )


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], count: str | None = None
) -> DataFrame:
    """One row per key, the first in the given order; combines map-side, so copies never pile up."""
    rest = [c for c in df.columns if c not in keys]
    aggs = [F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")]
    if count is not None:
        aggs.append(F.count(F.lit(1)).alias(count))
    picked = df.groupBy(*keys).agg(*aggs)
    return picked.select(*keys, "_row.*", *([count] if count else []))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the last in the given order."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, "_row.*")


def enrich_by_name(
    items: DataFrame, ratings: DataFrame, menu: Sequence[str], name: str, spread: Sequence[str], heavy: Heavy = None
) -> DataFrame:
    """Optional rating fields joined onto menu items by name.

    Of several cards with a name the featured copy wins, else the first.
    """
    cards = keep_first(
        ratings.filter(present(F.col(name)).isNotNull()),
        [*menu, name],
        [F.when(F.col("in_featured_carousel"), 0).otherwise(1), "pos"],
    ).drop("pos")
    joined = salted_lookup(items, cards, [*menu, name], spread, heavy=heavy)
    featured = F.col("in_featured_carousel")
    return (
        joined.withColumn("special", F.when(featured, F.lit("featured item")))
        .withColumn("featured_rank", F.when(featured, F.col("featured_rank")))
        .withColumn("like_review_count", F.when(F.col("like_percent").isNotNull(), F.col("like_review_count")))
        .withColumn("popular", F.when(F.col("is_popular"), F.lit(True)))
        .drop("in_featured_carousel", "is_popular")
    )


def structured_card_merge(
    structured: DataFrame,
    cards: DataFrame,
    menu: Sequence[str],
    rollup: str = "Most Ordered",
    default_section: str = "Uncategorized",
) -> DataFrame:
    """Full outer merge of structured menu rows and card rows into one row per title.

    structured: (menu, title, section, pos, description, price)
    cards:      (menu, title, section, pos, description, price, featured_rank, like_percent, like_review_count)
    Section: first real structured section, else the card's, else the rollup. The longest
    structured description wins; cards without structured rows are appended.
    """
    rolled = F.col("section") == rollup
    text = F.coalesce("description", F.lit(""))
    real_pos = F.when(~rolled, F.col("pos"))
    from_menu = structured.groupBy(*menu, "title").agg(
        F.min_by("section", real_pos).alias("m_section"),
        F.coalesce(F.min_by(F.struct("price"), real_pos), F.min_by(F.struct("price"), "pos")).alias("m_price"),
        F.max_by(text, F.struct(F.length(text), -F.col("pos"))).alias("m_description"),
        F.bool_or(rolled).alias("m_rolled"),
        F.min("pos").alias("m_pos"),
    )
    from_cards = keep_last(cards, [*menu, "title"], ["pos"]).select(
        *menu,
        "title",
        present(F.col("section")).alias("c_section"),
        F.col("price").alias("c_price"),
        F.coalesce("description", F.lit("")).alias("c_description"),
        F.col("pos").alias("c_pos"),
        "featured_rank",
        "like_percent",
        "like_review_count",
        F.lit(True).alias("c_known"),
    )
    listed = F.col("m_pos").isNotNull()
    return from_menu.join(from_cards, [*menu, "title"], "full_outer").select(
        *menu,
        "title",
        F.when(listed, F.coalesce("m_section", "c_section", F.lit(rollup)))
        .otherwise(F.coalesce("c_section", F.lit(default_section)))
        .alias("section"),
        F.when(listed, F.col("m_description")).otherwise(F.col("c_description")).alias("description"),
        F.when(listed, F.col("m_price")["price"])
        .otherwise(F.concat(F.lit("$"), F.col("c_price")))
        .alias("price"),
        F.when(listed & F.col("m_rolled"), F.lit("featured item"))
        .when(~listed & F.col("featured_rank").isNotNull(), F.lit("featured item"))
        .alias("special"),
        "featured_rank",
        "like_percent",
        F.when(F.col("like_percent").isNotNull(), F.col("like_review_count")).alias("like_review_count"),
        F.when(listed, F.col("m_section").isNotNull()).otherwise(F.lit(False)).alias("in_structured_section"),
        F.coalesce("m_pos", "c_pos").alias("pos"),
        listed.alias("from_structured"),
    )


def menu_counters(items: DataFrame, menu: Sequence[str]) -> DataFrame:
    """Sections, items, specials, rated and popular items per menu."""
    return items.groupBy(*menu).agg(
        F.count_distinct("section").alias("n_sections"),
        F.count(F.lit(1)).alias("n_items"),
        F.count_if(F.col("special").isNotNull()).alias("n_special"),
        F.count_if(F.col("like_percent").isNotNull()).alias("n_rated"),
        F.count_if(F.coalesce("popular", F.lit(False))).alias("n_popular"),
    )
