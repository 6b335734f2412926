"""Operators that depend on document order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dishframe.functions.price import looks_like_price, price_slot, tidy_price
from dishframe.functions.text import collapse, first, join_present, let, slug
from dishframe.operators.folding import keep_first
from dishframe.operators.ranking import group_index
from dishframe.operators.skew import CHUNK, Heavy, carry_forward, salted_lookup, sized_lookup, with_context

# Date forms that mark a review line.
REVIEW_DATE = (
    r"(?i)\b(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec)[a-z]*\.?\s+\d{1,2},?\s+\d{4}\b"
    r"|\b\d+\s+(?:minute|hour|day|week|month|year)s?\s+ago\b"
)


def is_review_line(line: Column) -> Column:
    lowered = F.lower(line)
    return (
        line.rlike(REVIEW_DATE)
        | F.contains(lowered, F.lit("stars"))
        | F.contains(lowered, F.lit("rated"))
        | F.contains(lowered, F.lit("review"))
    )


def review_snippets(lines: Column, before: int = 2, after: int = 4, shortest: int = 45, longest: int | None = None, limit: int | None = None) -> Column:
    """Context of every signal line of one page, distinct; the caller may cut length and number."""
    around = lambda ls, i: F.array_join(
        F.slice(ls, F.greatest(i - before, F.lit(0)) + 1, F.least(i, F.lit(before)) + after + 1), " "
    )
    spots = let(
        lines,
        lambda ls: F.filter(
            F.transform(
                ls, lambda line, i: F.when(is_review_line(line), F.struct(i.alias("i"), around(ls, i).alias("w")))
            ),
            lambda s: s.isNotNull() & (F.length(s["w"]) >= shortest),
        ),
    )
    # A window longer than the cut never equals a stored snippet, so it is never a repeat.
    keyed = F.array_distinct(
        F.transform(spots, lambda s: F.struct(s["w"].alias("w"), (F.lit(None).cast("int") if longest is None else F.when(F.length(s["w"]) > longest, s["i"])).alias("i")))
    )
    return first(F.transform(keyed, lambda s: s["w"] if longest is None else F.substring(s["w"], 1, longest)), limit)


def context_rows(
    lines: DataFrame, keys: Sequence[str], position: str, line: str, before: int = 2, after: int = 4, width: int = CHUNK
) -> DataFrame:
    """Table form of the context window: lines -before..+after around each row, joined by a space."""
    return (
        with_context(lines, keys, position, line, "_around", before, after, width)
        .withColumn("context", F.array_join("_around", " "))
        .drop("_around")
    )


def nearest_heading(
    rows: DataFrame, keys: Sequence[str], position: str, heading: Column, name: str = "section", width: int = CHUNK
) -> DataFrame:
    """Last heading at or before each row; NULL before the first."""
    return carry_forward(rows, keys, position, heading, name, width)


def attach_orphan_prices(
    rows: DataFrame, keys: Sequence[str], position: str, titled: Column, price: Column, orphan: Column, width: int = CHUNK
) -> DataFrame:
    """Titled rows, each without a price taking the first orphan price that follows it.

    `orphan` is the usable price of an untitled row, else NULL.
    """
    owner = carry_forward(rows, keys, position, F.when(titled, F.col(position)), "_owner", width)
    others = [c for c in rows.columns if c not in (*keys, position)]
    per_title = (
        owner.filter(F.col("_owner").isNotNull())
        .withColumn("_orphan", F.when(~titled, orphan))
        .groupBy(*keys, "_owner")
        .agg(
            F.max_by(F.struct(*others, price.alias("_price")), F.when(titled, F.lit(1))).alias("_row"),
            F.min_by("_orphan", F.when(F.col("_orphan").isNotNull(), F.col(position))).alias("_first_orphan"),
        )
    )
    return per_title.select(
        *keys, F.col("_owner").alias(position), "_row.*", "_first_orphan"
    ).withColumn("resolved_price", F.coalesce("_price", "_first_orphan")).drop("_price", "_first_orphan")


def menu_page_items(rows: DataFrame, keys: Sequence[str], position: str, width: int = CHUNK) -> DataFrame:
    """Items of printed menu pages: (title, description, price).

    rows carries title, description, price_top and price_bottom. The top slot is read first; a
    slot text that is no price joins the description, and an untitled price goes to the last
    titled row that has none.
    """
    shown = collapse(price_slot(F.col("price_top"), F.col("price_bottom")))
    own = F.when(looks_like_price(F.col("_shown")), tidy_price(F.col("_shown")))
    staged = rows.select(
        *keys, position, collapse(F.coalesce("title", F.lit(""))).alias("title"),
        F.coalesce("description", F.lit("")).alias("description"), shown.alias("_shown"),
    ).withColumn("_own", own)
    priced = attach_orphan_prices(
        staged, keys, position, F.col("title") != "", F.col("_own"), F.col("_own"), width
    )
    extra = F.when(F.col("_own").isNull(), F.col("_shown"))
    return priced.select(
        *keys, position, "title",
        collapse(join_present(" ", F.col("description"), extra)).alias("description"),
        F.coalesce("resolved_price", F.lit("")).alias("price"),
    )


def first_section(sections: DataFrame, keys: Sequence[str], title: str, wanted: str, position: str) -> DataFrame:
    """First section with the wanted title per key; keys without one have no row (see section_or_error)."""
    return keep_first(sections.filter(F.col(title) == wanted), keys, [position])


def section_or_error(sections: DataFrame, keys: Sequence[str], title: str, wanted: str, position: str) -> DataFrame:
    """As first_section, but a key without the wanted section is an error."""
    found = first_section(sections, keys, title, wanted, position).withColumn("_found", F.lit(True))
    missing = F.raise_error(F.concat(F.lit(f"section {wanted!r} not found: "), F.to_json(F.struct(*keys)))).cast("boolean")
    checked = sections.select(*keys).distinct().join(found, list(keys), "left").withColumn("_found", F.coalesce("_found", missing))
    return checked.filter("_found").drop("_found").select(*sections.columns)


def reading_order(
    blocks: DataFrame,
    page: Sequence[str],
    x: str,
    y: str,
    middle: Column,
    ties: Sequence[str],
    least: int = 3,
    partitions: int | None = None,
) -> DataFrame:
    """Rank of each block: left column then right when both hold enough blocks, else top to bottom.

    A page of any size is ranked in runs of neighbouring blocks, whose borders are sampled.
    """
    right = (F.col(x) >= middle).cast("int")
    staged = blocks.withColumn("_right", right)
    sides = staged.groupBy(*page).agg(
        F.count_if(F.col("_right") == 0).alias("_n_left"), F.count_if(F.col("_right") == 1).alias("_n_right")
    )
    split = (F.col("_n_left") >= least) & (F.col("_n_right") >= least)
    blocks_of = F.col("_n_left") + F.col("_n_right")
    placed = sized_lookup(staged, sides, page, ["_n_left", "_n_right"], blocks_of, [y, *ties]).withColumn(
        "column_no", F.when(split, F.col("_right")).otherwise(0)
    )
    order = ["column_no", y, *ties]
    return group_index(placed.drop("_right", "_n_left", "_n_right"), page, order, "block_no", partitions)


def unique_slugs(
    rows: DataFrame, title: str, position: str, digest: Column, fallback: Column, heavy: Heavy = None
) -> DataFrame:
    """Slug per row; every later row with a used slug gets the digest appended."""
    staged = rows.withColumn("_slug", slug(F.col(title), fallback=fallback)).withColumn("_digest", digest)
    first = staged.groupBy("_slug").agg(F.min(position).alias("_first"))
    return (
        salted_lookup(staged, first, ["_slug"], [position], "inner", heavy)
        .withColumn(
            "slug",
            F.when(F.col(position) == F.col("_first"), F.col("_slug")).otherwise(F.concat_ws("-", "_slug", "_digest")),
        )
        .drop("_slug", "_digest", "_first")
    )


def running_index(rows: DataFrame, query: Sequence[str], order: Sequence[Column | str], name: str = "index", partitions: int | None = None) -> DataFrame:
    """Dense 1-based index over all pages of a query (or of the whole table)."""
    return group_index(rows, query, order, name, partitions)
