"""Ratings, review counts and review lines mined from saved pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from dishframe.functions import html
from dishframe.functions.text import collapse, first, let
from dishframe.functions.urls import looks_like_menu
from dishframe.operators.jsonwalk import has_rating, json_objects, review_like, structured_ratings
from dishframe.operators.ordering import review_snippets

# Rating and count phrases and the words of a review line.
RATING = r"(?i)\b([1-5](?:\.\d)?)\s*(?:out of\s*)?(?:/|of)?\s*5\s*(?:stars?)?\b"
COUNT = r"(?i)\b(\d[\d,]*)\s+(reviews?|ratings?)\b"
REVIEWISH = r"(?i)review|rating|stars?|customer|google|yelp|tripadvisor|facebook|doordash|grubhub|uber"


def pattern_hits(text: Column, pattern: str, before: int, after: int, limit: int | None = None, group: int = 1) -> Column:
    """Array of (value, start, context) of the matches of a pattern; with a limit, of the first.

    Splitting on the pattern gives the text between matches, whose lengths add up to the
    match offsets. The context reaches `before` characters back and `after` ahead of the start.
    """
    cut = lambda parts: first(parts, limit)
    split_up = F.struct(
        cut(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("found"),
        cut(F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).alias("values"),
        cut(F.split(text, pattern, -1)).alias("between"),
    )
    length_of = lambda parts, n: F.aggregate(F.slice(parts, F.lit(1), n), F.lit(0), lambda acc, p: acc + F.length(p))

    def hits(s: Column) -> Column:
        start = lambda i: length_of(s["between"], i + 1) + length_of(s["found"], i)
        return F.transform(s["values"], lambda v, i: F.struct(v.alias("value"), start(i).alias("start")))

    def with_context(h: Column) -> Column:
        first = F.greatest(h["start"] - before, F.lit(0))
        context = collapse(F.substr(text, first + 1, h["start"] + after - first))
        return F.struct(h["value"].alias("value"), h["start"].alias("start"), context.alias("context"))

    return F.transform(let(split_up, hits), with_context)


def line_of(text: Column, start: Column) -> Column:
    """The line around an offset."""
    before = F.substring_index(F.substr(text, F.lit(1), start), "\n", -1)
    after = F.substring_index(F.substr(text, start + 1), "\n", 1)
    return F.trim(F.concat(before, after))


def review_lines(lines: Column, longest: int | None = None, limit: int | None = None) -> Column:
    """Distinct lines with a review word; the caller may cut them to a display length and number."""
    keyed = F.array_distinct(
        F.filter(
            F.transform(
                lines,
                lambda line, i: F.when(
                    line.rlike(REVIEWISH), F.struct(line.alias("l"), (F.lit(None).cast("int") if longest is None else F.when(F.length(line) > longest, i)).alias("i"))
                ),
            ),
            lambda s: s.isNotNull(),
        )
    )
    return first(F.transform(keyed, lambda s: s["l"] if longest is None else F.substring(s["l"], 1, longest)), limit)


def page_signals(pages: DataFrame, markup: str = "html") -> DataFrame:
    """Per page: title, sizes, rating and count candidates, review lines, snippets, menu words, number
    of JSON scripts. One scan, no shuffle."""
    return (
        pages.withColumn("lines", html.visible_lines(F.col(markup)))
        .withColumn("_text", F.array_join("lines", "\n"))
        .withColumn("title", html.title(F.col(markup)))
        .withColumn("html_chars", F.length(markup).cast("bigint"))
        .withColumn("text_chars", F.length("_text").cast("bigint"))
        .withColumn("rating_candidates", pattern_hits(F.col("_text"), RATING, 180, 260))
        .withColumn("count_candidates", pattern_hits(F.col("_text"), COUNT, 180, 260))
        .withColumn("review_lines", review_lines(F.col("lines")))
        .withColumn("review_snippets", review_snippets(F.col("lines")))
        .withColumn("looks_menuish", looks_like_menu(F.col("_text")))
        .withColumn("json_script_count", F.size(F.filter(html.scripts(F.col(markup)), lambda s: html.json_or_null(s["body"]).isNotNull())))
        .drop("_text", "lines", markup)
    )


def signal_rows(signals: DataFrame, key: Sequence[str]) -> DataFrame:
    """Long form (key, kind, pos, value, context)."""
    plain = F.lit(None).cast("string")
    tagged = lambda kind, items: F.transform(
        items,
        lambda h, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("pos"), h["value"].alias("value"), h["context"].alias("context")
        ),
    )
    lines = lambda kind, items: F.transform(
        items,
        lambda t, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), t.alias("value"), plain.alias("context")),
    )
    everything = F.concat(
        tagged("rating", F.col("rating_candidates")),
        tagged("count", F.col("count_candidates")),
        lines("review_line", F.col("review_lines")),
        lines("snippet", F.col("review_snippets")),
    )
    return signals.select(*key, F.inline(everything))


def script_documents(pages: DataFrame, key: str, markup: str = "html", ld_only: bool = False) -> DataFrame:
    """(key, script_no, script_id, script_type, document) of the script blocks that hold JSON."""
    blocks = pages.select(key, F.posexplode(html.scripts(F.col(markup))).alias("script_no", "_s"))
    typed = blocks.select(
        key,
        "script_no",
        html.attribute(F.col("_s.attributes"), "id").alias("script_id"),
        html.attribute(F.col("_s.attributes"), "type").alias("script_type"),
        html.json_or_null(F.col("_s.body")).alias("document"),
    )
    if ld_only:
        typed = typed.filter(F.col("script_type") == "application/ld+json")
    return typed.filter(F.col("document").isNotNull())


def page_ratings(pages: DataFrame, key: str, markup: str = "html", graph_only: bool = False) -> DataFrame:
    """Structured ratings of every JSON script of every page."""
    documents = script_documents(pages, key, markup, ld_only=graph_only)
    return structured_ratings(json_objects(documents, key, "document", graph_only, has_rating), [key])


def review_like_objects(
    pages: DataFrame, key: str, markup: str = "html", n_reviews: int = 40, n_ratingish: int = 80, longest_review: int = 1000, longest_ratingish: int = 1400
) -> DataFrame:
    """(key, kind, pos, script_id, script_type, context): the first objects of a page's JSON scripts with a
    'review' member (kind review), and those whose keys or first 400 characters speak of reviews (ratingish).

    Objects that are neither never leave the walk; the numbers are display limits of one page.
    """
    about = ["script_no", "script_id", "script_type"]
    rows = review_like(script_documents(pages, key, markup), [key, *about], "document", REVIEWISH, longest_review, longest_ratingish)
    order = Window.partitionBy(key, "kind").orderBy("script_no", "n")
    most = F.when(F.col("kind") == "review", n_reviews).otherwise(n_ratingish)
    ranked = rows.withColumn("pos", F.row_number().over(order) - 1).filter(F.col("pos") < most)
    return ranked.select(key, "kind", "pos", "script_id", "script_type", "context")


def source_summary(signals: DataFrame, source: str = "source") -> DataFrame:
    """Per source: pages, ratings, snippets. Lists stay in the long form of signal_rows."""
    return signals.groupBy(source).agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.sum(F.size("rating_candidates").cast("bigint")).alias("n_ratings"),
        F.sum(F.least(F.size("rating_candidates"), F.lit(5)).cast("bigint")).alias("n_best_ratings"),
        F.sum(F.size("count_candidates").cast("bigint")).alias("n_counts"),
        F.sum(F.size("review_snippets").cast("bigint")).alias("review_snippet_count"),
    )


def source_evidence(signals: DataFrame, source: str, page: str, label: str, firsts: dict[str, int | None]) -> DataFrame:
    """The lists of a source's summary as rows: (source, page, kind, pos, value, context).

    Each page gives itself (kind page, its label) and the first hits of each list column named in
    `firsts` with its display limit, None for all. One scan without an exchange: no list of a source
    is built. A NULL list has no rows; pages of a NULL source keep it.
    """
    own = F.array(F.struct(F.lit("page").alias("kind"), F.lit(0).alias("pos"), F.col(label).alias("value"), F.lit(None).cast("string").alias("context")))
    hits = lambda kind, most: F.transform(
        first(F.coalesce(kind, F.array().cast(signals.schema[kind].dataType)), most),
        lambda h, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), h["value"].alias("value"), h["context"].alias("context")),
    )
    return signals.select(source, page, F.inline(F.concat(own, *[hits(kind, most) for kind, most in firsts.items()])))


def first_candidates(signals: DataFrame, source: str, page: str, kind: str, limit: int) -> DataFrame:
    """First candidates of every page as rows of its source."""
    return signals.select(source, page, F.posexplode(F.slice(kind, 1, limit)).alias("pos", "_h")).select(
        source, page, "pos", "_h.value", "_h.context"
    )
